"""Frame-to-frame linking of points into particles: nearest sum of squared distances within a radius.

Between two frames, live particles and points within the radius form a graph; each connected part is solved exactly as
an assignment, in cubic time, an unlinked particle costing the radius squared. A particle may miss `memory` frames. Modes: vanilla
stops at a part with too many nodes; adaptive shrinks such a part's radius step by step down to a floor; predictive does
the same from predicted positions, which carry a particle's recent velocity on (a new particle takes its nearest
neighbour's). Ids count up in order of appearance, within a frame in order of the points given.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np


class OversizeError(ValueError):
    """A connected part has more nodes than can be solved."""


@dataclass
class Options:
    radius: float
    memory: int = 1
    mode: str = "vanilla"
    max_nodes: int = 30
    max_nodes_adaptive: int = 15
    adaptive_step: float = 0.9
    adaptive_stop: float = 10.0
    span: int = 3


@dataclass
class Linker:
    """Live particles: id -> recent (frame, x, y), newest last. `step` takes one frame's points and returns their ids."""

    options: Options
    live: dict[int, list[tuple[int, float, float]]] = field(default_factory=dict)
    next_id: int = 0

    def step(self, frame: int, points: list[tuple[float, float]]) -> list[int]:
        o = self.options
        self.live = {p: h for p, h in self.live.items() if frame - h[-1][0] <= o.memory + 1}
        expected = self._expected(frame)
        near = _candidates(expected, points, o.radius)
        found: dict[int, int] = {}
        for particles, dots in _parts(near):
            found |= self._solve(particles, dots, near, o.radius)
        ids = []
        for i, (x, y) in enumerate(points):
            p = found.get(i)
            if p is None:
                p, self.next_id = self.next_id, self.next_id + 1
                self.live[p] = []
            self.live[p] = [*self.live[p], (frame, x, y)][-max(2, o.span) :]
            ids.append(p)
        return ids

    def _expected(self, frame: int) -> dict[int, tuple[float, float]]:
        last = {p: h[-1] for p, h in self.live.items()}
        if self.options.mode != "predictive":
            return {p: (x, y) for p, (_, x, y) in last.items()}
        speed = {}
        for p, h in self.live.items():
            if len(h) > 1:
                (f0, x0, y0), (f1, x1, y1) = h[0], h[-1]
                speed[p] = ((x1 - x0) / (f1 - f0), (y1 - y0) / (f1 - f0))
        out = {}
        for p, (f, x, y) in last.items():
            if p in speed:
                vx, vy = speed[p]
            elif speed:
                vx, vy = speed[min(speed, key=lambda q: ((last[q][1] - x) ** 2 + (last[q][2] - y) ** 2, q))]
            else:
                vx = vy = 0.0
            out[p] = (x + vx * (frame - f), y + vy * (frame - f))
        return out

    def _solve(self, particles: list[int], dots: list[int], near: dict[int, dict[int, float]], radius: float) -> dict[int, int]:
        o = self.options
        limit = o.max_nodes if o.mode == "vanilla" else o.max_nodes_adaptive
        if max(len(particles), len(dots)) <= limit:
            return _assign(particles, near, radius * radius)
        smaller = radius * o.adaptive_step
        if o.mode == "vanilla" or smaller < o.adaptive_stop:
            raise OversizeError(f"{len(particles)} particles and {len(dots)} points within {radius:g}")
        kept = {p: {d: c for d, c in near[p].items() if c <= smaller * smaller} for p in particles}
        found: dict[int, int] = {}
        for part, own in _parts(kept):
            found |= self._solve(part, own, kept, smaller)
        return found


def _candidates(expected: dict[int, tuple[float, float]], points: list[tuple[float, float]], radius: float) -> dict[int, dict[int, float]]:
    """particle -> {point: squared distance}, by a grid of cells as wide as the radius."""
    cells: dict[tuple[int, int], list[int]] = {}
    for i, (x, y) in enumerate(points):
        cells.setdefault((math.floor(x / radius), math.floor(y / radius)), []).append(i)
    near: dict[int, dict[int, float]] = {}
    for p, (x, y) in expected.items():
        a, b = math.floor(x / radius), math.floor(y / radius)
        for i in (i for da in (-1, 0, 1) for db in (-1, 0, 1) for i in cells.get((a + da, b + db), ())):
            d = (points[i][0] - x) ** 2 + (points[i][1] - y) ** 2
            if d <= radius * radius:
                near.setdefault(p, {})[i] = d
    return near


def _parts(near: dict[int, dict[int, float]]) -> list[tuple[list[int], list[int]]]:
    """Connected parts of the candidate graph."""
    of_dot: dict[int, list[int]] = {}
    for p, own in near.items():
        for d in own:
            of_dot.setdefault(d, []).append(p)
    seen: set[int] = set()
    parts = []
    for first in near:
        if first in seen or not near[first]:
            continue
        seen.add(first)
        particles, dots, queue = [], set(), [first]
        while queue:
            p = queue.pop()
            particles.append(p)
            for d in near[p]:
                if d not in dots:
                    dots.add(d)
                    for q in of_dot[d]:
                        if q not in seen:
                            seen.add(q)
                            queue.append(q)
        parts.append((sorted(particles), sorted(dots)))
    return parts


def _assign(particles: list[int], near: dict[int, dict[int, float]], unlinked: float) -> dict[int, int]:
    """point -> particle with the least total, by shortest augmenting paths with potentials: cubic in the part's size. Of
    assignments with the same total the one in which, in order of ids, each particle has the first point it can."""
    order = sorted(particles)
    dots = sorted({d for p in order for d in near[p]})
    at = {d: j for j, d in enumerate(dots)}
    n, m = len(order), len(dots)
    cost = np.full((n, m + n), np.inf)  # behind the points, a place of its own for each particle: it stays unlinked
    for i, p in enumerate(order):
        for d, c in near[p].items():
            if c <= unlinked:
                cost[i, at[d]] = c
        cost[i, m + i] = unlinked
    u, v, row_of = np.zeros(n), np.zeros(m + n), np.full(m + n, -1)
    for i in range(n):
        _augment(cost, u, v, row_of, i)
    # With a row without costs for each column that stays free, assignments of the least total are the perfect matchings
    # of tight pairs.
    slack = 1e-9 * max(1.0, unlinked)
    tight = np.concatenate([cost - u[:, None] - v[None, :] <= slack, np.repeat(v[None] >= -slack, m, axis=0)])
    row_of[row_of < 0] = np.arange(n, n + m)
    column_of = {int(r): j for j, r in enumerate(row_of)}
    for i in range(n):
        for j in np.flatnonzero(tight[i]).tolist():
            if j == column_of[i] or _moved(tight, row_of, column_of, i, j):
                break
    return {dots[j]: order[i] for i, j in column_of.items() if i < n and j < m}


def _augment(cost: np.ndarray, u: np.ndarray, v: np.ndarray, row_of: np.ndarray, row: int) -> None:
    """Gives the row a column along the cheapest alternating path; u, v stay potentials of the cost."""
    n_columns = cost.shape[1]
    least, before, done = np.full(n_columns, np.inf), np.full(n_columns, -1), np.zeros(n_columns, bool)
    total, i, j, reached = 0.0, row, -1, []
    while True:
        step = total + cost[i] - u[i] - v
        better = ~done & (step < least)
        least[better], before[better] = step[better], j
        j = int(np.argmin(np.where(done, np.inf, least)))
        total, done[j] = least[j], True
        if row_of[j] < 0:
            break
        i = int(row_of[j])
        reached.append(j)
    u[row] += total
    for k in reached:
        u[row_of[k]] += total - least[k]
        v[k] -= total - least[k]
    while j >= 0:
        k = int(before[j])
        row_of[j] = row if k < 0 else row_of[k]
        j = k


def _moved(tight: np.ndarray, row_of: np.ndarray, column_of: dict[int, int], row: int, column: int) -> bool:
    """Whether the row can have the column in another matching that leaves the rows before it as they are; it has it
    then."""
    left, seen = column_of[row], {column} | {column_of[i] for i in range(row)}

    def found_another(i: int) -> bool:
        for j in np.flatnonzero(tight[i]).tolist():
            if j not in seen:
                seen.add(j)
                if j == left or found_another(int(row_of[j])):
                    row_of[j], column_of[i] = i, j
                    return True
        return False

    holder = int(row_of[column])
    if holder < row or not found_another(holder):
        return False
    row_of[column], column_of[row] = row, column
    return True
