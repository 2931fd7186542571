"""Linking as detections arrive: frames leave when a later one has come.

A movie's state is a map of its live particles, a few numbers, and the rows of its newest frame. A trigger reads the live
particles of the movies that have rows, and writes those that a point has joined; those that have been away too long are
removed. So what is written follows the points that came, whatever the movie's length.

A frame may arrive in several batches, so a movie's newest frame waits in the state. It leaves when a later one comes, or
when nothing has come for the movie for `idle_ms`: a timer says then that the movie has ended, its last frame is linked
and its state is freed. Rows of a frame that has left already are late: they keep a null particle and say so. Rows that
come after the end begin the movie anew. After a frame that can't be solved a movie's rows keep a null particle and the
reason.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from trackloom.functions.linker import Linker, Options, OversizeError

OUT = "movie_id long, frame long, label long, x double, y double, particle long, link_error string"
PARTICLE, HISTORY = "particle long", "frames array<long>, xs array<double>, ys array<double>"
HEAD, POINT = "last long, next_id long, broken string", "frame long, label long, x double, y double"
#: The kind of state store that maps and timers need, by the name of its class.
STORE = "RocksDBStateStoreProvider"
STORE_CONF = "spark.sql.streaming.stateStore.providerClass"


class LinkMovie(StatefulProcessor):
    def __init__(self, options: Options, idle_ms: int):
        self.options, self.idle_ms = options, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getMapState("live", PARTICLE, HISTORY)
        self.head = handle.getValueState("head", HEAD)
        self.waiting = handle.getListState("waiting", POINT)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        came = [tuple(r) for b in rows for r in b[["frame", "label", "x", "y"]].itertuples(index=False)]
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield self._linked(key, came, ended=False)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._linked(key, [], ended=True)
        for state in (self.live, self.head, self.waiting):
            state.clear()

    def _linked(self, key: tuple, came: list[tuple], ended: bool) -> pd.DataFrame:
        last, next_id, broken = self.head.get() if self.head.exists() else (-1, 0, None)
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        rows = held + came
        newest = max((r[0] for r in rows), default=last)
        out = [(key[0], *r, None, "late") for r in rows if r[0] <= last]
        due = sorted({r[0] for r in rows if last < r[0] and (ended or r[0] < newest)})
        linker = Linker(self.options, self._particles() if due and broken is None else {}, next_id)
        known, touched = set(linker.live), set()
        for frame in due:
            points = sorted((r for r in rows if r[0] == frame), key=lambda r: (r[2], r[3], r[1]))
            ids: list = [None] * len(points)
            if broken is None:
                try:
                    ids = linker.step(int(frame), [(float(x), float(y)) for _, _, x, y in points])
                    touched.update(ids)
                except OversizeError as e:
                    broken = str(e)
            out += [(key[0], *r, p, broken) for r, p in zip(points, ids)]
            last = frame
        if not ended:
            self._keep(linker, known, touched, (int(last), int(linker.next_id), broken), [r for r in rows if r[0] == newest and r[0] > last], due)
        table = pd.DataFrame(out, columns=["movie_id", "frame", "label", "x", "y", "particle", "link_error"])
        return table.astype({"movie_id": "int64", "frame": "int64", "label": "int64", "x": float, "y": float, "particle": "Int64"})

    def _particles(self) -> dict[int, list[tuple[int, float, float]]]:
        """In the order of their ids, as they came into being."""
        found = {int(k[0]): [(int(f), float(x), float(y)) for f, x, y in zip(*v)] for k, v in self.live.iterator()}
        return dict(sorted(found.items()))

    def _keep(self, linker: Linker, known: set[int], touched: set[int], head: tuple, waiting: list[tuple], due: list) -> None:
        """Writes what has changed: particles that a point joined in a frame that left, the numbers, the frame that waits."""
        if due:
            alive = {p for p, h in linker.live.items() if head[0] - h[-1][0] <= self.options.memory} if head[2] is None else set()
            for p in touched & alive:
                frames, xs, ys = zip(*linker.live[p])
                self.live.updateValue((p,), (list(map(int, frames)), list(map(float, xs)), list(map(float, ys))))
            for p in known - alive:
                self.live.removeKey((p,))
        self.head.update(head)
        self.waiting.put([(int(f), int(n), float(x), float(y)) for f, n, x, y in waiting])

    def close(self) -> None:
        pass


def link_stream(detections: DataFrame, options: Options, idle_ms: int = 3_600_000) -> DataFrame:
    """A stream of (movie_id, frame, label, x, y) -> the same with particle and link_error. The session's state store must be
    the one that keeps maps and timers."""
    if not detections.sparkSession.conf.get(STORE_CONF, "").endswith(STORE):
        raise ValueError(f"{STORE_CONF} must name the {STORE}")
    typed = detections.selectExpr(
        "cast(movie_id as long) movie_id", "cast(frame as long) frame", "cast(label as long) label", "cast(x as double) x",
        "cast(y as double) y",
    )
    return typed.groupBy("movie_id").transformWithStateInPandas(LinkMovie(options, idle_ms), OUT, "append", "ProcessingTime")
