"""Connected components: of links between movies' detections by blocks of frames, and of the blocks' components by stars."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.sources.tables import kept

FRAMES_PER_BLOCK = 16


def near_pairs(frame: np.ndarray, x: np.ndarray, y: np.ndarray, radius: float, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(i, j): all pairs of points 1 to `reach` frames and `radius` at most apart, i in the earlier frame. Points meet by cells
    as wide as the radius, which are numbered so that the three cells of a column that can be near are one range."""
    if not len(frame):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    f = (frame - frame.min()).astype(np.int64)
    a, b = (np.floor(v / radius).astype(np.int64) for v in (x, y))
    a, b = a - a.min() + 1, b - b.min() + 1
    wide, high = int(a.max()) + 2, int(b.max()) + 2
    key = (f * wide + a) * high + b
    order = np.argsort(key, kind="stable")
    sorted_ = key[order]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for later in range(1, reach + 1):
        for side in (-1, 0, 1):
            middle = ((f + later) * wide + a + side) * high + b
            begin, end = np.searchsorted(sorted_, middle - 1), np.searchsorted(sorted_, middle + 1, side="right")
            n = end - begin
            i = np.repeat(np.arange(len(f)), n)
            j = order[np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())]
            close = (x[i] - x[j]) ** 2 + (y[i] - y[j]) ** 2 <= radius * radius
            found.append((i[close], j[close]))
    return np.concatenate([p[0] for p in found]), np.concatenate([p[1] for p in found])


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest that it reaches over the links."""
    parent = np.arange(n)
    while True:
        a, b = parent[i], parent[j]
        apart = a != b
        if not apart.any():
            return parent
        i, j = i[apart], j[apart]
        np.minimum.at(parent, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while not np.array_equal(up := parent[parent], parent):
            parent = up


def parts(detections: DataFrame, radius: float, memory: int, frames: int = FRAMES_PER_BLOCK) -> DataFrame:
    """movie_id, frame, label, part: detections that links of up to memory + 1 frames and the radius join, over any number of
    others, are one part, named by one of its (frame, label).

    A block of frames of a movie is a task's work; the next block's first frames, as many as a link may reach, are guests in
    it. A detection's components as a guest and in its own block are one. Only these pairs are closed to components, by star
    steps, so what is shuffled then follows the blocks' edges and not the detections."""
    reach, frames = memory + 1, max(frames, memory + 1)
    kind = dict(detections.dtypes)
    block = F.floor(F.col("frame") / frames)
    guest = F.when(F.col("frame") - block * frames < reach, F.struct((block - 1).alias("block"), F.lit(True).alias("guest")))
    places = F.filter(F.array(F.struct(block.alias("block"), F.lit(False).alias("guest")), guest), lambda p: p.isNotNull())
    sent = detections.select("movie_id", "frame", "label", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.inline(places))

    def run(table: pa.Table) -> pa.Table:
        f, label, x, y = (table.column(c).to_numpy() for c in ("frame", "label", "x", "y"))
        order = np.lexsort((label, f))
        f, label = f[order], label[order]
        root = roots(len(f), *near_pairs(f, x[order], y[order], radius, reach))
        taken = table.select(["movie_id", "frame", "label", "guest"]).take(pa.array(order))
        return taken.append_column("root_frame", pa.array(f[root].astype(np.int64))).append_column("root_label", pa.array(label[root].astype(np.int64)))

    fields = f"movie_id {kind['movie_id']}, frame {kind['frame']}, label {kind['label']}, guest boolean, root_frame long, root_label long"
    root = F.struct(F.col("root_frame").alias("frame"), F.col("root_label").alias("label"))
    found = kept(sent.groupBy("movie_id", "block").applyInArrow(run, fields).select("movie_id", "frame", "label", "guest", root.alias("root")))
    own = found.filter("not guest").drop("guest")
    edges = found.filter("guest").select("movie_id", "frame", "label", F.col("root").alias("v")).join(own, ["movie_id", "frame", "label"])
    reached = star_components(edges.select("movie_id", F.col("root").alias("u"), "v"), ["movie_id"])
    whole = own.join(reached.withColumnRenamed("node", "root"), ["movie_id", "root"], "left")
    return whole.select("movie_id", "frame", "label", F.coalesce("component", "root").alias("part"))


def star_components(edges: DataFrame, keys: list[str], max_rounds: int = 100) -> DataFrame:
    """keys, node, component: each node of edges (keys, u, v) with the smallest node that it reaches. In a round each node
    hands its larger neighbours, and then its smaller ones, to the smallest of them and itself, until nothing changes; rounds
    grow with the logarithm of the longest chain. Counts and checksums alone come to the driver."""
    state, edges = None, kept(_ordered(edges, keys))
    for _ in range(max_rounds):
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64(*keys, "u", "v").cast("decimal(38,0)"))).first())
        if now == state or not now[0]:
            return edges.select(*keys, F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                edges.select(*keys, F.col("v").alias("node"), F.col("v").alias("component")).distinct(),
            )
        state = now
        both = edges.unionByName(edges.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(*keys, "u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.filter("v > u").join(least, [*keys, "u"]).select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
        larger = _ordered(larger, keys)
        least = larger.groupBy(*keys, "u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, [*keys, "u"])
        edges = kept(_ordered(smaller.select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.withColumnRenamed("m", "v")), keys))
    raise RuntimeError(f"components are not complete after {max_rounds} rounds")


def _ordered(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Each edge once, from the larger node to the smaller."""
    return edges.select(*keys, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u > v").distinct()
