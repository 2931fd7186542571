"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard, shard results merged.

Equal vectors are one node (their smallest ids are kept, as many as a result can show), so copies, however many, don't
crowd a neighbourhood. Nodes are dealt to shards of bounded size by hash; a task builds its shard's graph. Nodes stand
in order of their level, highest first, so each layer is a prefix and its links are one flat array of fixed width, -1
where there is none. Nodes enter a layer in batches. The nearest that are there, or enter with them, are found by one
matrix product a batch, which for shards of this size costs less than searching the graph and finds better ones; of
these a node keeps neighbours by the diversity rule, as do nodes that get links back. Searches go down the layers for
many queries at once: one step opens the nearest unopened nodes of all of them.

A shard has up to SHARD_NODES nodes, fewer if their vectors hold over SHARD_BYTES, so that the number of visits, queries
times shards, stays far below queries times vectors. Its graph sees vectors in single precision, less the shard's median in
each dimension and divided by their usual size, both in double precision first: distances keep their order wherever the
vectors lie. The graphs are written to the shared folder as flat arrays, a row per shard. Queries come in blocks of bounded
size, each block visits each shard, and the nearest of all shards are ranked by exact distances in double precision.

Defined results: vectors that are null, zero, of another length than most, or that hold a null or a non-finite
component take no part, as queries and as candidates; a null id takes no part; of all nodes found, equal distances rank
by the smaller id; rows with the same id and vector are one, other rows of the same id are candidates each, and a list
of their own each as queries; if there are fewer candidates than asked for, all are returned; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import written

SHARD_NODES, SHARD_BYTES = 1 << 15, 32 << 20
#: Times the usual size beyond which components count as that far.
FARTHEST = 1e15
QUERY_BLOCK = 1 << 16
LINKS = 16
BUILD_WIDTH = 48
#: Nodes that enter together.
ENTERING = 512
SEARCH_WIDTH = 96
OPENED = 4
SIDE_BY_SIDE = 256


@dataclass
class Graph:
    """vectors (n, d) float32 in level order; layers[l] (n_l, width) int32 neighbours, layer 0 first."""

    vectors: np.ndarray
    layers: list[np.ndarray]

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, squared distances), (q, width) each, nearest first; -1 and inf where there is none. A graph of no more
        nodes than that is looked at whole."""
        n = len(self.vectors)
        if n <= width:
            far = ((queries[:, None] - self.vectors[None]) ** 2).sum(2)
            order = np.argsort(far, axis=1, kind="stable").astype(np.int32)
            return order, np.take_along_axis(far, order, 1)
        found = [self._descend(queries[i : i + SIDE_BY_SIDE], width, 0) for i in range(0, len(queries), SIDE_BY_SIDE)]
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _descend(self, q: np.ndarray, width: int, to: int) -> tuple[np.ndarray, np.ndarray]:
        entry = np.zeros((len(q), 1), np.int32)
        for layer in range(len(self.layers) - 1, to, -1):
            entry = _beam(q, self.vectors, self.layers[layer], len(self.layers[layer]), entry, 8)[0][:, :1]
        return _beam(q, self.vectors, self.layers[to], len(self.layers[to]), entry, width)


def _beam(q: np.ndarray, vectors: np.ndarray, links: np.ndarray, n: int, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of one layer's first n nodes from `entry`, for all queries together."""
    rows = np.arange(len(q))[:, None]
    squares = (q * q).sum(1)
    visited = np.zeros((len(q), n + 1), bool)  # column n stands for no node
    visited[:, n] = True
    nodes = np.full((len(q), width), -1, np.int32)
    near = np.full((len(q), width), np.inf, np.float32)
    opened = np.ones((len(q), width), bool)
    nodes[:, :1], opened[:, :1] = entry, False
    near[:, :1] = ((q[:, None] - vectors[entry]) ** 2).sum(2)
    visited[rows, entry] = True
    active = np.arange(len(q))
    while len(active):
        waiting = np.where(opened[active], np.inf, near[active])
        some = np.isfinite(waiting).any(1)
        active, waiting = active[some], waiting[some]
        if not len(active):
            break
        k = min(OPENED, width)
        pick = np.argpartition(waiting, k - 1, axis=1)[:, :k] if k < width else np.tile(np.arange(width), (len(active), 1))
        usable = np.isfinite(np.take_along_axis(waiting, pick, 1))
        own = active[:, None]
        opened[own, pick] |= usable
        from_ = np.where(usable, nodes[own, pick], 0)
        next_ = np.where(usable[:, :, None], links[from_], -1).reshape(len(active), -1)
        next_ = np.where((next_ < 0) | (next_ >= n), n, next_)
        next_.sort(axis=1)
        next_[:, 1:][next_[:, 1:] == next_[:, :-1]] = n
        next_[visited[own, next_]] = n
        visited[own, next_] = True
        next_.sort(axis=1)
        next_ = next_[:, : max(1, int((next_ < n).sum(1).max()))]
        real = next_ < n
        v = vectors[np.where(real, next_, 0)]
        far = squares[active][:, None] + (v * v).sum(2) - 2 * np.matmul(v, q[active][:, :, None])[:, :, 0]
        far = np.where(real, np.maximum(far, 0), np.inf)
        all_near = np.concatenate([near[active], far], axis=1)
        all_nodes = np.concatenate([nodes[active], np.where(real, next_, -1)], axis=1)
        all_open = np.concatenate([opened[active], ~real], axis=1)
        best = np.argpartition(all_near, width - 1, axis=1)[:, :width]
        near[active] = np.take_along_axis(all_near, best, 1)
        nodes[active] = np.take_along_axis(all_nodes, best, 1)
        opened[active] = np.take_along_axis(all_open, best, 1)
    order = np.argsort(near, axis=1, kind="stable")
    return np.take_along_axis(nodes, order, 1), np.take_along_axis(near, order, 1)


def _diverse(base: np.ndarray, candidates: np.ndarray, far: np.ndarray, vectors: np.ndarray, keep: int) -> np.ndarray:
    """Of each row's candidates (nearest first, -1: none) up to `keep`, leaving out one that is nearer to a kept one than
    to the base; free places then go to the nearest left out."""
    b, c = candidates.shape
    chosen = np.full((b, keep), -1, np.int32)
    n = np.zeros(b, np.int64)
    left_out = np.full((b, c), -1, np.int32)
    kept_vectors = np.zeros((b, keep, vectors.shape[1]), np.float32)
    rows = np.arange(b)
    for i in range(c):
        node = candidates[:, i]
        real = (node >= 0) & np.isfinite(far[:, i])
        v = vectors[np.where(real, node, 0)]
        to_kept = ((kept_vectors - v[:, None]) ** 2).sum(2)
        to_kept[np.arange(keep)[None, :] >= n[:, None]] = np.inf
        take = real & (n < keep) & (to_kept.min(1) > far[:, i])
        at = rows[take]
        chosen[at, n[take]] = node[take]
        kept_vectors[at, n[take]] = v[take]
        n[take] += 1
        left_out[:, i] = np.where(real & ~take, node, -1)
    for i in range(c):
        take = (left_out[:, i] >= 0) & (n < keep)
        chosen[rows[take], n[take]] = left_out[take, i]
        n[take] += 1
    return chosen


def build(vectors: np.ndarray, links: int = LINKS, width: int = BUILD_WIDTH, seed: int = 1) -> tuple[Graph, np.ndarray]:
    """(graph, order): order[i] is the row of `vectors` that is node i."""
    n = len(vectors)
    level = np.floor(-np.log(1 - np.random.default_rng(seed).random(n)) / math.log(links)).astype(int)
    order = np.argsort(-level, kind="stable")
    vectors, level = np.ascontiguousarray(vectors[order], np.float32), level[order]
    graph = Graph(vectors, [])
    for layer in range(int(level.max(initial=0)), -1, -1):
        size = int((level >= layer).sum())
        graph.layers.insert(0, _layer(vectors, size, 2 * links if layer == 0 else links, links, width))
    return graph, order


def _layer(vectors: np.ndarray, size: int, places: int, links: int, width: int) -> np.ndarray:
    """Links among the first `size` nodes."""
    out = np.full((size, places), -1, np.int32)
    squares = (vectors[:size] ** 2).sum(1)
    done = min(1, size)
    while done < size:
        batch = np.arange(done, min(size, done + min(ENTERING, max(1, done // 4))))
        done += len(batch)
        q = vectors[batch]
        far = q @ vectors[:done].T
        far *= -2
        far += squares[:done]
        far[np.arange(len(batch)), batch] = np.inf
        k = min(width, done - 1)
        nodes = np.argpartition(far, k - 1, axis=1)[:, :k].astype(np.int32)
        far = np.take_along_axis(far, nodes, 1)
        best = np.argsort(far, axis=1, kind="stable")
        nodes, far = np.take_along_axis(nodes, best, 1), np.take_along_axis(far, best, 1) + squares[batch][:, None]
        own = _diverse(q, nodes, far, vectors, links)
        out[batch, :links] = own
        _link_back(out, batch, own, vectors, places)
    return out


def _link_back(out: np.ndarray, batch: np.ndarray, own: np.ndarray, vectors: np.ndarray, places: int) -> None:
    """Links from the chosen neighbours back to the new nodes; a node without room keeps its nearest."""
    to, from_ = own.reshape(-1), np.repeat(batch, own.shape[1]).astype(np.int32)
    to, from_ = to[to >= 0], from_[to >= 0]
    order = np.argsort(to, kind="stable")
    to, from_ = to[order], from_[order]
    node, first, count = np.unique(to, return_index=True, return_counts=True)
    more = np.full((len(node), int(count.max(initial=0))), -1, np.int32)
    more[np.repeat(np.arange(len(node)), count), np.arange(len(to)) - np.repeat(first, count)] = from_
    both = np.concatenate([out[node], more], axis=1)
    both.sort(axis=1)
    both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
    full = (both >= 0).sum(1) > places
    both = -np.sort(-both, axis=1)
    out[node[~full]] = both[~full][:, :places]
    if full.any():
        node, both = node[full], both[full]
        far = ((vectors[np.where(both >= 0, both, 0)] - vectors[node][:, None]) ** 2).sum(2)
        far[both < 0] = np.inf
        out[node] = np.take_along_axis(both, np.argpartition(far, places - 1, axis=1)[:, :places], 1)


def usable(vector: Column, size: int) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) == size) & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest(
    vectors: DataFrame, queries: Column, k: int = 10, shard_nodes: int = SHARD_NODES, query_block: int = QUERY_BLOCK,
    search_width: int = SEARCH_WIDTH,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row of `vectors` (vec_id, embedding) for which the
    condition `queries` on vec_id holds, the row itself left out."""
    found = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"),
    ).filter("vec_id is not null and size(v) > 0")
    size = found.select(F.size("v").alias("n")).groupBy("n").count().orderBy(F.desc("count"), "n").first()
    good = found.filter(usable(F.col("v"), size["n"] if size else 0)).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).distinct()
    # A class of equal vectors keeps its k + 1 smallest ids: a query may be one of them. Ranks are cut before the shuffle.
    ranked = good.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    nodes = written(ranked.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "ann-nodes")
    asked = written(good.filter(queries).select("vec_id", "v", F.xxhash64("vec_id", "v").alias("query")), "ann-queries")
    nodes_each = max(1, min(shard_nodes, SHARD_BYTES // (8 * max(1, size["n"] if size else 1))))
    shards, blocks = max(1, -(-nodes.count() // nodes_each)), max(1, -(-asked.count() // query_block))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
    graphs = written(
        dealt.groupBy("shard").applyInPandas(
            _pack_shard,
            "shard int, dim int, kind string, centre binary, scale double, vectors binary, ids binary, id_ends binary, layers array<binary>, widths array<int>",
        ),
        "ann-graphs",
    )

    visits = asked.withColumn("block", F.pmod("query", F.lit(blocks)).cast("int")).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))),
    )
    held = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def visit(_: tuple, graph: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return _search_shard(graph, asked, k, search_width)

    hits = held.groupBy("shard", "block").cogroup(visits.groupBy("shard", "block")).applyInPandas(
        visit, "query long, query_id long, vec_id long, score double",
    )
    order = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    return hits.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pack_shard(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.assign(first=[int(i[0]) for i in rows["ids"]]).sort_values("first")
    exact = np.stack(rows["v"].to_list()).astype(np.float64)
    centre = np.median(exact, axis=0)
    scale = float(np.median(np.abs(exact - centre).max(axis=1))) or 1.0
    graph, order = build(_placed(exact, centre, scale))
    if (exact.astype(np.float32) == exact).all():  # the components were floats: half the bytes, nothing lost
        exact = exact.astype(np.float32)
    ids = [np.asarray(rows["ids"].iloc[i], np.int64) for i in order]
    return pd.DataFrame({
        "shard": rows["shard"].iloc[:1].to_list(), "dim": [exact.shape[1]], "kind": [exact.dtype.str], "centre": [centre.tobytes()], "scale": [scale], "vectors": [exact[order].tobytes()],
        "ids": [np.concatenate(ids).astype("<i8").tobytes()], "id_ends": [np.cumsum([len(i) for i in ids]).astype("<i8").tobytes()],
        "layers": [[x.astype("<i4").tobytes() for x in graph.layers]], "widths": [[x.shape[1] for x in graph.layers]],
    })


def _placed(vectors: np.ndarray, centre: np.ndarray, scale: float) -> np.ndarray:
    """The vectors as the graph sees them."""
    with np.errstate(over="ignore"):
        return np.clip((vectors.astype(np.float64) - centre) / scale, -FARTHEST, FARTHEST).astype(np.float32)


def _search_shard(row: pd.DataFrame, asked: pd.DataFrame, k: int, width: int) -> pd.DataFrame:
    """query, query_id, vec_id, score: of each query the k nearest found, ids of equal vectors each."""
    none = pd.DataFrame({"query": np.zeros(0, np.int64), "query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
    if not len(row) or not len(asked):
        return none
    g = row.iloc[0]
    exact = np.frombuffer(g["vectors"], g["kind"]).reshape(-1, int(g["dim"]))
    ids, ends = np.frombuffer(g["ids"], "<i8"), np.frombuffer(g["id_ends"], "<i8")
    sizes = np.diff(ends, prepend=0)
    centre, scale = np.frombuffer(g["centre"]), float(g["scale"])
    graph = Graph(_placed(exact, centre, scale), [np.frombuffer(x, "<i4").reshape(-1, w) for x, w in zip(g["layers"], g["widths"])])
    out = [none]
    for at in range(0, len(asked), SIDE_BY_SIDE):
        part = asked.iloc[at : at + SIDE_BY_SIDE]
        q, own = np.stack(part["v"].to_list()).astype(np.float64), part["vec_id"].to_numpy(np.int64)
        nodes, _ = graph.search(_placed(q, centre, scale), max(width, k + 1))
        of, column = np.nonzero(nodes >= 0)
        node = nodes[of, column]
        far = np.sqrt(((exact[node].astype(np.float64) - q[of]) ** 2).sum(1))
        same = (far == 0) & (exact[node] == q[of]).all(1)
        # A row for each id of each node found.
        count = sizes[node]
        of, far, same = np.repeat(of, count), np.repeat(far, count), np.repeat(same, count)
        found = ids[np.repeat(ends[node] - np.cumsum(count), count) + np.arange(count.sum())]
        kept = ~(same & (found == own[of]))
        of, far, found = of[kept], far[kept], found[kept]
        order = np.lexsort((found, far, of))
        of, far, found = of[order], far[order], found[order]
        near = np.arange(len(of)) - np.searchsorted(of, of) < k
        of = of[near]
        out.append(pd.DataFrame({"query": part["query"].to_numpy()[of], "query_id": own[of], "vec_id": found[near], "score": far[near]}))
    return pd.concat(out, ignore_index=True)
