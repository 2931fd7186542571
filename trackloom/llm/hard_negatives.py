"""Hard-negative mining: product quantisation with residual norms, bounds that filter rigorously, exact whole-number scores.

A row's vector becomes whole numbers (floor of SCALE times each component), a score is the inner product of two of them.
Codebooks of whole-number centroids, one for each few dimensions, are fitted by k-means on a bounded sample of the rows
(SAMPLE_ROWS with the smallest hashes, fewer if they hold over SAMPLE_BYTES). Every row keeps its codes and the length of
what its centroids leave over, rounded up. An anchor's inner products with all centroids are a table; a row's looked-up
sum is exact for its centroids, and differs from its score by no more than the anchor's length times the row's residual
length (Cauchy-Schwarz). So a looked-up sum plus and minus that bound holds the score, and what the bounds can't exclude
is scored exactly: nothing is lost to the quantisation, whatever the sample.

Rows are dealt by hash to shards of bounded size, each written as one row of flat arrays to the shared folder; anchors come
in blocks of bounded size, and each block visits each shard. A first visit gives each anchor's best rows of its label,
which are merged to its positives; a second, with the positives' windows of scores, each window's best rows of other
labels. In a shard a bound is first raised by a few exact scores, then all rows whose bounds reach it are scored.

Defined results: a row whose label, vector or vec_id is null, or whose vector holds a null or a non-finite component, has
another length than most, or has a squared length of 2**61 or more as whole numbers (scores might not fit a long) takes no
part; rows equal in id, label and vector are one, other rows of one id are rows each, and each an anchor; equal scores
rank by the smaller id; an anchor without a positive, and a positive whose window holds no row, give no row; scores below
zero leave a window empty; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackloom.llm.common import written

SCALE = 256
SHARD_ROWS, SHARD_BYTES = 8192, 32 << 20
ANCHOR_BLOCK = 4096
SAMPLE_ROWS, SAMPLE_BYTES = 8192, 32 << 20
CENTROIDS, ROUNDS, MOST_PARTS = 256, 8, 64
#: Anchors whose tables are looked up together, and rows that raise a bound by their exact scores.
TOGETHER, RAISERS = 64, 8
LONGEST = float(1 << 61)


def whole_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, label, x (array of longs), key (a hash of all three) of each row that takes part."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"),
    ).filter("vec_id is not null and label is not null and size(v) > 0")
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    squares = F.aggregate("v", F.lit(0.0), lambda s, c: s + F.pow(F.abs(c) * SCALE + 1, F.lit(2.0)))
    good = rows.filter((F.size("v") == (size["n"] if size else 0)) & ~F.coalesce(bad, F.lit(True)) & (squares < LONGEST))
    return good.select("vec_id", "label", F.transform("v", lambda c: F.floor(c * SCALE)).alias("x")).withColumn("key", F.xxhash64("vec_id", "label", "x"))


def codebooks(sample: np.ndarray, centroids: int = CENTROIDS, rounds: int = ROUNDS) -> list[np.ndarray]:
    """For each part of the dimensions, up to `centroids` whole-number centroids, by k-means from evenly chosen rows."""
    out = []
    for part in np.array_split(np.arange(sample.shape[1]), min(MOST_PARTS, -(-sample.shape[1] // 2))):
        own = np.unique(sample[:, part], axis=0).astype(np.float64)
        middle = own[np.unique(np.linspace(0, len(own) - 1, min(centroids, len(own))).astype(int))]
        for _ in range(rounds):
            of = _nearest(own, middle)
            count = np.bincount(of, minlength=len(middle))
            sums = np.stack([np.bincount(of, c, len(middle)) for c in own.T], axis=1)
            middle = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], middle)
        out.append(np.unique(np.rint(middle).astype(np.int64), axis=0))
    return out


def _nearest(rows: np.ndarray, middle: np.ndarray) -> np.ndarray:
    middle = middle.astype(np.float64)
    return np.argmin((middle**2).sum(1)[None] - 2 * (rows.astype(np.float64) @ middle.T), axis=1)


def _parts(books: list[np.ndarray]) -> list[slice]:
    ends = np.cumsum([0, *(b.shape[1] for b in books)])
    return [slice(a, b) for a, b in zip(ends[:-1], ends[1:])]


def encode(x: np.ndarray, books: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(codes (rows, parts), residual lengths rounded up)."""
    codes = np.empty((len(x), len(books)), np.uint8)
    left = np.zeros(len(x))
    for m, (at, book) in enumerate(zip(_parts(books), books)):
        codes[:, m] = _nearest(x[:, at], book)
        left += ((x[:, at] - book[codes[:, m]]).astype(np.float64) ** 2).sum(1)
    return codes, np.sqrt(left) * (1 + 1e-9)


def looked_up(q: np.ndarray, codes: np.ndarray, books: list[np.ndarray]) -> np.ndarray:
    """(anchors, rows): each anchor's inner products with the rows' centroids, added up from its table. Whole numbers;
    sums that 32 bits hold are added up in these."""
    most = np.sqrt((q.astype(np.float64) ** 2).sum(1).max(initial=0)) * np.sqrt(sum((b.astype(np.float64) ** 2).sum(1).max() for b in books))
    kind = np.int32 if most < 2**30 else np.int64
    total = np.zeros((len(codes), len(q)), kind)
    for m, (at, book) in enumerate(zip(_parts(books), books)):
        table = (book @ q[:, at].T).astype(kind)
        total += table.take(codes[:, m], axis=0)
    return np.ascontiguousarray(total.T)


@dataclass
class Shard:
    ids: np.ndarray
    labels: np.ndarray
    keys: np.ndarray
    x: np.ndarray
    codes: np.ndarray
    left: np.ndarray

    def score(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact: long products wrap, but the sums fit."""
        return self.x[rows].astype(np.int64) @ q

    def best(self, rows: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        """The places of the k first: the highest score, then the smallest id."""
        if len(rows) > 8 * k:  # ties at the last place stay
            keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        else:
            keep = np.arange(len(rows))
        return keep[np.lexsort((self.ids[rows[keep]], -scores[keep]))[:k]]


def best_of(shard: Shard, q: np.ndarray, rows: np.ndarray, rough: np.ndarray, bound: np.ndarray, low: int, high: int | None, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, scores) of the k first of `rows` with low <= score <= high. rough and bound: looked-up sums, falling, and how
    far the scores may be from them."""
    widest = bound.max(initial=0)
    begin = 0 if high is None else int(np.searchsorted(-rough, -(high + widest)))
    raisers = np.arange(begin if high is None else int(np.searchsorted(-rough, -high)), len(rows))[: max(RAISERS, k)]
    scores = shard.score(q, rows[raisers])
    inside = np.sort(scores[(scores >= low) & (scores <= high if high is not None else True)])
    least = max(low, int(inside[-k])) if len(inside) >= k else low
    end = int(np.searchsorted(-rough, -(least - widest), side="right"))
    at = np.arange(begin, end)
    at = at[(rough[at] + bound[at] >= least) & (rough[at] - bound[at] <= high if high is not None else True)]
    scores = shard.score(q, rows[at])
    fit = (scores >= least) & (scores <= high if high is not None else True)
    at, scores = at[fit], scores[fit]
    first = shard.best(rows[at], scores, k)
    return rows[at[first]], scores[first]


def window(positive_score: int) -> tuple[int, int] | None:
    """Scores n with 50 * p <= 100 * n <= 95 * p; none for p below zero."""
    return None if positive_score < 0 else (-(-positive_score // 2), positive_score - -(-positive_score // 20))


def _falling(rough: np.ndarray, bound: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rough = rough[rows].astype(np.int64)
    order = np.argsort(-rough, kind="stable")
    return rows[order], rough[order], bound[rows[order]]


def _bounds(q: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Whole numbers, rounded up."""
    return np.ceil(np.sqrt((q.astype(np.float64) ** 2).sum()) * (1 + 1e-9) * left).astype(np.int64) + 1


def _packed(rows: pa.Table, books: list[np.ndarray]) -> dict:
    ids, labels, keys = (rows.column(c).to_numpy() for c in ("vec_id", "label", "key"))
    x = rows.column("x").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    _, one = np.unique(np.stack([keys, ids, labels]), axis=1, return_index=True)  # equal rows are one
    ids, labels, keys, x = ids[one], labels[one], keys[one], x[one]
    codes, left = encode(x, books)
    small = x.astype(np.int16) if np.abs(x).max(initial=0) < 1 << 15 else x
    return {"ids": ids, "labels": labels, "keys": keys, "x": small, "codes": codes, "left": left}


_FIELDS = {"ids": "<i8", "labels": "<i8", "keys": "<i8", "x": None, "codes": "u1", "left": "<f8"}
_SHARD = "shard int, kind string, " + ", ".join(f"{c} binary" for c in _FIELDS)


def _open(row: pd.Series) -> Shard:
    of = {c: np.frombuffer(row[c], kind or row["kind"]) for c, kind in _FIELDS.items()}
    n = len(of["ids"])
    return Shard(of["ids"], of["labels"], of["keys"], of["x"].reshape(n, -1), of["codes"].reshape(n, -1), of["left"])


def shards_of(rows: DataFrame, books: list[np.ndarray], n_rows: int, size: int, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """(the written shards, their number)."""
    n = max(1, -(-n_rows // max(1, min(shard_rows, SHARD_BYTES // (8 * size)))))

    def pack(table: pa.Table) -> pa.Table:
        of = _packed(table, books)
        one = {"shard": pa.array([table.column("shard")[0].as_py()], pa.int32()), "kind": pa.array([of["x"].dtype.str])}
        return pa.table(one | {c: pa.array([np.ascontiguousarray(of[c]).tobytes()], pa.binary()) for c in _FIELDS})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(n)).cast("int"))
    return written(dealt.groupBy("shard").applyInArrow(pack, _SHARD), "negatives-shards"), n


def _visited(shards: DataFrame, n_shards: int, asked: DataFrame, n_blocks: int, visit, schema: str) -> DataFrame:
    """What visit(shard, anchors) gives for each shard and each block of anchors."""
    to = asked.withColumn("block", F.pmod(F.xxhash64("key", F.lit(2)), F.lit(n_blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    held = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def run(_: tuple, shard: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        found = list(visit(_open(shard.iloc[0]), anchors)) if len(shard) and len(anchors) else []
        names = [c.split()[0] for c in schema.split(", ")]
        return pd.DataFrame({c: np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i, c in enumerate(names)})

    return held.groupBy("shard", "block").cogroup(to.groupBy("shard", "block")).applyInPandas(run, schema)


def mine(vectors: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, shard_rows: int = SHARD_ROWS, anchor_block: int = ANCHOR_BLOCK) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row of `vectors` (vec_id, label,
    embedding) for which the condition `anchors` on vec_id holds, and each of its first `positives` rows of the same label,
    the first `negatives` rows of other labels whose score lies in the positive's window."""
    spark = vectors.sparkSession
    rows = written(whole_rows(vectors), "negatives-rows")
    counted = rows.agg(F.count("*"), F.max(F.size("x")), F.count(F.when(anchors, 1))).first()
    n_rows, size = counted[0], counted[1] or 1
    if not n_rows:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    most = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * size)))
    # Hashes of distinct rows are even, so few more rows than asked for are sorted; equal rows share a hash.
    near = rows.select("key", "x").withColumn("h", F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1 << 40))).filter(F.col("h") < F.lit(int(min(1.0, 2.0 * most / n_rows) * (1 << 40)))).distinct()
    sample = near.orderBy("h", "key").limit(most).select("x").toPandas()
    if not len(sample):
        sample = rows.orderBy("key").limit(1).select("x").toPandas()
    books = codebooks(np.stack(sample["x"].to_list()).astype(np.int64))
    shards, n_shards = shards_of(rows, books, n_rows, size, shard_rows)
    n_blocks = max(1, -(-counted[2] // anchor_block))
    asked = written(rows.filter(anchors).distinct(), "negatives-anchors")

    def first_visit(shard: Shard, asked: pd.DataFrame) -> Iterator[tuple]:
        for at in range(0, len(asked), TOGETHER):
            part = asked.iloc[at : at + TOGETHER]
            q = np.stack(part["x"].to_list()).astype(np.int64)
            rough = looked_up(q, shard.codes, books)
            for i, (key, own, label) in enumerate(zip(part["key"], part["vec_id"], part["label"])):
                same = np.flatnonzero((shard.labels == label) & ~((shard.keys == key) & (shard.ids == own)))
                if len(same):
                    found, scores = best_of(shard, q[i], *_falling(rough[i], _bounds(q[i], shard.left), same), -(1 << 62), None, positives)
                    yield np.full(len(found), key), np.full(len(found), own), shard.ids[found], shard.keys[found], scores

    met = _visited(shards, n_shards, asked, n_blocks, first_visit, "anchor long, anchor_id long, positive_id long, positive long, score long")
    order = Window.partitionBy("anchor", "anchor_id").orderBy(F.desc("score"), "positive_id", "positive")
    chosen = met.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= positives)
    of_anchor = chosen.groupBy("anchor", "anchor_id").agg(F.sort_array(F.collect_list(F.struct("nth", "positive_id", "score"))).alias("positives"))
    with_positives = asked.join(of_anchor, (F.col("key") == F.col("anchor")) & (F.col("vec_id") == F.col("anchor_id")))
    second = written(with_positives.select(
        "key", "vec_id", "label", "x", F.col("positives.nth").alias("nths"), F.col("positives.positive_id").alias("ids"), F.col("positives.score").alias("scores"),
    ), "negatives-positives")

    def second_visit(shard: Shard, asked: pd.DataFrame) -> Iterator[tuple]:
        for at in range(0, len(asked), TOGETHER):
            part = asked.iloc[at : at + TOGETHER]
            q = np.stack(part["x"].to_list()).astype(np.int64)
            rough = looked_up(q, shard.codes, books)
            for i, (key, own, label, nths, ids, scores) in enumerate(zip(part["key"], part["vec_id"], part["label"], part["nths"], part["ids"], part["scores"])):
                other = np.flatnonzero(shard.labels != label)
                if not len(other):
                    continue
                falling = _falling(rough[i], _bounds(q[i], shard.left), other)
                for nth, positive, p in zip(nths, ids, scores):
                    if (limits := window(int(p))) is None or limits[0] > limits[1]:
                        continue
                    found, exact = best_of(shard, q[i], *falling, *limits, negatives)
                    yield tuple(np.full(len(found), v) for v in (key, own, nth, positive, p)) + (shard.ids[found], shard.keys[found], exact)

    fields = "anchor long, anchor_id long, nth long, positive_id long, positive_score long, negative_id long, negative long, negative_score long"
    hits = _visited(shards, n_shards, second, n_blocks, second_visit, fields)
    order = Window.partitionBy("anchor", "anchor_id", "nth").orderBy(F.desc("negative_score"), "negative_id", "negative")
    ranked = hits.withColumn("rank", F.row_number().over(order).cast("int")).filter(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def turned_labels(vectors: DataFrame) -> DataFrame:
    """vectors whose label is one higher, modulo ten, where 7 divides vec_id."""
    label = F.col("label").cast("long")
    return vectors.select("vec_id", "embedding", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"))


ORACLE_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
inside AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM inside WHERE rank <= 3"""
