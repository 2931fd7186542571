"""Hard negatives against all pairs, with quantisation that is coarse and shards that are small."""

from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import catalogue, hard_negatives

SCHEMA = "vec_id long, embedding array<double>, label int, score string, shard string"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, "s", "t") for i, v, label in rows], SCHEMA)


def brute(rows, anchor, positives=5, negatives=3):
    usable = sorted({(i, tuple(math.floor(256 * c) for c in v), label) for i, v, label in rows if i is not None and label is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)})
    out = []
    for a in usable:
        if not anchor(a[0]):
            continue
        ranked = sorted(((-sum(p * q for p, q in zip(a[1], b[1])), b[0], b[2]) for b in usable if b is not a))
        for s, positive, _ in [x for x in ranked if x[2] == a[2]][:positives]:
            inside = [x for x in ranked if x[2] != a[2] and 50 * -s <= 100 * -x[0] <= 95 * -s][:negatives]
            out += [(a[0], positive, k, n, -s, -score) for k, (score, n, _) in enumerate(inside, 1)]
    return sorted(out)


def mined(df, **how):
    return sorted(tuple(x[c] for c in NAMES) for x in hard_negatives.mine(df, F.col("vec_id") % 5 == 0, **how).collect())


def vectors(n, d, seed, centres=4):
    r = np.random.default_rng(seed)
    v = r.normal(size=(centres, d))[r.integers(centres, size=n)] + r.normal(0, 0.5, (n, d))
    return [(i, [float(c) for c in v[i]], int(r.integers(3))) for i in range(n)]


@pytest.mark.parametrize("d", [1, 2, 7, 40])
def test_equals_all_pairs(spark, d, monkeypatch):
    """Four centroids a part leave long residuals; small shards and blocks make many visits."""
    rows = vectors(230, d, d)
    want = brute(rows, lambda i: i % 5 == 0)
    assert len(want) > 40
    assert mined(table(spark, rows)) == want
    monkeypatch.setattr(hard_negatives, "SAMPLE_ROWS", 4)
    monkeypatch.setattr(hard_negatives, "TOGETHER", 3)
    assert mined(table(spark, rows), shard_rows=40, anchor_block=9) == want


def test_odd_rows(spark):
    """Nulls, repeated rows, other rows of one id, ties, copies by the hundred, vectors that are zero or of another length."""
    rows = vectors(60, 6, 9)
    rows += [rows[0], rows[5], (5, rows[7][1], 1), (200, None, 1), (205, rows[1][1], None), (None, rows[2][1], 1), (210, [1.0, None, 0.0, 0.0, 0.0, 0.0], 2), (215, [float("nan")] * 6, 2), (220, [float("-inf")] * 6, 0)]
    rows += [(1000 + i, rows[10][1], i % 2) for i in range(300)] + [(2000, [0.0] * 6, 1), (2005, [0.0] * 6, 0)]
    want = brute(rows, lambda i: i % 5 == 0)
    far = [(3000, [1.0], 1), (3005, [1e9] * 6, 1), (3010, [], 1)]  # take no part
    assert mined(table(spark, rows + far), shard_rows=50) == want and want
    assert mined(table(spark, [])) == mined(table(spark, [(5, None, 1)])) == mined(table(spark, rows[:1])) == []
    assert mined(table(spark, [(i, [1.0, 2.0], i) for i in range(20)])) == []  # no two of one label


def test_large_scores_are_exact(spark):
    """Scores up to 2**61, where a product in double precision would be off."""
    r = np.random.default_rng(4)
    rows = [(i, [float(c) for c in v], i % 2) for i, v in enumerate(r.normal(0, 2.0**20, (80, 3)) + 2.0**20)]
    want = brute(rows, lambda i: i % 5 == 0)
    assert mined(table(spark, rows), shard_rows=30) == want and max(x[4] for x in want) > 2**54


def test_windows():
    for p in [*range(-50, 400), 2**61 - 1, 2**61]:
        low_high = hard_negatives.window(p)
        inside = [n for n in range(-60, 420) if 50 * p <= 100 * n <= 95 * p] if p < 400 else None
        if low_high is None:
            assert p < 0 and not inside
        elif inside is not None:
            assert inside == list(range(low_high[0], low_high[1] + 1))
        else:
            assert 50 * p <= 100 * low_high[0] < 50 * p + 100 and 95 * p - 100 < 100 * low_high[1] <= 95 * p


def test_bounds_hold():
    r = np.random.default_rng(5)
    x, q = np.floor(256 * r.normal(size=(500, 9))).astype(np.int64), np.floor(256 * r.normal(size=(20, 9))).astype(np.int64)
    books = hard_negatives.codebooks(x[:50], 8)
    codes, left = hard_negatives.encode(x, books)
    rough = hard_negatives.looked_up(q, codes, books).astype(np.int64)
    bounds = np.stack([hard_negatives._bounds(v, left) for v in q])
    assert (np.abs(q @ x.T - rough) <= bounds).all() and (rough != q @ x.T).any()
    assert np.allclose(((x - np.concatenate([b[codes[:, m]] for m, b in enumerate(books)], axis=1)) ** 2).sum(1), left**2)


def test_registered_query(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    want = con.execute(hard_negatives.ORACLE_SQL).fetchall()
    got = catalogue.QUERIES["op13_hard_negatives"](spark, d)
    assert got.columns == NAMES and sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 100
