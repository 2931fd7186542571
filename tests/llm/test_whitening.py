"""Whitening against a whole eigendecomposition in numpy, and the iteration where three blocks don't span the space."""

from __future__ import annotations

import math

import numpy as np
import pytest

from trackloom.llm import catalogue, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, x string, n string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "n") for i, v in rows], SCHEMA)


def brute(rows):
    """vec_id -> (n, deviation, whitened, explained) of each usable row, in order."""
    usable = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in usable}), np.int64)
    n, total = len(fit), fit.sum(0)
    centred = (n * fit - total) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    k = min(16, len(values))
    values, vectors = values[::-1], vectors[:, ::-1][:, :k]
    return [
        (i, n, sum((n * v - s) ** 2 for v, s in zip(x, total.tolist())), (n * np.array(x) - total) / n @ vectors / np.sqrt(np.where(values[:k] > 0, values[:k], np.nan)), values[:k] / values.sum())
        for i, x in usable
    ]


def check(df, rows, rank):
    want, got = brute(rows), {}
    assert df.columns == [c.split()[0] for c in whitening.SCHEMA.split(", ")]
    for x in df.collect():
        got.setdefault(x.vec_id, []).append(x)
    assert sum(map(len, got.values())) == sum(len(w[3]) for w in want) and {w[0] for w in want} == set(got)
    for i, n, deviation, white, explained in want:
        mine = sorted(got[i], key=lambda x: x.component)
        mine = mine[: len(white)] if len(mine) > len(white) else mine
        assert {(x.n, x.deviation) for x in mine} == {(n, deviation)} or len({w[0] for w in want}) < len(want)
        for x in got[i]:
            assert x.identity_error < 1e-9
            if x.component <= rank:
                assert x.explained == pytest.approx(explained[x.component - 1], rel=1e-9)
            else:
                assert x.whitened is None and x.explained == 0
    by_row = {w[0]: w[3] for w in want}
    for c in range(min(rank, len(want[0][3]))):
        pairs = [(x.whitened, by_row[x.vec_id][c]) for v in got.values() for x in v if x.component == c + 1]
        sign = np.sign(sum(a * b for a, b in pairs))
        assert max(abs(a - sign * b) for a, b in pairs) < 1e-8


def test_small_tables(spark):
    r = np.random.default_rng(0)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(r.normal(0, [3, 1, 2, 0.5, 4], (60, 5)))]
    odd = [(100, None), (101, [1.0, float("nan"), 0.0, 0.0, 0.0]), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [float("inf")] * 5), (104, [1.0, 2.0]), (105, [])]
    check(whitening.whiten(table(spark, rows + odd)), rows, 5)
    assert whitening.whiten(table(spark, rows + odd)).filter("vec_id > 99").count() == 0
    # Copies are one vector of the fit list, however many; each row comes back.
    copies = rows + [(1000 + i, rows[0][1]) for i in range(50)]
    check(whitening.whiten(table(spark, copies)), copies, 5)
    twice = whitening.whiten(table(spark, rows + rows[:3] + [(None, rows[5][1])])).collect()
    assert len(twice) == 5 * 64 and sum(x.vec_id is None for x in twice) == 5 and {x.n for x in twice} == {60}


def test_no_variance(spark):
    """Equal rows, a single row, fewer rows than dimensions: components without variance are null, and no row is lost."""
    same = whitening.whiten(table(spark, [(i, [1.0, 2.0, 3.0]) for i in range(4)])).collect()
    assert len(same) == 12 and all((x.n, x.deviation, x.whitened, x.explained, x.identity_error) == (1, 0, None, 0.0, 0.0) for x in same)
    few = [(i, [float(c) for c in v]) for i, v in enumerate(np.random.default_rng(1).normal(0, 9, (4, 20)))]
    check(whitening.whiten(table(spark, few)), few, 3)
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [(1, None)])).collect() == []


def test_far_and_large_values(spark):
    r = np.random.default_rng(2)
    far = [(i, [1e9 + float(a), -1e9 + float(b)]) for i, (a, b) in enumerate(r.normal(0, 5, (40, 2)))]
    check(whitening.whiten(table(spark, far)), far, 2)
    large = whitening.whiten(table(spark, [(0, [1e300, 0.0]), (1, [-1e300, 1.0]), (2, [0.0, 0.0])])).collect()
    assert len(large) == 6 and all(x.deviation is None for x in large if x.vec_id < 2) and all(math.isfinite(x.whitened) for x in large if x.component == 1)


@pytest.mark.parametrize("spread", ["flat", "steep", "equal pairs"])
def test_iteration_in_many_dimensions(spread):
    """150 dimensions, blocks of 24: eigenvectors come out to rounding, also where eigenvalues are close or equal."""
    r = np.random.default_rng(3)
    basis = np.linalg.qr(r.normal(size=(150, 150)))[0]
    values = {"flat": np.linspace(1.1, 0.9, 150), "steep": 0.8 ** np.arange(150), "equal pairs": np.repeat(np.linspace(2, 1, 75), 2)}[spread]
    matrix, calls = (basis * values) @ basis.T, []
    got, vectors = whitening.lobpcg(lambda b: calls.append(b.shape) or matrix @ b, 150, 16)
    assert np.allclose(got, values[:16], rtol=1e-10) and np.allclose(vectors.T @ vectors, np.eye(16), atol=1e-10)
    assert np.abs(matrix @ vectors - vectors * got).max() < 1e-10 and max(c[1] for c in calls) <= 48
    if spread == "flat":
        assert np.abs(np.abs(vectors.T @ basis[:, :16]) - np.eye(16)).max() < 1e-6


def test_registered_query(spark):
    df = catalogue.QUERIES["op11_whitening"](spark, "/root/testdata/sf0.001")
    rows = [(x.vec_id, [float(c) for c in x.embedding]) for x in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    check(df, rows, 16)
