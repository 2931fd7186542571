"""Bounded samples of tables with repeated keys, and the terms of a binomial tail."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import ann, common, language_id, quality, toxicity, url_filter


@pytest.mark.parametrize("times", [1, 10])
@pytest.mark.parametrize("n", [3, 100, 1000])
def test_repeated_keys_take_no_room(spark, n, times):
    table = spark.range(5000).select(F.col("id").alias("doc_id")).crossJoin(spark.range(times)).select("doc_id")
    want = spark.range(5000).select("id").orderBy(F.md5(F.col("id").cast("string")), "id").limit(n).collect()
    assert sorted(x[0] for x in common.bounded_sample(table, "doc_id", n).collect()) == sorted(x[0] for x in want)


def test_one_bound_for_all_values(spark):
    """300 languages share the bound: no more than so many documents in all, one at least of each kept language."""
    table = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("l"), F.col("id") % 300).alias("lang"))
    for n, values, each in ((2000, 256, 7), (100, 100, 1)):
        got = common.bounded_sample(table.union(table), "doc_id", n, "lang").groupBy("lang").count().collect()
        assert len(got) == values and {x["count"] for x in got} == {each}
    assert common.bounded_sample(table.filter("false"), "doc_id", 5, "lang").count() == 0


@pytest.mark.parametrize("right, covered", [(1, 1), (3, 10), (500, 999), (501, 1000), (15_000, 20_000), (20_000, 20_000)])
@pytest.mark.parametrize("share", [0.1, 0.5, 0.74])
def test_binomial_tail(right, covered, share):
    logs = [math.log(math.comb(covered, k)) + k * math.log(share) + (covered - k) * math.log1p(-share) for k in range(right, covered + 1)][:4000]
    top = max(logs)
    assert quality._by_chance(right, covered, share) == pytest.approx(min(1.0, math.exp(top) * sum(math.exp(v - top) for v in logs)), rel=1e-6, abs=1e-300)


def test_binomial_tail_ends():
    assert quality._by_chance(0, 5, 0.5) == 1 and quality._by_chance(6, 5, 0.5) == 0 and quality._by_chance(1, 5, 0.0) == 0 and quality._by_chance(5, 5, 1.0) == 1
    assert 0.45 < quality._by_chance(501, 1000, 0.5) < 0.5 < quality._by_chance(500, 999, 0.5) + 0.01


DOC = "doc_id long, text string, lang string"


def test_repeated_and_null_ids(spark):
    """Rows of one id count once in what is learned, each gets its result; null ids are scored and held out of nothing."""
    texts = [(i, f"alpha beta gamma {i} " * 5 if i % 2 else f"le la les une {i} " * 5, "en" if i % 2 else "fr") for i in range(200)]
    docs = spark.createDataFrame(texts + texts[:20] + [(None, "alpha beta gamma", "en")], DOC)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(200)] * 3 + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    scores = toxicity.held_out_scores(docs, labels).collect()
    assert len(scores) == 221 and [x.held_out for x in scores if x.doc_id is None] == [False]
    languages = language_id.held_out_labels(docs).collect()
    assert len(languages) == 221 and [x.held_out for x in languages if x.doc_id is None] == [False]
    assert language_id.label(docs.filter("false"), None).count() == 0 and quality.judge(docs.filter("false"), labels).count() == 0
    assert {x.lang_pred for x in language_id.label(docs, None).collect()} == {"und"}


@pytest.mark.parametrize("offset", [0.0, 1000.0, 10_000.0, 1e100])
def test_neighbours_far_from_zero(spark, offset):
    """Recall doesn't depend on where the vectors lie, as far as doubles tell them apart."""
    r = np.random.default_rng(0)
    v = r.normal(size=(3000, 24)) * max(1.0, offset / 1e9) + offset
    table = spark.createDataFrame([(i, [float(c) for c in x]) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {}
    for x in ann.nearest(table, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(x.query_id, set()).add(x.vec_id)
    scaled = (v - offset) / max(1.0, offset / 1e9)
    hits = 0
    for q in range(0, 3000, 100):
        far = ((scaled - scaled[q]) ** 2).sum(1)
        far[q] = np.inf
        hits += len(got[q] & set(np.argsort(far)[:10].tolist()))
    assert hits / 300 > 0.95


def test_hosts_of_many_labels(spark):
    """Keys are linear in the labels; a listed parent is found below any number of them."""
    host = ".".join(f"l{i}" for i in range(50_000))
    assert len(url_filter.domain_keys(host)) == 50_000 and url_filter.domain_keys("b.c")[-1] == url_filter.domain_keys("a.b.c")[1] != url_filter.domain_keys("a.b.c")[2]
    urls = [(1, f"http://{host}.free-casino.org/x"), (2, f"http://{host}.plain.org/x"), (None, "http://plain.org/y"), (3, "http://../"), (4, "http://" + "." * 3000)]
    table = spark.createDataFrame(urls, "page_id long, url string")
    assert sorted((x.page_id or 0, x.listed) for x in url_filter.judge(table).collect()) == [(0, False), (1, True), (2, False), (3, False), (4, False)]
