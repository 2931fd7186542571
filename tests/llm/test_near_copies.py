"""Groups of near copies against brute force at the very limit of 0.8."""

from __future__ import annotations

import itertools

import numpy as np

from tests.llm.test_operators import DATA, jaccard
from trackloom.llm import simhash


def brute_groups(texts, limit=0.8):
    root = {i: i for i in texts}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(sorted(texts), 2):
        if jaccard(texts[i], texts[j]) >= limit:
            root[max(top(i), top(j))] = min(top(i), top(j))
    return {i: top(i) for i in texts}


def groups(spark, texts):
    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    return {x.doc_id: x.component_id for x in simhash.similar_groups(table).collect()}


def edited(r, words, n):
    words = list(words)
    for i in r.choice(len(words), n, replace=False):
        words[i] = f"e{r.integers(1 << 30)}"
    return words


def test_pairs_either_side_of_the_limit(spark):
    r, texts = np.random.default_rng(5), {}
    for k in range(60):
        words = [f"w{r.integers(1 << 30)}" for _ in range(300)]
        texts[2 * k], texts[2 * k + 1] = " ".join(words), " ".join(edited(r, words, 4 + k % 9))
    similar = [jaccard(texts[2 * k], texts[2 * k + 1]) for k in range(60)]
    assert sum(0.74 < s < 0.8 for s in similar) > 5 and sum(0.8 <= s < 0.86 for s in similar) > 5
    assert groups(spark, texts) == brute_groups(texts)


def test_crowd_at_the_limit(spark):
    r, texts = np.random.default_rng(6), {}
    for k in range(4):
        words = [f"w{r.integers(1 << 30)}" for _ in range(300)]
        texts |= {100 * k + i: " ".join(edited(r, words, 3 + i % 2)) for i in range(25)}
    expected = brute_groups(texts)
    assert 4 < len(set(expected.values())) < len(texts)
    assert groups(spark, texts) == expected


def test_given_documents(spark):
    texts = {x.doc_id: x.text for x in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    assert groups(spark, texts) == brute_groups(texts)
