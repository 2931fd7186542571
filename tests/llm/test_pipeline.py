"""Each stage does its own work on what the one before it kept, and the whole equals running the stages by hand."""

from __future__ import annotations

import itertools
from collections import Counter

import corpus_pipeline
from tests.llm.test_operators import WORDS, brute_stats, check_pieces, jaccard, mix_targets, whole_ids
from trackloom.llm import secrets

DATA = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, before = docs.columns, docs.collect()
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        kept.append(docs.collect())
        assert i == 4 or docs.columns == columns
    quality, dedup, clean, mixed, packed = kept

    bad = {x.doc_id for x in spark.read.parquet(f"{DATA}/labels.parquet").collect() if x.quality == 0}
    stats = {x.doc_id: brute_stats(x.text) for x in before}
    failed = {i for i, s in stats.items() if s[0] < 50 or 100 * s[4] > 50 * s[0]}
    ids = {x.doc_id for x in quality}
    assert not ids & failed and not ids & bad
    assert len(ids) > 0.9 * len({x.doc_id for x in before} - failed - bad)

    stay = {x.doc_id for x in dedup}
    texts = {x.doc_id: x.text for x in quality}
    close = {(a, b): jaccard(texts[a], texts[b]) for a, b in itertools.combinations(sorted(texts), 2)}
    assert not [p for p, s in close.items() if s >= 0.85 and set(p) <= stay]
    assert {i for i in texts if max((s for p, s in close.items() if i in p), default=0) < 0.6} <= stay
    assert stay <= set(texts)

    assert {x.doc_id for x in clean} == {x.doc_id for x in dedup} and not any(secrets.find(x.text or "") for x in clean)
    text = {x.doc_id: x.text for x in dedup}
    assert all(x.text == text[x.doc_id] for x in clean if not secrets.find(text[x.doc_id] or ""))

    size = {x.doc_id: len(WORDS.findall(x.text)) for x in clean}
    sources, taken = Counter(), Counter()
    for x in clean:
        sources[x.source] += size[x.doc_id]
    for x in mixed:
        taken[x.source] += size[x.doc_id]
    goal = mix_targets(sources)
    assert all(abs(taken[s] - goal[s]) <= max(size.values()) for s in goal)
    assert max(Counter(x.doc_id for x in mixed).values()) <= 3

    expected = whole_ids([x.text for x in mixed])
    assert sum(x.length for x in packed) == sum(map(len, expected))
    once = {x.doc_id: i for x, i in zip(mixed, expected)}
    copies = Counter(x.doc_id for x in mixed)
    single = [x for x in packed if copies[x.doc_id] == 1]
    for doc in {x.doc_id for x in single}:
        assert sum(x.length for x in single if x.doc_id == doc) == len(once[doc])
    assert check_pieces([], {}) == (0, 0)

    whole = corpus_pipeline.run(spark, DATA)
    assert Counter(
        (x.doc_id, x.doc_tokens) for x in whole.filter("start = 0").collect()
    ) == Counter((x.doc_id, x.doc_tokens) for x in packed if x.start == 0)
