"""The registered toxicity query, scored again word by word, and deaf to the labels it must not see."""

from __future__ import annotations

import math
import re
import zlib

import pytest
from pyspark.sql import functions as F

from trackloom.llm import catalogue, toxicity
from trackloom.llm.common import crc_bucket

DATA = "/root/testdata/sf0.001"


def plain_score(model, text):
    clean = 1.0
    for sentence in re.split(r"[.!?]+\s+|\n+", (text or "").lower()):
        if sentence:
            z = model.bias
            for word in re.findall(r"\w+", sentence):
                z += model.weights.get("=" + word, 0.0) + sum(model.weights.get("^" + word[:n], 0.0) for n in (4, 5, 6) if len(word) >= n)
            clean *= 1 - 1 / (1 + math.exp(-z)) if z > -700 else 1.0
    return 1 - clean


def test_scores_and_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    usable = crc_bucket(F.col("doc_id"), 4) != 2
    model = toxicity.fit(docs, labels, usable)
    assert len(model.weights) > 5
    texts = {x.doc_id: x.text for x in docs.collect()}
    got = {x.doc_id: x for x in catalogue.QUERIES["op1_toxicity"](spark, DATA).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert got[i].score == pytest.approx(plain_score(model, text), abs=1e-9) and got[i].predicted == int(got[i].score >= 0.3)
    flipped = labels.withColumn("toxic", F.when(usable, F.col("toxic")).otherwise(1 - F.col("toxic")))
    again = toxicity.fit(docs, flipped, usable)
    assert again.bias == model.bias and again.weights == model.weights
