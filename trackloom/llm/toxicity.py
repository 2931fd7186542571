"""Toxicity by multiple-instance learning: sentence scores joined by noisy-or, trained from document labels only.

A sentence with features x has probability p = sigmoid(b + w.x); a document is toxic if any of its sentences is:
P = 1 - prod(1 - p). With S = sum(softplus(b + w.x)) that is 1 - exp(-S), so the labels' log-likelihood gives each
sentence its share of the blame. Features are words and their beginnings of four to six letters, which also meet words
with unknown endings; those that documents labelled 1 hold clearly more often are kept. All other sentences share the
bias, whose size keeps long clean documents low. The fitted sentence scores then locate the sentences to blame.

Training uses at most `max_labelled` labelled documents, picked by a hash of doc_id, and the `max_features` features
that tell most; with more, the least telling ones count as ordinary words. Scoring is one pass without shuffle.

Defined results: null or empty text has no sentence and scores 0; labels that are null or whose document is absent are
ignored, and a document with several labels counts as toxic if any says so; of rows that share a labelled doc_id the
least text is learned from; without labels of both kinds everything scores 0; repeated rows are scored each;
a row without a doc_id is scored, held out of nothing and not learned from; very long texts are read whole; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import bounded_sample, crc_bucket, ids_and_texts, labelled_texts, slices, written

SENTENCE_END = re.compile(r"[.!?]+\s+|\n+")
WORD = re.compile(r"\w+")
PREFIXES = (4, 5, 6)
#: Words whose scores a task keeps.
CACHED = 500_000


def sentences(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of each sentence, in code points."""
    at = 0
    for m in SENTENCE_END.finditer(text):
        if m.start() > at:
            yield at, m.end()
        at = m.end()
    if at < len(text):
        yield at, len(text)


def word_features(word: str) -> list[str]:
    return ["=" + word, *("^" + word[:n] for n in PREFIXES if len(word) >= n)]


class _Scores(dict):
    """Words' scores, computed when first met."""

    def __init__(self, weights: dict[str, float]):
        self.weights = weights

    def __missing__(self, word: str) -> float:
        score = sum(self.weights.get(f, 0.0) for f in word_features(word))
        if len(self) < CACHED:
            self[word] = score
        return score


@dataclass
class Model:
    bias: float = -math.inf
    weights: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.scores = _Scores(self.weights)
        self.plain = _softplus(self.bias)

    def __reduce__(self) -> tuple:
        return Model, (self.bias, self.weights)

    def score(self, text: str | None) -> float:
        """The document's probability."""
        total, n = 0.0, 0
        look_up = self.scores.__getitem__
        for s in SENTENCE_END.split(text.lower()) if text else ():
            if s:
                z = sum(map(look_up, WORD.findall(s)))
                if z:
                    total += _softplus(self.bias + z)
                else:
                    n += 1
        return -math.expm1(-(total + n * self.plain))

    def locate(self, text: str | None, least: float = 0.3) -> list[tuple[int, int, float]]:
        """(start, end, probability) of the sentences that reach `least`."""
        found = []
        for start, end in sentences(text or ""):
            p = -math.expm1(-_softplus(self.bias + sum(map(self.scores.__getitem__, WORD.findall(text[start:end].lower())))))
            if p >= least:
                found.append((start, end, p))
        return found


def _softplus(z: float) -> float:
    return z if z > 30 else math.log1p(math.exp(z)) if z > -700 else 0.0


def gain(pos: Column, neg: Column, n_pos: int, n_neg: int) -> Column:
    """Log-likelihood ratio of a feature's document counts against one share for both kinds."""
    share = (pos + neg) / (n_pos + n_neg)
    cells = ((pos, share * n_pos), (neg, share * n_neg), (n_pos - pos, (1 - share) * n_pos), (n_neg - neg, (1 - share) * n_neg))
    return sum((F.when(k > 0, 2 * k * F.log(k / e)).otherwise(0.0) for k, e in cells), F.lit(0.0))


def chosen_features(sample: DataFrame, n_pos: int, n_neg: int, max_features: int) -> list[str]:
    """Features that toxic documents of the sample (toxic, text) hold clearly more often, the best first. Tasks count
    documents by feature, Spark adds the counts up, and at most max_features names reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = {0: Counter(), 1: Counter()}
        for b in batches:
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                seen[toxic].update({f for w in set(WORD.findall(text.lower())) for f in word_features(w)})
        names = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *(pa.array([seen[k][n] for n in names], pa.int64()) for k in (1, 0))],
            names=["feature", "pos", "neg"],
        )

    found = sample.mapInArrow(count, "feature string, pos long, neg long").groupBy("feature").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
    )
    pos, neg = F.col("pos"), F.col("neg")
    often = (pos >= 3) & ((pos + 0.1) / (n_pos + 1) >= 4 * (neg + 0.1) / (n_neg + 1))
    rated = found.filter(often).withColumn("gain", gain(pos, neg, n_pos, n_neg)).filter("gain >= 12").orderBy(F.desc("gain"), "feature").limit(max_features)
    return [r["feature"] for r in rated.select("feature").collect()]


def described(sample: DataFrame, features: list[str]) -> DataFrame:
    """doc_id, toxic, plain (sentences without a chosen feature), sentences (the others' features by number)."""
    shared = sample.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(features)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, known = shared.value, {}
        for b in batches:
            plain, kept = [], []
            for text in b.column("text").to_pylist():
                own, n = [], 0
                for s in SENTENCE_END.split(text.lower()):
                    found = []
                    for w in WORD.findall(s):
                        if w not in known:
                            known[w] = [index[f] for f in word_features(w) if f in index]
                        found += known[w]
                    own += [found] if found else []
                    n += bool(s) and not found
                plain.append(n)
                kept.append(own)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("toxic"), pa.array(plain, pa.int64()), pa.array(kept, pa.list_(pa.list_(pa.int32())))],
                names=["doc_id", "toxic", "plain", "sentences"],
            )

    return sample.mapInArrow(run, "doc_id long, toxic int, plain long, sentences array<array<int>>")


def train(
    features: list[str], y: np.ndarray, plain: np.ndarray, sentences: list[list[np.ndarray]], rounds: int = 600,
    rate: float = 0.1, l2: float = 1e-6,
) -> Model:
    """Maximum likelihood of the noisy-or by Adam on all documents at once. While training it has a leak, one more
    chance per document whatever its sentences: labels that no sentence explains are laid to it and not to the bias,
    which would add up over long documents."""
    y, plain = np.asarray(y, float), np.asarray(plain, float)
    flat = [s for doc in sentences for s in doc]
    doc_of = np.repeat(np.arange(len(y)), [len(doc) for doc in sentences])
    rows = np.repeat(np.arange(len(flat)), [len(s) for s in flat]) if flat else np.zeros(0, np.int64)
    columns = np.concatenate(flat).astype(np.int64) if flat else np.zeros(0, np.int64)
    theta = np.zeros(len(features) + 2)  # weights, bias, leak
    theta[-2:] = -10.0, -4.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        w, b, leak = theta[:-2], theta[-2], theta[-1]
        z = b + np.bincount(rows, w[columns], len(doc_of))
        s = plain * np.logaddexp(0, b) + np.bincount(doc_of, np.logaddexp(0, z), len(y)) + np.logaddexp(0, leak)
        blame = (1 - y) - y / np.expm1(np.clip(s, 1e-9, 50))
        share = blame[doc_of] / (1 + np.exp(-z))
        to_words = np.bincount(columns, share[rows], len(features))
        rest = (share.sum() + (blame * plain).sum() / (1 + np.exp(-b)), blame.sum() / (1 + np.exp(-leak)))
        gradient = np.concatenate([to_words, rest]) / len(y)
        gradient[:-2] += l2 * w
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(float(theta[-2]), {f: float(theta[i]) for i, f in enumerate(features) if abs(theta[i]) > 1e-3})


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, max_labelled: int = 6000, max_features: int = 5000) -> Model:
    """The model of labelled documents; `usable` is a condition on doc_id that says which may be learned from."""
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("toxic"),
    ).filter("doc_id is not null and toxic is not null")
    known = known if usable is None else known.filter(usable)
    ids = F.broadcast(bounded_sample(known, "doc_id", max_labelled))  # at most max_labelled ids
    picked = known.join(ids, "doc_id").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    sample = written(labelled_texts(docs, picked).select("doc_id", "toxic", F.coalesce("text", F.lit("")).alias("text")), "toxicity-sample")
    n, n_pos = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < n_pos < n:
        return Model()
    features = chosen_features(sample, n_pos, n - n_pos, max_features)
    rows = described(sample, features).toPandas().sort_values(["doc_id", "plain"])
    return train(features, rows["toxic"].to_numpy(), rows["plain"].to_numpy(), rows["sentences"].to_list())


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score, predicted, offending: array of (start, end, p), the sentences that reach the threshold, in
    documents that do."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    spot = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in slices(batches, "text", 8 << 20):
            texts = b.column("text").to_pylist()
            scores = [model.score(t) for t in texts]
            spots = [[dict(zip(("start", "end", "p"), x)) for x in model.locate(t, threshold)] if s >= threshold else [] for t, s in zip(texts, scores)]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(spots, pa.list_(spot)),
                ],
                names=["doc_id", "score", "predicted", "offending"],
            )

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, score double, predicted int, offending array<struct<start: int, end: int, p: double>>")


def held_out_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, fold: int = 2, max_labelled: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted, n_offending: learned without the held-out fold of doc_ids, applied to all."""
    model = fit(docs, labels, crc_bucket(F.col("doc_id"), folds) != fold, max_labelled)
    return score(docs, model).select(
        "doc_id", F.coalesce(crc_bucket(F.col("doc_id"), folds) == fold, F.lit(False)).alias("held_out"), "score", "predicted",
        F.size("offending").cast("long").alias("n_offending"),
    )
