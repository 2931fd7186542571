"""Quality rules: a decision list of threshold conjunctions, learned from labelled statistics by sequential covering.

A rule for the rejected class grows by the condition (statistic above or below a threshold) with the best gain in
information per rejected document that stays covered, until it covers no kept document of the growing part; it is
pruned from its end while that does not lower (p - n) / (p + n) on the pruning part. A rule joins the list if it is
right often enough on both parts and more often on the pruning part than chance explains; the documents that it covers
leave the training set. The rejected documents of a rule that fails are set aside and learning goes on, so a rare kind
of junk is found after a hopeless one. The list is emitted as ordered Spark conditional expressions (first rule that
holds decides, else keep), readable as text. It has at most `max_rules` rules of at most `max_conditions` conditions;
what would need more is kept.

Statistics come from whole texts. Words are runs outside ASCII white space. Rules are learned from at most
`max_labelled` labelled documents, picked by a hash of doc_id; statistics of those alone reach the driver.

Defined results: null text has no words, so fails the base rules; labels that are null or whose document is absent are
ignored, and a document with several labels counts by its smallest; of rows that share a labelled doc_id the least text
is learned from; without labels of both kinds no rule is learned; repeated rows are judged each, rows without a
doc_id too, which are not learned from; very long texts are read whole; an empty table gives an empty result; `keep` carries all columns, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import bounded_sample, ids_and_texts, labelled_texts, plain_names, slices

SYMBOLS = b"#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
END_MARKS = (".", "!", "?", '"', ":", ";")
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MIN_WORDS = 50


def base_stats(text: str | None) -> tuple[int, int, int, int, int, int, int, float, float, float]:
    """The five base statistics, then lines with a word, lines without an end mark, shares of distinct words, of digits
    and of upper-case letters among characters."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    word_chars = len(text) - sum(map(text.count, WHITE))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    repeats = 0
    if n >= 3:
        grams = list(zip(words, words[1:], words[2:]))
        if len(set(grams)) < len(grams):
            repeats = _repeated(grams, n)
    unended = sum(not x.rstrip(WHITE).endswith(END_MARKS) for x in lines)
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    return n, word_chars, n_symbols, len(lines) - len(set(lines)), repeats, len(lines), unended, len(set(words)) / max(n, 1), digits / max(word_chars, 1), upper / max(word_chars, 1)


def _repeated(grams: list, n: int) -> int:
    """Words in windows that are found twice or more."""
    first: dict = {}
    covered = np.zeros(n, bool)
    for i, gram in enumerate(grams):
        j = first.setdefault(gram, i)
        if j != i:
            covered[i : i + 3] = True
            covered[j : j + 3] = True
    return int(covered.sum())


STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_unended long, distinct_share double, digit_share double, upper_share double"


def _stat_names() -> list[str]:
    return [x.split()[0] for x in STATS.split(", ")]


def with_stats(docs: DataFrame, carry: list[str], into: str = "stats__", text: str = "text") -> DataFrame:
    """The columns in `carry` and a struct of statistics of the text: no shuffle. Names have no dots."""
    schema = docs.select(*carry, F.lit(None).cast("struct<" + ", ".join(x.replace(" ", ":") for x in STATS.split(", ")) + ">").alias(into)).schema
    source = docs if text in carry else docs.select(*carry, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, 8 << 20):
            columns = list(zip(*map(base_stats, b.column(text).to_pylist())))
            types = [pa.int64()] * 7 + [pa.float64()] * 3
            stats = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_stat_names())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carry), stats], names=[*carry, into])

    return source.mapInArrow(run, schema)


def features(of: str = "stats__") -> dict[str, Column]:
    s = {n: F.col(f"{of}.{n}").cast("double") for n in _stat_names()}
    words, lines = F.greatest(s["n_words"], F.lit(1.0)), F.greatest(s["n_lines"], F.lit(1.0))
    more = {
        "mean_word": s["word_chars"] / words, "symbol_share": s["n_symbols"] / words, "dup_line_share": s["n_dup_lines"] / lines, "repeat_share": s["n_repeat_words"] / words,
        "words_per_line": s["n_words"] / lines, "unended_lines": s["n_unended"] / lines, "distinct_share": s["distinct_share"], "digit_share": s["digit_share"], "upper_share": s["upper_share"],
    }
    return {**more, **{n: s[n] for n in BASE}}  # of equal conditions learning takes the first: shares before counts


def base_failed(of: str = "stats__") -> Column:
    n = F.col(f"{of}.n_words")
    return (n < MIN_WORDS) | (F.col(f"{of}.n_repeat_words") * 100 > n * 50)


@dataclass(frozen=True)
class Condition:
    stat: str
    above: bool
    threshold: float

    def holds(self, x: pd.DataFrame) -> np.ndarray:
        v = x[self.stat].to_numpy()
        return v > self.threshold if self.above else v <= self.threshold

    def column(self, features: dict[str, Column]) -> Column:
        c = features[self.stat]
        return c > self.threshold if self.above else c <= self.threshold

    def __str__(self) -> str:
        return f"{self.stat} {'>' if self.above else '<='} {self.threshold:g}"


@dataclass(frozen=True)
class DecisionList:
    """Rules for rejection, in order; else keep."""

    rules: tuple[tuple[Condition, ...], ...] = ()

    def kept(self, features: dict[str, Column]) -> Column:
        found = F.lit(True)
        for rule in reversed(self.rules):
            holds = F.lit(True)
            for c in rule:
                holds = holds & c.column(features)
            found = F.when(holds, F.lit(False)).otherwise(found)
        return found

    def rejects(self, x: pd.DataFrame) -> np.ndarray:
        out = np.zeros(len(x), bool)
        for rule in self.rules:
            out |= _covers(rule, x)
        return out

    def __str__(self) -> str:
        return "\n".join(f"reject if {' and '.join(map(str, r))}" for r in self.rules) + "\nelse keep"


def _covers(rule: tuple[Condition, ...], x: pd.DataFrame) -> np.ndarray:
    held = np.ones(len(x), bool)
    for c in rule:
        held &= c.holds(x)
    return held


def learn(
    x: pd.DataFrame, bad: np.ndarray, max_rules: int = 12, max_conditions: int = 4, thresholds: int = 48, precision: float = 0.95,
    chance: float = 0.01, seed: int = 7,
) -> DecisionList:
    """Sequential covering over statistics x (a column each) and labels `bad`; columns are tried in their order. A rule
    must reach the precision, and on the pruning part be right so often that documents drawn at random would be with a
    probability under `chance`, for the n-th rule tried an n-th of it; or on both parts together under a ten-thousandth
    of that, which some documents can show."""
    rules: list[tuple[Condition, ...]] = []
    order = np.random.default_rng(seed).permutation(len(x))
    grow_rows, prune_rows = order[: len(order) * 2 // 3], order[len(order) * 2 // 3 :]
    names = list(x.columns)
    for attempt in range(1, 2 * max_rules + 1):
        if len(rules) == max_rules or bad[grow_rows].sum() < 3 or bad[grow_rows].all():
            break
        gx, px = x.iloc[grow_rows], x.iloc[prune_rows]
        grown = _grow(gx, bad[grow_rows], names, max_conditions, thresholds)
        rule = _prune(grown, px, bad[prune_rows])
        if not rule:
            break
        g, p = _covers(rule, gx), _covers(rule, px)
        right = [int(bad[rows][c].sum()) for rows, c in ((grow_rows, g), (prune_rows, p))]
        share = [bad[rows].mean() if len(rows) else 1.0 for rows in (prune_rows, np.concatenate([grow_rows, prune_rows]))]
        sure = _by_chance(right[1], int(p.sum()), share[0]) < chance / attempt
        sure |= right[1] > 0 and _by_chance(sum(right), int(g.sum() + p.sum()), share[1]) < 1e-4 * chance / attempt
        if sure and sum(right) >= precision * (g.sum() + p.sum()) and right[1] >= (precision - 0.1) * p.sum():
            rules.append(rule)
            grow_rows, prune_rows = grow_rows[~g], prune_rows[~p]
        else:
            failed = _covers(grown, gx) & bad[grow_rows]
            if not failed.any():
                break
            grow_rows = grow_rows[~failed]
    return DecisionList(tuple(rules))


def _by_chance(right: int, covered: int, share: float) -> float:
    """How probably `right` or more of the covered documents are rejected ones if each is with the share's probability: the
    binomial tail, its terms as logarithms, so that it is the same sum at every size."""
    if right <= 0 or share >= 1:
        return 1.0
    if share <= 0 or right > covered:
        return 0.0
    k = np.arange(right, covered + 1)
    of = np.array([math.lgamma(i + 1) for i in range(covered + 1)])
    terms = of[covered] - of[k] - of[covered - k] + k * math.log(share) + (covered - k) * math.log1p(-share)
    return float(min(1.0, np.exp(terms - terms.max()).sum() * math.exp(terms.max())))


def _grow(x: pd.DataFrame, y: np.ndarray, names: list[str], max_conditions: int, thresholds: int) -> tuple[Condition, ...]:
    rule: list[Condition] = []
    held = np.ones(len(x), bool)
    while len(rule) < max_conditions and (held & ~y).any() and (held & y).any():
        p0, n0 = (held & y).sum(), (held & ~y).sum()
        now = np.log2(p0 / (p0 + n0))
        best = None
        for name in names:
            v = x[name].to_numpy()[held]
            mine = y[held]
            cuts = np.unique(np.quantile(v, np.linspace(0, 1, thresholds + 2)))
            cuts = np.unique(np.concatenate([cuts, np.quantile(v[mine], np.linspace(0, 1, 9))]))
            cuts = (cuts[1:] + cuts[:-1]) / 2
            if not len(cuts):
                continue
            bad_v, good_v = np.sort(v[mine]), np.sort(v[~mine])
            below_p, below_n = np.searchsorted(bad_v, cuts, "right"), np.searchsorted(good_v, cuts, "right")
            for above, p, n in ((False, below_p, below_n), (True, len(bad_v) - below_p, len(good_v) - below_n)):
                gain = np.where(p > 0, p * (np.log2(np.maximum(p, 1) / np.maximum(p + n, 1)) - now), -1)
                i = int(gain.argmax())
                if gain[i] > 1e-9 and (best is None or gain[i] > best[0] + 1e-9):
                    best = (gain[i], Condition(name, above, float(cuts[i])))
        if best is None:
            break
        rule.append(best[1])
        held &= best[1].holds(x)
    return tuple(rule)


def _prune(rule: tuple[Condition, ...], x: pd.DataFrame, y: np.ndarray) -> tuple[Condition, ...]:
    def worth(r: tuple[Condition, ...]) -> float:
        c = _covers(r, x)
        p, n = (c & y).sum(), (c & ~y).sum()
        return (p - n) / (p + n) if p + n else -1.0

    best, score = rule, worth(rule)
    for k in range(len(rule) - 1, 0, -1):
        if worth(rule[:k]) > score:
            best, score = rule[:k], worth(rule[:k])
    return best


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DecisionList:
    """The list learned from labelled documents that pass the base rules."""
    known = labels.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("quality__"),
    ).filter("doc_id is not null and quality__ is not null")
    ids = F.broadcast(bounded_sample(known, "doc_id", max_labelled))  # at most max_labelled ids
    picked = known.join(ids, "doc_id").groupBy("doc_id").agg(F.min("quality__").alias("quality__"))
    rows = labelled_texts(docs, picked).select("quality__", "text")
    rows = with_stats(rows, ["quality__"]).filter(~base_failed())
    found = rows.select(
        "quality__", *[c.alias(n) for n, c in features().items()],
    ).toPandas().sort_values(["quality__", *BASE], kind="stable", ignore_index=True)
    bad = found.pop("quality__").to_numpy() == 0
    return learn(found, bad) if bad.any() and not bad.all() else DecisionList()


def judge(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept."""
    rules = fit(docs, labels, max_labelled)
    judged = with_stats(ids_and_texts(docs), ["doc_id"])
    return judged.select(
        "doc_id", *[F.col(f"stats__.{n}").alias(n) for n in BASE], base_failed().alias("base_failed"),
        (~base_failed() & rules.kept(features())).alias("kept"),
    )


def keep(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000) -> DataFrame:
    """The documents that neither the base rules nor the learned list reject; columns unchanged."""
    rules = fit(docs, labels, max_labelled)
    plain, names = plain_names(docs)
    judged = with_stats(plain, plain.columns, "stats__", names["text"])
    return judged.filter(~base_failed() & rules.kept(features())).drop("stats__").toDF(*docs.columns)
