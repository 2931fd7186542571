"""URL filtering: host and path rules, and a Bloom filter cascade for membership in a host blocklist.

A Bloom filter of the listed keys has false positives among the other keys of the corpus. All keys of the corpus are
known, so a second filter can encode exactly those false positives, a third the listed keys that the second one takes
in, and so on until a level has none left. A key is listed if the first level that does not hold it is an even one
(levels from 1), or if it passes them all and their number is odd. For every key of the universe this is exact, and a
row needs no join.

The universe is every host of the corpus and all its parent domains, distinct. A key is two 64-bit hashes, each chained over
the host's labels from the last to the first, so that a host gives all its parents' keys in one pass over its bytes, however
many labels it has. The filters are built by Spark: bit positions per key, or-ed into words by groupBy. Their size follows the listed keys that occur in the corpus, under two
bytes each over all levels. Keys are dealt by hash to as many shards as keep a shard's cascade under `shard_bytes`; the
cascades are built and broadcast one after the other, each in a pass over the rows that asks it for its own keys. So a
broadcast is bounded, rows are never shuffled, and a host that a third of all rows share is no hot key.

Defined results: a null url, or one without "://", has an empty host and path, fits no rule and is not listed; very long
urls, and hosts of very many labels, are read whole; a null page_id stays null; of rules of one length that fit the first given wins; repeated rows are each judged; an empty table
gives an empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Of a shard's cascade.
SHARD_BYTES = 64 << 20
#: (verdict, host, path); a rule's name is its host and path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Words that name advertising and spam.
SPAM_WORDS = ("ads", "adult", "bets", "casino", "loans", "pills", "poker", "porn", "spam", "viagra")
_WORDS = "|".join(SPAM_WORDS)
#: A label of several words joined by hyphens, one of them such a word.
SPAM_LABEL = rf"(^|\.)(([a-z0-9]+-)+({_WORDS})(-[a-z0-9]+)*|({_WORDS})(-[a-z0-9]+)+)(\.|$)"


def listed_hosts(hosts: DataFrame) -> DataFrame:
    """The default list, made by rule: every host of the corpus with a spam label. It grows with the corpus."""
    return hosts.select("host").distinct().filter(F.col("host").rlike(SPAM_LABEL))


def with_host_path(pages: DataFrame) -> DataFrame:
    """page_id, host, path."""
    at = F.instr("url", "://")
    rest = F.when(at > 0, F.substring(F.col("url"), at + 3, F.length("url"))).otherwise("")
    host = F.regexp_extract(F.col("rest"), "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(F.col("rest"), F.length("host0") + 1, F.length("rest")), "^[^?#]*", 0)
    return pages.select("page_id", F.coalesce(rest, F.lit("")).alias("rest")).withColumn("host0", host).select(
        "page_id", F.translate("host0", UPPER, LOWER).alias("host"), path.alias("path"),
    )


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, its verdict): the longest rule that fits, ties to the earlier one; null if none fits."""
    name = verdict = None
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path) if name is None else name.when(fits, rule_host + rule_path)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    return name, verdict


def domain_keys(host: str) -> list[tuple[int, int]]:
    """The keys of a host's top domain, of the domains below it, and of the host itself last."""
    out, h1, h2 = [], *SEEDS
    for label in reversed(host.encode().split(b".")):
        h1, h2 = xxhash.xxh64_intdigest(label, h1), xxhash.xxh64_intdigest(label, h2)
        out.append((h1, h2))
    return out


#: Where the two chains of hashes begin.
SEEDS = (42, 7)


def _keys_of(hosts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(h1, h2, how many keys each host has) of hosts, each different one hashed once."""
    coded = hosts.dictionary_encode()
    found = [domain_keys(h) for h in coded.dictionary.to_pylist()]
    sizes = np.array([len(f) for f in found], np.int64)
    flat = np.array([k for f in found for k in f], np.uint64).reshape(-1, 2)
    of = coded.indices.to_numpy()
    n, begin = sizes[of], (np.cumsum(sizes) - sizes)[of]
    at = np.repeat(begin - np.cumsum(n) + n, n) + np.arange(n.sum())
    return flat[at, 0], flat[at, 1], n


def hashed_domains(hosts: DataFrame, whole: bool = False) -> DataFrame:
    """h1, h2: the keys of the hosts and their parents, or of the hosts alone if `whole`; repeated ones may be left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                h1, h2, n = _keys_of(b.column("host").slice(at, 4096))
                if whole:
                    h1, h2 = (h[np.cumsum(n) - 1] for h in (h1, h2))
                keys = np.unique(np.stack([h1, h2], axis=1), axis=0) if len(h1) else np.zeros((0, 2), np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(keys[:, i]).view(np.int64)) for i in (0, 1)], names=["h1", "h2"])

    return hosts.select("host").filter("host is not null").mapInArrow(run, "h1 long, h2 long")


class Cascade:
    """Levels of (bits, hashes, words): level k holds listed keys if k is even (from 0), else false positives."""

    def __init__(self, levels: list[tuple[int, int, np.ndarray]]):
        self.levels = levels

    @property
    def nbytes(self) -> int:
        return sum(w.nbytes for _, _, w in self.levels)

    def holds(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Whether keys with these two 64-bit hashes are listed; exact for keys of the universe."""
        answer = np.zeros(len(h1), bool)
        left = np.arange(len(h1))
        for k, (m, n_hashes, words) in enumerate(self.levels):
            inside = np.ones(len(left), bool)
            for j in range(n_hashes):
                at = _position(h1[left], h2[left], k, j, m)
                inside &= (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
            answer[left[inside]] = k % 2 == 0
            left = left[inside]
        return answer


def _position(h1: np.ndarray, h2: np.ndarray, level: int, j: int, m: int) -> np.ndarray:
    step = np.uint64((level * 31 + j * 2 + 1) & 0xFFFFFFFF)
    with np.errstate(over="ignore"):
        mixed = h1 + (h2 | np.uint64(1)) * step
        mixed ^= mixed >> np.uint64(29)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed >> np.uint64(16)) % np.uint64(m)).astype(np.int64)


def _level_size(n: int, level: int, false_positive_rate: float) -> tuple[int, int]:
    """(bits, hashes) of a level of n keys; all levels but the first pass half of the others on."""
    rate = false_positive_rate if level == 0 else 0.5
    m = max(64, math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 64) * 64)
    return m, max(1, round(m / n * math.log(2)))


def holds(cascades: list[Cascade], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether keys are listed, each asked of its shard."""
    answer = np.zeros(len(h1), bool)
    for i, cascade in enumerate(cascades):
        own = np.flatnonzero(h1 % np.uint64(len(cascades)) == i)
        answer[own] = cascade.holds(h1[own], h2[own])
    return answer


def build(keys: DataFrame, shards: int = 1, false_positive_rate: float = 0.02) -> Iterator[Cascade]:
    """The cascades over `keys` (h1, h2, listed), the distinct keys of the universe, shard by shard. Each level is one pass
    over the shard's keys that passed all levels before it; only its bit words come to the driver."""
    spark, hashed = keys.sparkSession, keys.select("h1", "h2", "listed")
    for shard in range(shards):
        levels: list[tuple[int, int, np.ndarray]] = []
        while True:
            k = len(levels)
            so_far = spark.sparkContext.broadcast(list(levels))
            left = hashed.mapInArrow(
                lambda b, so_far=so_far, shard=shard: _survivors(b, so_far.value, shard, shards),
                "h1 long, h2 long, listed boolean",
            )
            mine = left.filter(F.col("listed") == F.lit(k % 2 == 0))
            n = mine.count()
            if not n:
                break
            m, n_hashes = _level_size(n, k, false_positive_rate)
            words = mine.mapInArrow(
                lambda b, k=k, m=m, c=n_hashes: _bit_words(b, k, c, m), "at long, word long",
            ).groupBy("at").agg(F.bit_or("word").alias("word"))
            bits = np.zeros(m // 64, np.uint64)
            for row in words.toLocalIterator():
                bits[row["at"]] = np.uint64(row["word"] & 0xFFFFFFFFFFFFFFFF)
            levels.append((m, n_hashes, bits))
        yield Cascade(levels)


def _survivors(batches: Iterator[pa.RecordBatch], levels: list, shard: int, shards: int) -> Iterator[pa.RecordBatch]:
    """The shard's keys that every level so far takes in."""
    for b in batches:
        h1, h2 = (b.column(i).to_numpy().view(np.uint64) for i in (0, 1))
        left = np.flatnonzero(h1 % np.uint64(shards) == shard)
        for k, (m, n_hashes, words) in enumerate(levels):
            for j in range(n_hashes):
                at = _position(h1[left], h2[left], k, j, m)
                left = left[(words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1]
        yield b.take(pa.array(left))


def _bit_words(batches: Iterator[pa.RecordBatch], level: int, n_hashes: int, m: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        h1, h2 = (b.column(i).to_numpy().view(np.uint64) for i in (0, 1))
        at = np.concatenate([_position(h1, h2, level, j, m) for j in range(n_hashes)])
        words, where = np.unique(at >> 6, return_inverse=True)
        bits = np.zeros(len(words), np.uint64)
        np.bitwise_or.at(bits, where, np.uint64(1) << (at & 63).astype(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(bits.view(np.int64))], names=["at", "word"])


def universe(hosts: DataFrame, listed: DataFrame) -> DataFrame:
    """(h1, h2, listed): every host of the corpus and its parents, once."""
    seen = hashed_domains(hosts.select("host").distinct()).distinct()
    return seen.join(
        hashed_domains(listed, whole=True).distinct().withColumn("in_list", F.lit(True)), ["h1", "h2"], "left",
    ).select("h1", "h2", F.coalesce("in_list", F.lit(False)).alias("listed"))


def judge(pages: DataFrame, listed: DataFrame | None = None, rules: tuple = RULES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """page_id, host, path, rule, verdict, listed: the rule's verdict, else block for a host on the list or below a
    listed one, else allow."""
    spark = pages.sparkSession
    found = with_host_path(pages)
    keys = written(universe(found, listed_hosts(found) if listed is None else listed), "url-universe")
    n_listed = keys.filter("listed").count()
    shards = max(1, -(-2 * n_listed // shard_bytes))
    judged = found.withColumn("listed", F.lit(False))
    for shard, cascade in enumerate(build(keys, shards)):
        if shard:  # a broadcast at a time
            judged = written(judged, "url-judged")
        shared = spark.sparkContext.broadcast(cascade)
        judged = judged.mapInArrow(
            lambda b, shared=shared, shard=shard: _ask(b, shared.value, shard, shards),
            "page_id long, host string, path string, listed boolean",
        )
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return judged.select(
        "page_id", "host", "path", name.alias("rule"),
        F.coalesce(verdict, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed",
    )


def _ask(batches: Iterator[pa.RecordBatch], cascade: Cascade, shard: int, shards: int) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            b = whole.slice(at, 4096)
            h1, h2, n = _keys_of(b.column("host"))
            own = np.flatnonzero(h1 % np.uint64(shards) == shard)
            hit = np.zeros(len(h1), np.int64)
            hit[own] = cascade.holds(h1[own], h2[own])
            hits, ends = np.concatenate([[0], np.cumsum(hit)]), np.cumsum(n)
            any_hit = hits[ends] > hits[ends - n]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("host"), b.column("path"), pa.array(any_hit | b.column("listed").to_numpy(zero_copy_only=False))],
                names=["page_id", "host", "path", "listed"],
            )


def _oracle() -> str:
    fits = [(kind, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p) for kind, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2]))]
    rule = " ".join(f"WHEN {test} THEN '{name}'" for _, test, name in fits)
    verdict = " ".join(f"WHEN {test} THEN '{kind}'" for kind, test, _ in fits)
    hosts = f"regexp_matches(host, '{SPAM_LABEL}')"
    return f"""
WITH cut AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS host0 FROM cut),
parts AS (SELECT page_id, translate(host0, '{UPPER}', '{LOWER}') AS host, regexp_extract(substr(rest, length(host0) + 1), '^[^?#]*') AS path FROM split)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} WHEN {hosts} THEN 'block' ELSE 'allow' END AS verdict, ({hosts}) AS listed
FROM parts
"""


#: The SQL applies the list's rule to every host; the cascade must give the same answer.
ORACLE_SQL = _oracle()
