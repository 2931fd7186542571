"""MinHash near-dedup by bottom-k sketches from one hash function, exact in what it links.

A document's set is its distinct shingles; documents are linked whose sets have a Jaccard similarity of PERCENT or more. A
sketch holds the KEPT smallest XXH64 values of the set. Sets are compared once, however many documents have them.

Of two linked sets' sketches at least `required` values agree, but for a chance of MISSED at the very limit and far less
above it; small sets are their own sketches, and exact. So (1) retained values of one sketch alone are left out, and with
them every sketch that has fewer others than it must share; (2) what is left orders its values from rare to frequent, and
of two linked sketches the first values, as many as may differ and one more, have one in common: those are its postings.
Values that many documents share, such as a passage's, are the last to be among them.

Inverted lists of the postings bring sketches together, in three rounds. The lists of each sketch's two rarest postings
come with whole sets: the union sketch (the part of the hash range that both sketches cover) estimates the similarity,
pairs that can't reach the limit are left out, the exact similarity decides, and a list gives a spanning forest of its
links. Then all lists that hold more than one of the components so far find, by sketches alone, which sketches have yet
another they may be linked to; a pair counts in the first list that both are in. Only these lists get whole sets in the
last round. No round expands the pairs of a list or of a group of copies into rows. A crowd of sets that are all just under
the limit is compared pair by pair inside the tasks that hold its lists.

Defined results: text is lower-cased in A-Z and split at ASCII white space; with fewer words than a shingle has, the whole
sequence is the one shingle; null text and text without words have an empty set, linked with nothing; rows with one
doc_id are rows each, the id being one node of the graph; rows without a doc_id belong to their text's group, represent
none, and are kept only if no document with an id has their text; an empty table gives an empty result; very long texts
are read whole; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import ids_and_texts, slices, written
from trackloom.llm.simhash import _of_class, components, shingle_hashes, starts, whole_groups

KEPT = 64
PERCENT = 85
#: The chance that a pair at the very limit agrees on fewer values than required.
MISSED = 1e-9
#: Postings whose lists come with whole sets at once.
RAREST = 2
#: Ids that are broadcast at most (16 MB).
FEW_IDS = 1 << 21
TOGETHER, VALUES_AT_ONCE = 64, 1 << 22


def signature(text: str | None, shingle: int = 5) -> tuple[int, bytes, np.ndarray]:
    """Size of the text's set, a digest of it, and its hashes in order."""
    hashes = np.unique(shingle_hashes(text, shingle))
    return len(hashes), xxhash.xxh128_digest(hashes.tobytes()), hashes


def required(kept: int = KEPT, percent: int = PERCENT) -> list[int]:
    """For 0, 1, ... 2 * kept values seen of the union: as many or more of them are in both sets, if these are linked."""
    share, out = percent / 100, []
    for n in range(2 * kept + 1):
        below, o = 0.0, 0
        while o < n and (below := below + math.comb(n, o) * share**o * (1 - share) ** (n - o)) <= MISSED:
            o += 1
        out.append(o)
    return out


def least_shared(size: Column, kept: int = KEPT, percent: int = PERCENT) -> Column:
    """Values that a sketch of a set of that size must share with a linked set's: exact while all linked sets are their own
    sketches. The other sketch holds `percent` as many values at least, or `kept`."""
    others = F.least(F.ceil(size * percent / 100), F.lit(kept)).cast("int")
    by_chance = F.element_at(F.array(*map(F.lit, required(kept, percent)[: kept + 1])), others + 1)
    return F.greatest(F.when(size <= kept * percent // 100, others).otherwise(by_chance), F.lit(1)).cast("int")


def sketches(docs: DataFrame, shingle: int = 5, kept: int = KEPT) -> DataFrame:
    """doc_id, n_shingles, digest, sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            found = [(n, digest, hashes[:kept].view(np.int64)) for n, digest, hashes in (signature(t, shingle) for t in b.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary()), _lists([f[2] for f in found])],
                names=["doc_id", "n_shingles", "digest", "sketch"],
            )

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, n_shingles long, digest binary, sketch array<long>")


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)], dtype=np.int32)), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def whole_sets(docs: DataFrame, wanted: DataFrame, shingle: int = 5) -> DataFrame:
    """digest, hashes: the sets of the documents whose ids are `met` in wanted, each set once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            found = [signature(t, shingle) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([f[1] for f in found], pa.binary()), _lists([f[2].view(np.int64) for f in found])], names=["digest", "hashes"])

    few = F.broadcast(wanted) if wanted.count() <= FEW_IDS else wanted.hint("shuffle_hash")
    texts = ids_and_texts(docs).join(few, F.col("doc_id") == F.col("met"), "left_semi")
    return texts.mapInArrow(run, "digest binary, hashes array<long>").dropDuplicates(["digest"])


class Estimates:
    """Which members of a list can be linked, by their sketches: values in order for each member, their numbers, and the
    sizes of the sets."""

    def __init__(self, values: np.ndarray, lengths: np.ndarray, sizes: np.ndarray, need: np.ndarray, percent: int = PERCENT):
        self.lengths, self.percent, self.need = lengths, percent, need
        self.whole = sizes <= lengths
        seen, ids = np.unique(values, return_inverse=True)
        owner = np.repeat(np.arange(len(lengths)), lengths)
        self.width = len(seen) + 1
        self.keys = owner * self.width + ids
        ends = np.cumsum(lengths)
        self.begin = ends - lengths
        self.last = np.where(self.whole, len(seen), ids[np.maximum(ends - 1, 0)])
        self.both = Incidence(owner, ids, len(lengths))

    def rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, members): whether a link is possible, and the estimated similarity."""
        shared = self.both.overlaps(rows)
        r, x = rows[:, None], np.arange(len(self.lengths))[None]
        r_first = self.last[r] <= self.last[x]
        # All values of the sketch that ends first are in the common range; of the other, those up to its end.
        other, upto = np.where(r_first, x, r), np.minimum(self.last[r], self.last[x])
        union = self.lengths[np.where(r_first, r, x)] + np.searchsorted(self.keys, other * self.width + upto, side="right") - self.begin[other] - shared
        exact = self.whole[r] & self.whole[x]
        possible = np.where(exact, 100 * shared >= self.percent * union, shared >= self.need[np.minimum(union, len(self.need) - 1)]) & (shared > 0)
        return possible, shared / np.maximum(union, 1)


class Incidence:
    """How many ids members have in common; only ids of more than one member count."""

    def __init__(self, owner: np.ndarray, ids: np.ndarray, members: int):
        often = np.bincount(ids) > 1 if len(ids) else np.zeros(0, bool)
        keep = often[ids]
        self.owner, self.column, self.members = owner[keep], (np.cumsum(often) - 1)[ids[keep]], members
        self.columns, self.step = int(often.sum()), max(1, (1 << 24) // max(1, members))
        self.dense = self._part(0) if self.columns <= self.step else None

    def _part(self, begin: int) -> np.ndarray:
        out = np.zeros((self.members, min(self.step, self.columns - begin)), np.float32)
        own = (self.column >= begin) & (self.column < begin + self.step)
        out[self.owner[own], self.column[own] - begin] = 1
        return out

    def overlaps(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros((len(rows), self.members), np.float32)
        for begin in range(0, self.columns, self.step):
            part = self.dense if self.dense is not None else self._part(begin)
            total += part[rows] @ part.T
        return total.astype(np.int64)


def _blocks(roots: np.ndarray) -> Iterator[np.ndarray]:
    """Members in blocks, until all pairs of members of different roots have had one of them in a block: after the first
    block, members of what is then the largest group are left out for as long as they are in it. roots may change."""
    done, pivot = np.zeros(len(roots), bool), None
    while True:
        open_ = ~done if pivot is None else ~done & (roots != roots[pivot])
        rows = np.flatnonzero(open_)[:TOGETHER]
        if not len(rows) or (roots == roots[0]).all():
            return
        yield rows
        done[rows] = True
        if pivot is None:
            pivot = int(np.flatnonzero(roots == np.bincount(roots).argmax())[0])


def list_forest(values: np.ndarray, sizes: np.ndarray, nodes: np.ndarray, need: np.ndarray, kept: int = KEPT, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs of members of a list, a spanning forest of its links between different nodes. values: each member's set in
    order, sizes: their sizes."""
    roots = np.unique(nodes, return_inverse=True)[1]
    if len(nodes) < 2 or (roots == roots[0]).all():
        return []
    begin = np.cumsum(sizes) - sizes
    lengths = np.minimum(sizes, kept)
    held = np.repeat(begin - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
    estimates, pairs = Estimates(values[held], lengths, sizes, need, percent), []
    for rows in _blocks(roots):
        possible, near = estimates.rows(rows)
        for i, r in enumerate(rows.tolist()):
            at = np.flatnonzero(possible[i] & (roots != roots[r]))
            at = at[np.argsort(-near[i, at], kind="stable")]
            own = values[begin[r] : begin[r] + sizes[r]]
            while len(at):
                n = max(1, int(np.searchsorted(np.cumsum(sizes[at]), VALUES_AT_ONCE)))
                some, at = at[:n], at[n:]
                shared = _shared(own, values, begin[some], sizes[some])
                some = some[100 * shared >= percent * (len(own) + sizes[some] - shared)]
                for x in some[np.sort(np.unique(roots[some], return_index=True)[1])].tolist():
                    pairs.append((r, x))
                    roots[roots == roots[x]] = roots[r]
                at = at[roots[at] != roots[r]]
    return pairs


def _shared(own: np.ndarray, values: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many of `own` (in order) each of the given sets holds."""
    first = np.cumsum(sizes) - sizes
    all_ = values[np.repeat(begin - first, sizes) + np.arange(sizes.sum())]
    at = np.minimum(np.searchsorted(own, all_), len(own) - 1)
    return np.add.reduceat((own[at] == all_).astype(np.int64), first)


def _flat(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _exact_links(rows: DataFrame, kept: int, percent: int) -> DataFrame:
    """(a, b) of forests of the links in lists; rows: value, rep, node, hashes."""
    need = np.array(required(kept, percent))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in whole_groups(batches, ["value"]):
            value, rep, node = (some.column(c).to_numpy() for c in ("value", "rep", "node"))
            begin = starts(value)
            found: list[tuple[int, int]] = []
            for b, e in zip(begin, [*begin[1:], len(value)]):
                if e - b > 1:
                    values, sizes = _flat(some.column("hashes").slice(b, e - b))
                    found += [(b + i, b + j) for i, j in list_forest(values, sizes, node[b:e], need, kept, percent)]
            if found:
                i, j = np.array(found).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(rep[i], rep[j])), pa.array(np.maximum(rep[i], rep[j]))], names=["a", "b"])

    sent = rows.select("value", "rep", "node", "hashes").repartition("value").sortWithinPartitions("value")
    return sent.mapInArrow(join, "a long, b long").filter("a <> b").distinct()


def _may_link(rows: DataFrame, kept: int, percent: int) -> DataFrame:
    """(value, digest): the lists, and the sketches in them, that a pair of different nodes is possible in; a pair counts in
    the first list of both. rows: value, nth (the value's place in prefix), digest, node, n, sketch, prefix."""
    need = np.array(required(kept, percent))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in whole_groups(batches, ["value"]):
            value, node, sizes, nth = (some.column(c).to_numpy() for c in ("value", "node", "n", "nth"))
            begin, met = starts(value), np.zeros(len(value), bool)
            for b, e in zip(begin, [*begin[1:], len(value)]):
                roots = np.unique(node[b:e], return_inverse=True)[1]
                if e - b < 2 or (roots == roots[0]).all():
                    continue
                estimates = Estimates(*_flat(some.column("sketch").slice(b, e - b)), sizes[b:e], need, percent)
                values, lengths = _flat(some.column("prefix").slice(b, e - b))
                owner = np.repeat(np.arange(e - b), lengths)
                before = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths) < nth[b:e][owner]
                earlier = Incidence(owner[before], np.unique(values[before], return_inverse=True)[1], e - b)
                for r in _blocks(roots):
                    pair = estimates.rows(r)[0] & (roots[r][:, None] != roots[None]) & (earlier.overlaps(r) == 0)
                    met[b + r] |= pair.any(1)
                    met[b:e] |= pair.any(0)
            if met.any():
                yield pa.RecordBatch.from_arrays([pa.array(value[met]), some.column("digest").combine_chunks().filter(pa.array(met))], names=["value", "digest"])

    sent = rows.select("value", "nth", "digest", "node", "n", "sketch", "prefix").repartition("value").sortWithinPartitions("value")
    return sent.mapInArrow(join, "value long, digest binary")


def links(docs: DataFrame, classes: DataFrame, shingle: int = 5, percent: int = PERCENT, kept: int = KEPT) -> DataFrame:
    """(a, b): a forest, or a little more, of the links between classes (digest, rep, n, sketch) of documents."""
    postings = classes.select("digest", F.explode("sketch").alias("value"))
    often = postings.groupBy("value").agg(F.count("*").alias("df")).filter("df > 1").withColumnRenamed("value", "of").hint("shuffle_hash")
    shared = postings.join(often, F.col("value") == F.col("of")).groupBy("digest").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("shared"))
    sized = classes.select(F.col("digest").alias("d"), "rep", "n", "sketch")
    near = shared.join(sized, F.col("digest") == F.col("d")).withColumn("spare", F.size("shared") - least_shared(F.col("n"), kept, percent))
    near = written(near.filter("spare >= 0").select("digest", "rep", "n", "sketch", F.slice("shared.value", F.lit(1), F.col("spare") + 1).alias("prefix")), "minhash-near")
    sets = written(whole_sets(docs, near.select(F.col("rep").alias("met")).distinct(), shingle), "minhash-sets").withColumnRenamed("digest", "d")

    first = near.select("digest", "rep", F.explode(F.slice("prefix", 1, RAREST)).alias("value")).join(sets, F.col("digest") == F.col("d"))
    edges = written(_exact_links(first.withColumn("node", F.col("rep")), kept, percent), "minhash-links")
    reached = components(edges)
    known = near.join(reached.withColumnRenamed("node", "of"), F.col("rep") == F.col("of"), "left").withColumn("node", F.coalesce("component", "rep"))
    known = written(known.select("digest", "rep", "node", "n", "sketch", "prefix"), "minhash-known")

    placed = known.select("digest", "node", F.posexplode("prefix").alias("nth", "value"))
    mixed = placed.groupBy("value").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most").select(F.col("value").alias("of"))
    open_ = placed.join(mixed.hint("shuffle_hash"), F.col("value") == F.col("of"), "left_semi").groupBy("digest").agg(F.collect_list(F.struct("nth", "value")).alias("lists"))
    rows = known.join(open_.withColumnRenamed("digest", "d"), F.col("digest") == F.col("d")).select("digest", "node", "n", "sketch", "prefix", F.inline("lists"))
    possible = written(_may_link(rows, kept, percent), "minhash-possible")

    last = possible.join(known.select(F.col("digest").alias("k"), "rep", "node"), F.col("digest") == F.col("k")).join(sets, F.col("digest") == F.col("d"))
    return edges.union(written(_exact_links(last, kept, percent), "minhash-late"))


def near_groups(docs: DataFrame, shingle: int = 5, percent: int = PERCENT, kept: int = KEPT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per document with the smallest doc_id that it reaches by links."""
    found = written(sketches(docs, shingle, kept), "minhash")
    some = found.filter("n_shingles > 0")
    classes = written(some.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.max("n_shingles").alias("n"), F.first("sketch").alias("sketch"),
    ), "minhash-classes")
    reached = components(links(docs, classes.filter("rep is not null"), shingle, percent, kept))
    linked = _of_class(some.select("doc_id", "n_shingles", "digest"), classes.select("digest", "rep", F.col("copies").alias("n")), reached, "digest")
    alone = found.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    all_ = linked.select("doc_id", "n_shingles", "component_id").unionByName(alone)
    return all_.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


ORACLE_SQL = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM worded WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
both_ AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM both_ JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach(doc_id, other) AS (SELECT a, b FROM links UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(least, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(least, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)"""
