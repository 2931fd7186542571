"""SimHash near-dedup: fingerprints of word shingles, linked within a Hamming budget by a binary trie self-join.

`near_groups` works on 64-bit fingerprints: text lower-cased in A-Z, words by ASCII white space, shingles of `shingle`
words joined by a space (the whole sequence if there are fewer), XXH64 with seed 42; a bit is set if it is set in over
half of the shingles' hashes, repeats included. A text without words has fingerprint zero. `similar_groups` and `dedup`
work by similarity, on wide fingerprints (below).

Linking runs on distinct fingerprints, so exact copies cost one row. The 64 bits are cut into budget + 1 blocks; two
fingerprints within the budget agree on one block, and, of the other bits cut into budget + 1 parts again, on one part.
Each fingerprint is sent once for each choice of block and part, which become the top of its trie. A task's rows come
sorted by that choice and top and pass through it some whole groups at a time, as a sorted array, a trie by common
prefixes: the subtrees under equal tops are joined with themselves, node pairs are traversed together, each step adds a
bit that differs, and a pair over the budget is dropped with everything below it. Of the pairs found a task emits a
spanning forest of its links only, never all pairs of a group. Groups hold distinct fingerprints that agree on 35 or
more bits, so copies, however many, don't fill one. Fingerprints that many documents share are joined back to these by
a broadcast of at most a thousand rows, so no task gathers their documents.

Links are closed to components by alternating large-star and small-star steps, each written to the shared folder.

Defined results: null text is a text without words; texts without words are linked with each other as any equal
fingerprints; rows with one doc_id are each fingerprinted, `dedup` counts them as one document; rows without a doc_id
belong to their text's group, represent none, and stay; of a group the smallest doc_id represents it; an empty table gives an empty result; very long
texts are read whole; other columns, whatever their names, pass through `dedup`.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import ids_and_texts, plain_names, slices, written

BITS = 64


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, 42) for s in shingles], "<u8")
    set_in = np.zeros(BITS, np.int64)
    for begin in range(0, len(hashes), 1 << 14):
        part = hashes[begin : begin + (1 << 14)]
        set_in += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(set_in * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long): no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 8 << 20):
            fps = np.array([fingerprint(t, shingle) for t in b.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return ids_and_texts(docs).mapInArrow(run, "doc_id long, fp long")


def _cuts(bits: int, parts: int) -> list[int]:
    return [bits * i // parts for i in range(parts + 1)]


def layouts(budget: int) -> list[list[int]]:
    """Bit orders, most significant first, and how many top bits must agree: block, part of the rest, the rest."""
    found = []
    blocks = _cuts(BITS, budget + 1)
    for b in range(budget + 1):
        block = list(range(blocks[b], blocks[b + 1]))
        rest = [i for i in range(BITS) if i not in block]
        parts = _cuts(len(rest), budget + 1)
        for p in range(budget + 1):
            part = rest[parts[p] : parts[p + 1]]
            found.append((len(block) + len(part), block + part + [i for i in rest if i not in part]))
    return found


def _reorder(fps: np.ndarray, order: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.uint64)
    for i, bit in enumerate(order):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)) << np.uint64(BITS - 1 - i)
    return out


def trie_links(
    keys: np.ndarray, begin: np.ndarray, top: int, budget: int, counted: int = BITS, nodes: np.ndarray | None = None,
    verify: Callable | None = None, limit: int = 1 << 17, small: int = 1 << 12,
) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs of a spanning forest of the links within `budget` inside each group of rows. Groups start at `begin`;
    a group's keys are sorted, distinct and agree on their first `top` bits. Only the first `counted` bits count as
    differing; `verify` may refuse pairs. Rows with one number in `nodes` are one node of the forest.

    Node pairs are traversed together, at most `limit` at once, and while there are more than `small`, trie nodes with
    themselves go before trie nodes with each other. Besides pairs over the budget, pairs whose leaves are all in one
    component are dropped: they can add no link. So a crowd of close keys costs little more than its forest."""
    n = len(keys)
    nodes = np.arange(n) if nodes is None else nodes
    end = np.append(begin[1:], n)[: len(begin)]
    some = end - begin > 1
    begin, end = begin[some], end[some]
    parent = np.arange(int(nodes.max(initial=-1)) + 1)

    def components() -> tuple[np.ndarray, np.ndarray]:
        root = parent[nodes]
        return root, np.concatenate([[0], np.cumsum(root[1:] != root[:-1])])

    root, changes = components()
    forest: tuple[list, list] = ([], [])
    stack = [(np.full(len(begin), top, np.int64), begin, end, begin, end, np.zeros(len(begin), np.int8))] if len(begin) else []
    while stack:
        depth, a0, a1, b0, b1, err = pairs = stack.pop()
        if len(a0) > limit:
            stack += [tuple(x[k : k + limit] for x in pairs) for k in range((len(a0) - 1) // limit * limit, -1, -limit)]
            continue
        one = (root[a0] == root[b0]) & (changes[a0] == changes[a1 - 1]) & (changes[b0] == changes[b1 - 1])
        leaf = (a1 - a0 == 1) & (b1 - b0 == 1) & ~one
        if leaf.any():
            i, j = a0[leaf], b0[leaf]
            near = np.bitwise_count((keys[i] ^ keys[j]) >> np.uint64(BITS - counted)) <= budget
            i, j = i[near], j[near]
            if verify is not None and len(i):
                near = verify(i, j)
                i, j = i[near], j[near]
            for x, y in zip(i.tolist(), j.tolist()):
                x_root, y_root = _root(parent, nodes[x]), _root(parent, nodes[y])
                if x_root != y_root:
                    parent[max(x_root, y_root)] = min(x_root, y_root)
                    forest[0].append(x)
                    forest[1].append(y)
            if len(i):
                while not np.array_equal(up := parent[parent], parent):
                    parent = up
                root, changes = components()
        depth, a0, a1, b0, b1, err = (x[~one & ~leaf] for x in pairs)
        if not len(a0):
            continue
        bit = (BITS - 1 - depth).astype(np.uint64)
        a_mid, b_mid = _split(keys, a0, a1, bit), _split(keys, b0, b1, bit)
        own = (a0 == b0) & (a1 == b1)  # a node with itself: its children with themselves and with each other
        more = err + (depth < counted)
        selves, others = [], []
        for c0, c1, d0, d1, e, ok in (
            (a0, a_mid, b0, b_mid, err, True), (a_mid, a1, b_mid, b1, err, True), (a0, a_mid, b_mid, b1, more, True),
            (a_mid, a1, b0, b_mid, more, ~own),
        ):
            same = (c0 == d0) & (c1 == d1)
            ok = ok & (c1 > c0) & (d1 > d0) & (e <= budget)
            selves.append(tuple(x[ok & same & (c1 - c0 > 1)] for x in (depth + 1, c0, c1, d0, d1, e)))
            others.append(tuple(x[ok & ~same] for x in (depth + 1, c0, c1, d0, d1, e)))
        few = sum(len(x[0]) for x in selves + others) <= small
        for parts in (others + selves,) if few else (others, selves):
            joined = tuple(np.concatenate(x) for x in zip(*parts))
            if len(joined[0]):
                stack.append(joined)
    return np.array(forest[0], np.int64), np.array(forest[1], np.int64)


def starts(groups: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])) if len(groups) else np.zeros(0, np.int64)


def _root(parent: np.ndarray, x: int) -> int:
    while parent[x] != x:
        parent[x] = parent[parent[x]]
        x = parent[x]
    return x


def _split(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.ndarray) -> np.ndarray:
    """The first index of each sorted range whose key has `bit` set, all ranges bisected together."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        is_set = np.zeros(len(lo), bool)
        is_set[open_] = (keys[mid[open_]] >> bit[open_]) & np.uint64(1) == 1
        hi = np.where(open_ & is_set, mid, hi)
        lo = np.where(open_ & ~is_set, mid + 1, lo)
    return lo


def links(classes: DataFrame, budget: int = 2) -> DataFrame:
    """(a, b): a spanning forest of the links of each subtrie, by the classes' representatives. classes: fp, rep."""
    made = layouts(budget)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = b.column("fp").to_numpy().view(np.uint64)
            for k, (top, order) in enumerate(made):
                key = _reorder(fps, order)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(fps), k, np.int32)), pa.array((key >> np.uint64(BITS - top)).view(np.int64)),
                        pa.array(key.view(np.int64)), b.column("rep"),
                    ],
                    names=["layout", "top", "key", "rep"],
                )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["layout", "top"]):
            layout, key, rep = (rows.column(n).to_numpy() for n in ("layout", "key", "rep"))
            for k in np.unique(layout).tolist():
                mine = np.flatnonzero(layout == k)
                keys = key[mine].view(np.uint64)
                order = np.argsort(keys, kind="stable")
                i, j = trie_links(keys[order], starts(keys[order] >> np.uint64(BITS - made[k][0])), made[k][0], budget)
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(rep[mine[order[x]]]) for x in (i, j)], names=["a", "b"])

    sent = classes.select("fp", "rep").mapInArrow(send, "layout int, top long, key long, rep long")
    return sent.repartition("layout", "top").sortWithinPartitions("layout", "top").mapInArrow(join, "a long, b long").distinct()


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = 16 << 20) -> Iterator[pa.Table]:
    """Rows that come sorted by keys, whole groups of about `most` bytes at a time; only a larger group is held whole."""
    held, size, full = [], 0, most
    for b in batches:
        held.append(b)
        size += b.nbytes
        if size < full:
            continue
        rows = pa.Table.from_batches(held)
        columns = [rows.column(k).to_numpy() for k in keys]
        new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in columns]))
        if cut := int(new[-1]) + 1 if len(new) else 0:
            yield rows.slice(0, cut)
            held, full = rows.slice(cut).to_batches(), most
            size = sum(x.nbytes for x in held)
        else:
            full = 2 * size
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component): each node of the edges with the smallest node it reaches. Large-star and small-star steps
    until a round changes nothing; sizes and checksums alone come to the driver. Rounds grow with the logarithm of the
    longest chain; more than max_rounds are an error."""
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "star")
    seen = None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        edges = written(_small_star(_large_star(edges)), "star")
    else:
        raise RuntimeError(f"components are not complete after {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(edges.select("v", "v").distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("x", "y")
    least = both.groupBy(F.col("x").alias("c")).agg(F.least(F.min("y"), F.col("c")).alias("m"))
    return both.filter("y > x").join(least, F.col("x") == F.col("c")).select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    linked = edges.join(least, F.col("u") == F.col("c")).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
    return linked.union(least.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()


def near_groups(docs: DataFrame, shingle: int = 3, budget: int = 2) -> DataFrame:
    """doc_id, fp, component_id: a row per document with the smallest doc_id that it reaches by links."""
    found = written(fingerprints(docs, shingle), "simhash")
    classes = written(found.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "simhash-classes")
    reached = components(links(classes.filter("rep is not null"), budget))
    return _of_class(found, classes, reached, "fp").select("doc_id", "fp", "component_id")


def _of_class(found: DataFrame, classes: DataFrame, reached: DataFrame, key: str) -> DataFrame:
    """found (doc_id, key) with component_id, by way of classes (key, rep, n) and reached (node, component). Keys with a
    thousandth of the rows or more, at most a thousand, are broadcast; the others are joined by a shuffle."""
    named = classes.join(reached, F.col("rep") == F.col("node"), "left").select(
        F.col(key).alias("of"), "n", F.coalesce("component", "rep").alias("component_id"),
    )
    rows = classes.agg(F.sum("n")).first()[0] or 0
    often = F.broadcast(named.filter(F.col("n") >= max(1000, rows / 1000)))
    match = F.col(key) == F.col("of")
    rest = found.join(often.select("of"), match, "left_anti").join(named, match)
    return found.join(often, match).unionByName(rest).drop("of", "n")


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# Near copies by similarity. Texts whose shingle sets have a Jaccard similarity of 0.8 differ in about 15 % of SimHash
# bits: far beyond a budget that prunes a trie near its root. So a fingerprint of many more bits is taken, and tries are
# joined with themselves under tops that similar sets share: in each of a few layouts, two minima of the set's shingle
# hashes, each mixed in another way. Two sets share a minimum as often as their similarity says, so a layout brings a pair
# at 0.8 together with a chance of 0.64, whatever the number of rows, and texts that have little in common never meet. The
# first bits of the fingerprint are the key below a top, and the bits that travel with a row choose the candidates, with
# room for chance; a link is a candidate whose sets of shingles are as similar as asked.

WIDE_WORDS = 12
#: The first words, which are compared in the first pass.
CHECK_WORDS = 2
#: Minima that make a top.
TOP_HASHES = 2
#: Of pairs at the very limit of similarity, the share that no layout may bring together.
MISSED = 0.0005
DEVIATIONS = 3.5
KEY_BITS = 32


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of each of the set of shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < shingle:
        shingles = {b" ".join(words)}
    else:
        shingles = set(map(b" ".join, zip(*(words[i:] for i in range(shingle)))))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, 42) for s in shingles], np.uint64)


def _mixed(hashes: np.ndarray, first: int, n: int) -> np.ndarray:
    """(n, hashes): the hashes mixed in n ways, numbered from `first`."""
    odd = np.array([(2 * k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1) for k in range(first, first + n)], np.uint64)[:, None]
    mixed = (hashes ^ (hashes >> np.uint64(31)))[None] * odd
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(32))


def wide_fingerprint(hashes: np.ndarray, words_out: int = WIDE_WORDS) -> bytes:
    """words_out 64-bit SimHashes of a set of shingle hashes, each of hashes mixed in another way."""
    if not len(hashes):
        return bytes(8 * words_out)
    set_in = np.zeros((words_out, BITS), np.int64)
    for begin in range(0, len(hashes), 8 * 255):
        part = hashes[begin : begin + 8 * 255]
        bits = np.unpackbits(_mixed(part, 0, words_out).view(np.uint8), axis=1).reshape(words_out, len(part), BITS)
        for at in range(0, len(part), 255):  # so many ones fit a byte
            set_in += np.add.reduce(bits[:, at : at + 255], axis=1, dtype=np.uint8)
    return np.packbits(set_in * 2 > len(hashes), axis=1).tobytes()


def layouts_for(similarity: float, missed: float = MISSED) -> int:
    """Layouts that let no more than `missed` of the pairs at the similarity go without a common top."""
    return math.ceil(math.log(missed) / math.log1p(-(min(similarity, 0.999) ** TOP_HASHES)))


def tops(hashes: np.ndarray, layouts: int) -> np.ndarray:
    """The set's top in each layout."""
    if not len(hashes):
        return np.zeros(layouts, np.uint64)
    least = np.full(layouts * TOP_HASHES, 2**64 - 1, np.uint64)
    for begin in range(0, len(hashes), 1 << 13):
        least = np.minimum(least, _mixed(hashes[begin : begin + (1 << 13)], WIDE_WORDS, len(least)).min(axis=1))
    with np.errstate(over="ignore"):
        top = np.arange(1, layouts + 1, dtype=np.uint64)
        for k in range(TOP_HASHES):
            top = (top ^ least[k::TOP_HASHES]) * np.uint64(0x9E3779B97F4A7C15)
            top ^= top >> np.uint64(29)
    return top


def differing(similarity: float) -> float:
    """The share of bits that differ between sets of one size with this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def most_differing(similarity: float, bits: int, deviations: float) -> int:
    """Differing bits to expect, and so many standard deviations more."""
    share = differing(similarity)
    return int(bits * share + deviations * math.sqrt(bits * share * (1 - share)))


def _wide(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _layout_links(classes: DataFrame, words: int, similarity: float, ends_only: bool = False) -> DataFrame:
    """(a, b): forests of the links of classes (rep, node, wide) that some layout brings together and that differ in no
    more of the first `words` words than the similarity lets expect. Rows travel with those words. If classes have
    `hashes`, their sets of shingles, these travel too and a link's sets must be as similar as asked. With ends_only,
    (met): the classes that have a link."""
    most, most_key = (most_differing(similarity, n, DEVIATIONS) for n in (BITS * words, KEY_BITS))
    columns, exact = [f"w{i}" for i in range(words)], ["hashes"] * ("hashes" in classes.columns)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 2048):
                b = whole.slice(at, 2048)
                wide = _wide(b.column("wide"))
                own = [pa.array(w) for w in np.ascontiguousarray(wide[:, : 8 * words]).view(">u8").astype(np.uint64).view(np.int64).T.copy()]
                own += [b.column(c) for c in exact]
                for place in np.ascontiguousarray(wide[:, 8 * WIDE_WORDS :]).view("<i8").T.copy():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(place), b.column("rep"), b.column("node"), *own],
                        names=["place", "rep", "node", *columns, *exact],
                    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ["place"]):
            place, rep, node = (rows.column(n).to_numpy() for n in ("place", "rep", "node"))
            bits = np.stack([rows.column(n).to_numpy() for n in columns], axis=1).view(np.uint64)
            order = np.lexsort((rep, bits[:, 0], place))
            place, rep, node, bits = place[order], rep[order], node[order], bits[order]
            sets = rows.column("hashes").combine_chunks() if exact else None

            def near(i: np.ndarray, j: np.ndarray) -> np.ndarray:
                found = np.bitwise_count(bits[i] ^ bits[j]).sum(1) <= most
                for k in np.flatnonzero(found).tolist() if exact else ():
                    x, y = (sets[int(order[at[k]])].values.to_numpy() for at in (i, j))
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    found[k] = both and both / (len(x) + len(y) - both) >= similarity
                return found

            # Equal keys of a group are told apart by bits that don't count. Few pairs at a time are compared by sets, so
            # that those which can add no link are left out.
            keys = (bits[:, 0] & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(place), dtype=np.uint64)
            few = {"limit": 1 << 11, "small": 1 << 9} if exact else {}
            i, j = trie_links(keys, starts(place), 0, most_key, KEY_BITS, np.unique(node, return_inverse=True)[1], near, **few)
            ends = [np.unique(rep[np.concatenate([i, j])])] if ends_only else [np.minimum(rep[i], rep[j]), np.maximum(rep[i], rep[j])]
            yield pa.RecordBatch.from_arrays([*map(pa.array, ends)], names=["met"] if ends_only else ["a", "b"])

    fields = ["place long", "rep long", "node long", *(f"{c} long" for c in columns), *(f"{c} array<long>" for c in exact)]
    sent = classes.select("rep", "node", "wide", *exact).mapInArrow(send, ", ".join(fields))
    return sent.repartition("place").sortWithinPartitions("place").mapInArrow(join, "met long" if ends_only else "a long, b long").distinct()


def _shingle_sets(docs: DataFrame, reps: DataFrame, shingle: int) -> DataFrame:
    """rep, hashes: the sets of shingles of the documents in reps, a row per different text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            sets = [shingle_hashes(t, shingle).view(np.int64) for t in b.column("text").to_pylist()]
            ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(sets)))],
                names=["rep", "hashes"],
            )

    texts = ids_and_texts(docs).join(reps.hint("shuffle_hash"), F.col("doc_id") == F.col("met"), "left_semi").distinct()
    return written(texts.mapInArrow(run, "rep long, hashes array<long>"), "simhash-sets")


def _confirmed(edges: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """a, b, near: whether the sets of shingles of the edge's documents are as similar as asked, or more."""
    one, other = (sets.select(F.col("rep").alias(f"{x}_rep"), F.col("hashes").alias(x)) for x in ("x", "y"))
    pairs = edges.join(one, F.col("a") == F.col("x_rep")).join(other, F.col("b") == F.col("y_rep"))
    pairs = pairs.select("a", "b", F.size(F.array_intersect("x", "y")).alias("both"), (F.size("x") + F.size("y")).alias("sum"))
    near = F.coalesce(F.col("both") / F.nullif(F.col("sum") - F.col("both"), F.lit(0)) >= similarity, F.lit(False))
    return written(pairs.groupBy("a", "b").agg(F.max(near).alias("near")), "simhash-confirmed")


def similar_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, missed: float = MISSED) -> DataFrame:
    """doc_id, component_id: a row per document with the smallest doc_id that it reaches by links of texts whose sets of
    shingles have the Jaccard similarity asked, or more. A first pass, with few words to check, finds the documents that
    may have a neighbour; only these carry all their bits through the second, which gives a forest of candidates in each
    group. Candidates are confirmed by the sets. A refused one may have hidden others, so all candidates between groups
    that refused ones lie between are confirmed too. A link is missed only if no layout meets it: with the chance `missed` at
    the very limit, less above it."""
    layouts = layouts_for(similarity, missed)

    def wide(text: str | None) -> bytes:
        hashes = shingle_hashes(text, shingle)
        return wide_fingerprint(hashes) + tops(hashes, layouts).astype("<u8").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 8 << 20):
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([wide(t) for t in b.column("text").to_pylist()], pa.binary())],
                names=["doc_id", "wide"],
            )

    found = written(ids_and_texts(docs).mapInArrow(run, "doc_id long, wide binary"), "simhash-wide")
    classes = written(found.groupBy("wide").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "simhash-wide-classes")
    nodes = classes.filter("rep is not null").select("rep", F.col("rep").alias("node"), "wide")
    met = written(_layout_links(nodes, CHECK_WORDS, similarity, ends_only=True), "simhash-met")
    near = written(nodes.join(met, F.col("rep") == F.col("met"), "left_semi"), "simhash-near")
    candidates = written(_layout_links(near, WIDE_WORDS, similarity).filter("a <> b"), "simhash-candidates")
    ends = written(candidates.select(F.explode(F.array("a", "b")).alias("met")).distinct(), "simhash-ends")
    sets = _shingle_sets(docs, ends, shingle)
    checked = _confirmed(candidates, sets, similarity)
    edges = checked.filter("near").select("a", "b")
    reached = written(components(edges), "simhash-reached")

    of = written(ends.join(reached, F.col("met") == F.col("node"), "left").select("met", F.coalesce("component", "met").alias("node")), "simhash-of")
    a, b = (of.select(F.col("met").alias(f"{x}_met"), F.col("node").alias(f"{x}_node")) for x in ("a", "b"))
    apart = checked.filter("not near").join(a, F.col("a") == F.col("a_met")).join(b, F.col("b") == F.col("b_met")).filter("a_node <> b_node")
    open_ = written(apart.select(F.explode(F.array("a_node", "b_node")).alias("open")).distinct(), "simhash-open")
    if not open_.isEmpty():
        inside = of.join(open_, F.col("node") == F.col("open"), "left_semi")
        again = nodes.drop("node").join(inside, F.col("rep") == F.col("met")).select("rep", "node", "wide")
        again = again.join(sets.select(F.col("rep").alias("of_rep"), "hashes"), F.col("rep") == F.col("of_rep")).drop("of_rep")
        late = written(_layout_links(written(again, "simhash-again"), WIDE_WORDS, similarity), "simhash-late")
        if not late.isEmpty():
            reached = components(edges.union(late))
    return _of_class(found, classes, reached, "wide").select("doc_id", "component_id")


def dedup(docs: DataFrame, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one document of each group, the one with the smallest doc_id; columns unchanged. Rows that share a
    doc_id are one document, of which one row stays; rows without a doc_id stay."""
    fold = written(similar_groups(docs, shingle, similarity), "simhash-groups")
    rows, ids = fold.agg(F.count("doc_id"), F.countDistinct("doc_id")).first()
    plain, names = plain_names(docs)
    own = F.col(names["doc_id"])
    drop = fold.filter("doc_id <> component_id").select(F.col("doc_id").alias("drop_id")).distinct().hint("shuffle_hash")  # not broadcast: ids grow with the corpus
    kept = plain.filter(own.isNotNull()).join(drop, own == F.col("drop_id"), "left_anti")
    if rows != ids:
        kept = kept.dropDuplicates([names["doc_id"]])
    return kept.unionByName(plain.filter(own.isNull())).toDF(*docs.columns)
