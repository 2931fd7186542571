"""MinHash links against all pairs of sets, and against SQL."""

from __future__ import annotations

import math
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from trackloom.llm import catalogue, minhash

DOC = "doc_id long, text string, lang string, source string, n_chars long, digest string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "d") for i, t in rows], DOC)


def shingles(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """(doc_id, n_shingles, component_id, kept) of each row."""
    sets = [shingles(t) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * len(sets[a] | sets[b]):
                x, y = root(rows[a][0]), root(rows[b][0])
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(s), root(i), root(i) == i) for (i, _), s in zip(rows, sets))


def found(df, **how):
    return sorted(map(tuple, minhash.near_groups(df, **how).select("doc_id", "n_shingles", "component_id", "kept").collect()))


def copies(r, n_groups=25, size=6, words=(6, 400)):
    """Groups of texts that differ from each other in more and more words, so that similarities lie on both sides of 0.85."""
    rows = []
    for _ in range(n_groups):
        base = [f"w{v}" for v in r.integers(0, 3000, int(r.integers(*words)))]
        for k in range(size):
            own = list(base)
            for at in r.integers(0, len(own), k * max(1, len(own) // 150)):
                own[at] = f"z{r.integers(1 << 30)}"
            rows.append((len(rows), " ".join(own)))
    order = r.permutation(len(rows)).tolist()
    return [(order[i], t) for i, t in rows]


@pytest.mark.parametrize("kept", [minhash.KEPT, 24])
def test_equals_all_pairs(spark, kept):
    rows = copies(np.random.default_rng(kept))
    want = brute(rows)
    assert 20 < sum(x[3] for x in want) < len(want) - 20
    assert found(table(spark, rows), kept=kept) == want


def test_a_crowd_near_the_limit(spark):
    """Hundreds of variants of one text, most pairs under the limit, some above: no link is lost, and none of the lists'
    pairs becomes a row. Beside it a passage that many other texts share."""
    r = np.random.default_rng(1)
    base = [f"w{v}" for v in r.integers(0, 3000, 140)]
    rows = []
    for i in range(260):
        own = list(base)
        for at in r.integers(0, len(own), int(r.integers(0, 6))):
            own[at] = f"z{r.integers(1 << 30)}"
        rows.append((i, " ".join(own)))
    passage = " ".join(f"p{v}" for v in range(60))
    rows += [(1000 + i, passage + " " + " ".join(f"u{v}" for v in r.integers(0, 1 << 30, 90))) for i in range(200)]
    want = brute(rows)
    assert 100 < sum(x[3] for x in want) < 400
    assert found(table(spark, rows)) == want


def test_odd_rows(spark):
    """Nulls, empty texts, few words, exact copies, one id twice, no id, a very long text, and letters that only A-Z lowers."""
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one  two"), (8, "Éa b c d e"), (9, "éa b c d e"), (10, long), (11, long + " tail"), (12, "a b c d e"), (13, "A b\x0bc\td E")]
    assert found(table(spark, rows)) == brute(rows)
    many = rows + [(100 + i, "same text in many places at once " * 3) for i in range(1500)]
    got = {x[0]: x for x in found(table(spark, many))}
    assert {got[100 + i][2] for i in range(1500)} == {100} and got[4][2] == got[5][2] == 4 and got[1][2] == 1 and got[2][3]
    twice = found(table(spark, [(7, "a b c d e f g"), (7, "x y z u v w q"), (3, "a b c d e f g"), (9, "x y z u v w q")]))
    assert [x[0] for x in twice] == [3, 7, 7, 9] and [x[2] for x in twice if x[0] != 7] == [3, 7 if (9, 3, 7, False) in twice else 3]
    none = minhash.near_groups(table(spark, [(None, "a b c d e f"), (4, "a b c d e f"), (None, "alone is this text here"), (None, None)])).collect()
    assert sorted((x.doc_id or 0, x.component_id or 0, x.kept) for x in none) == [(0, 0, True), (0, 0, True), (0, 4, False), (4, 4, True)]
    assert found(table(spark, [])) == []


def test_required_values():
    """The chance of fewer shared values than required, at the very limit, is under MISSED; one more wouldn't be."""
    need = minhash.required()
    for n in (1, 10, 33, 64, 128):
        below = lambda o: sum(math.comb(n, k) * 0.85**k * 0.15 ** (n - k) for k in range(o))  # noqa: B023, E731
        assert below(need[n]) <= minhash.MISSED < below(need[n] + 1)


def test_least_shared_holds_for_small_sets(spark):
    """Sketches of linked sets share as many values as postings count on: exactly, where sets are their own sketches."""
    r = np.random.default_rng(7)
    sizes = spark.range(1, 400).select("id", minhash.least_shared(F.col("id")).alias("s")).collect()
    least = {x.id: x.s for x in sizes}
    for _ in range(4000):
        n = int(r.integers(1, 120))
        common = set(r.integers(0, 1 << 62, n).tolist())
        a, b = (common | set(r.integers(0, 1 << 62, int(r.integers(0, n // 6 + 1))).tolist()) for _ in range(2))
        if 100 * len(a & b) >= 85 * len(a | b):
            shared = len(set(sorted(a)[: minhash.KEPT]) & set(sorted(b)[: minhash.KEPT]))
            assert shared >= max(least[len(a)], least[len(b)])


def test_registered_query(spark):
    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    want = sorted(con.execute(minhash.ORACLE_SQL).fetchall())
    got = sorted(map(tuple, catalogue.QUERIES["op12_minhash"](spark, d).select("doc_id", "n_shingles", "component_id", "kept").collect()))
    assert got == want and 0 < sum(not x[3] for x in want) < len(want)
