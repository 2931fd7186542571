"""Secrets joined to other secrets, to paths and to placeholders, and secrets of letters only."""

from __future__ import annotations

import random
import string

from trackloom.llm import secrets

KEY = "Zk3" + "q9XvB7mT2LpR8sWd4YfH"


def kept(text):
    return secrets.blanked(text, "[{kind}]")


def test_secrets_beside_other_spans():
    access, digest = "AKIA" + "IOSFODNN7ABCDEFG", "0123456789abcdef" * 2
    tail = "wJalrXUtnFEMIK7MDENGbPxRfiCYabc1"
    assert secrets.joined(secrets.find(f"{access}/{tail}")) == f"access:0:20,entropy:20:{21 + len(tail)}"
    for joint in "/=-":
        for text in (f"{digest}{joint}{KEY}", f"{KEY}{joint}{digest}"):
            assert {k for _, k, _ in secrets.find(text)} == {2, 3}
            assert KEY not in kept(text) and digest not in kept(text)
            assert not secrets.find(kept(text))
    assert KEY not in kept(f"{KEY}/{access}/{KEY[::-1]}") and KEY[::-1] not in kept(f"{KEY}/{access}/{KEY[::-1]}")


def test_placeholders_cover_their_segment_only():
    assert KEY not in kept(f"docs/examples/{KEY}") and KEY not in kept(f"{KEY}/sample")
    assert not secrets.find(f"docs/example-{KEY}/index")


def test_letters_only():
    r = random.Random(3)
    found = [bool(secrets.find("".join(r.choices(string.ascii_letters, k=40)))) for _ in range(200)]
    assert sum(found) > 180
    assert not secrets.find("usr/local/share/documentation/installation src/main/resources/configuration internationalization_settings")


def test_long_repeats():
    assert not secrets.find("x/" + "z" * 30) and secrets.peak_entropy("z" * 30 + "1") < 0.5


def plain_runs(r, n):
    """Paths, dates, identifiers and file names of words and numbers, each long enough to be a candidate."""
    words = "banner top large images uploads content report final version user profile picture thumbnail summer holiday why left job company gallery assets static index archive news sport weather city council minutes meeting budget annual".split()
    out = []
    while len(out) < n:
        w = lambda: r.choice(words)
        date = f"{r.randint(1990, 2030)}{(s := r.choice('-/_'))}{r.randint(1, 12):02}{s}{r.randint(1, 28):02}"
        run = r.choice([
            f"{w()}/{date}/{w()}-{w()}-{w()}-{r.randint(1, 999)}x{r.randint(1, 999)}", f"wp-{w()}/{w()}/{date}/IMG_{r.randint(10**7, 10**8)}_{r.randint(10**5, 10**6)}",
            f"{date}T{r.randint(0, 23):02}-{r.randint(0, 59):02}-{r.randint(0, 59):02}Z-{w()}-{w()}-v{r.randint(1, 20)}", f"{w()}_{w()}_{w()}_{w()}_{r.randint(1, 99999)}",
            f"get{w().title()}{w().title()}By{w().title()}Id/{w()}/{r.randint(1, 10**6)}", f"{w()}-{w()}-{w()}-{w()}-{w()}-{w()}/{w()}",
        ])
        if len(run) >= secrets.WINDOW:
            out.append(run)
    return out


def test_precision_and_recall():
    """Of planted secrets nine in ten or more are found nearly whole, of ordinary runs one in a hundred at most is reported."""
    r = random.Random(11)
    wrong = [run for run in plain_runs(r, 3000) if secrets.find(f"see {run} there")]
    assert len(wrong) <= 30, wrong[:5]
    for alphabet in (string.ascii_letters + string.digits + "+/", string.ascii_letters + string.digits + "-_", string.ascii_lowercase + string.digits, "0123456789ABCDEF"):
        for n in (24, 32, 40, 64):
            planted = ["".join(r.choices(alphabet, k=n)) for _ in range(300)]
            assert sum(sum(e - s for s, _, e in secrets.find(f"x {p} y")) >= 0.8 * n for p in planted) > 270
    path = f"api/v1/{KEY}/settings"
    assert [path[s:e] for s, _, e in secrets.find(path)] == [KEY]


def slow_spans(run):
    """Entropy spans of a run that holds no other kind's span and no placeholder, written out plainly."""
    import re
    from collections import Counter
    from math import log2

    tokens = [(m.start(), m.end(), bool(secrets.PLAIN.match(m[0]))) for m in re.finditer("[A-Za-z0-9]+", run)]
    plain, all_ = (sum(e - s for s, e, p in tokens if p or not only) for only in (True, False))
    if not plain:
        stretches = [(0, len(run))]
    elif 2 * plain < all_:
        odd = [i for i, t in enumerate(tokens) if not t[2]]
        stretches = [(0 if odd[0] == 0 else tokens[odd[0]][0], len(run) if odd[-1] == len(tokens) - 1 else tokens[odd[-1]][1])]
    else:
        stretches, i = [], 0
        while i < len(tokens):
            j = i
            while j < len(tokens) and not tokens[j][2]:
                j += 1
            if j > i:
                stretches.append((tokens[i][0], tokens[j - 1][1]))
            i = j + 1
    spans = []
    for s, e in stretches:
        part = run[s:e]
        windows = [Counter(part[i : i + 20]) for i in range(len(part) - 19)]
        if not windows or any(p.match(part) for p in secrets.ALLOWED):
            continue
        if secrets.LETTERS.match(part):
            need = secrets.ONE_CASE if part in (part.lower(), part.upper()) else secrets.BOTH_CASES
        else:
            need = 3.0 if set(part) <= set("0123456789abcdefABCDEF") else 3.4 if set(part) <= set("0123456789abcdefghijklmnopqrstuvwxyz") else 3.7
        if max(sum(-c / 20 * log2(c / 20) for c in w.values()) for w in windows) >= need - 1e-12:
            spans.append((s, e))
    return spans


def test_added_spans_by_brute_force():
    r = random.Random(5)
    runs = plain_runs(r, 300)
    runs += ["".join(r.choices("abcXYZ019/-_=+", k=r.randint(20, 70))) for _ in range(600)]
    runs += [r.choice("/-_=").join("".join(r.choices(string.ascii_letters + string.digits, k=r.randint(1, 24))) for _ in range(r.randint(1, 5))) for _ in range(600)]
    runs = [x for x in runs if len(x) >= 20 and not secrets.PLACEHOLDER.search(x) and not any(k < 3 for _, k, _ in secrets.find(x))]
    assert len(runs) > 1000 and all([(s, e) for s, _, e in secrets.find(x)] == slow_spans(x) for x in runs)
