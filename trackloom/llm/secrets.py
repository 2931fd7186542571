"""Secret scans: three fixed kinds by pattern, and high-entropy strings by a sliding window.

Kinds, leftmost and non-overlapping each:
  assign  a secret's name, an assignment and a value of 6 characters or more (the span is the whole match)
  access  AKIA with upper-case letters and digits, 20 characters or more
  hex     lower-case hex digits, 24 characters or more
  entropy runs of 20 or more of [A-Za-z0-9+/_=-] in which a window of 20 characters reaches the Shannon entropy its
          character class asks for. Counts are kept from window to window: one character enters, one leaves, and the
          entropy changes by their two terms. Spans of the other kinds, and segments between '/' or '=' that name a
          placeholder, are cut out of a run, and so are plain segments (words, camel case, numbers, a word or unit with
          a number) at the ends of what is left, or everywhere if they make up half of it, as in paths, dates and
          identifiers; each part of 20 or more that stays is scanned by itself. Letters only must reach a higher entropy.

Offsets count code points, ends are exclusive. Defined results: a null or empty text has no spans (base_sha256 is that
of the empty string); very long texts are scanned whole; spans that begin together are ordered as the kinds above; null
doc_ids stay null; repeated rows are scanned each; an empty table gives an empty result; other columns, whatever their
names, pass through `redact` and are ignored by `scan`.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trackloom.llm.common import ids_and_texts, plain_names, slices

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ASSIGN_NAME = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)
ASSIGN_VALUE = 6
ACCESS, ACCESS_LENGTH = re.compile(r"AKIA[A-Z0-9]+"), 20
HEX, HEX_LENGTH = re.compile(r"[0-9a-f]+"), 24
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: (characters of the class, entropy in bits that a window of 20 must reach); the first class that has them all counts.
CLASSES = (
    ("hex", frozenset("0123456789abcdefABCDEF"), 3.0), ("base36", frozenset("0123456789abcdefghijklmnopqrstuvwxyz"), 3.4),
    ("base64", None, 3.7),
)
#: Parts that match any of these are no secrets.
ALLOWED = (re.compile(r"[0-9_=/+-]+\Z"), re.compile(r"(.)\1*\Z"))
#: Letters only, of one case and of both: words, names and paths seldom reach this entropy.
LETTERS, ONE_CASE, BOTH_CASES = re.compile(r"[A-Za-z_=/+-]+\Z"), 3.9, 4.0
#: Segments with such a word are placeholders.
SEGMENT, PLACEHOLDER = re.compile(r"[^/=]+"), re.compile(r"example|sample|placeholder|changeme|dummy", re.IGNORECASE)
#: Between separators. Words and numbers are plain, and so are numbers with a word or unit before, behind or between them.
TOKEN = re.compile(r"[A-Za-z0-9]+")
PLAIN = re.compile(r"[0-9]+\Z|[A-Z]?[a-z]{1,18}(?:[A-Z][a-z]{1,18})*\Z|[A-Z]{1,19}\Z|(?:[A-Z]?[a-z]{1,12}|[A-Z]{1,6})[0-9]{1,4}\Z|[0-9]{1,8}(?:[a-z]{1,4}|[A-Z]{1,3})(?:[0-9]{1,6}[A-Za-z]?)?\Z")
_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]  # one enters before one leaves


def peak_entropy(s: str, window: int = WINDOW) -> float:
    """The largest Shannon entropy, in bits, of the windows of s. With n characters of counts c it is
    log2(n) - sum(c log2 c) / n; the sum follows the two counts that a step changes."""
    counts: dict[str, int] = {}
    total = least = 0.0
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        total += _TERM[n + 1] - _TERM[n]
        counts[c] = n + 1
        if i >= window:
            n = counts[s[i - window]]
            total += _TERM[n - 1] - _TERM[n]
            counts[s[i - window]] = n - 1
        if i == window - 1:
            least = total
        elif i >= window and total < least:
            least = total
    return math.log2(window) - least / window if len(s) >= window else 0.0


def is_random(s: str) -> bool:
    """Whether a part is suspicious: not on the allow-list, and a window reaches its class's entropy."""
    if any(p.match(s) for p in ALLOWED):
        return False
    if LETTERS.match(s):
        return peak_entropy(s) >= (ONE_CASE if s in (s.lower(), s.upper()) else BOTH_CASES)
    used = set(s)
    need = next(bits for _, chars, bits in CLASSES if chars is None or used <= chars)
    return peak_entropy(s) >= need


def parts(run: str, cuts: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What the cuts (sorted), the placeholder segments and the plain ones leave of a run, if it fills a window."""
    if PLACEHOLDER.search(run):
        cuts = sorted(cuts + [m.span() for m in SEGMENT.finditer(run) if PLACEHOLDER.search(m[0])])
    begin = 0
    for s, e in [*cuts, (len(run), len(run))]:
        if s - begin >= WINDOW:
            yield from _unplain(run, begin, s)
        begin = max(begin, e)


def _unplain(run: str, begin: int, end: int) -> Iterator[tuple[int, int]]:
    """The stretches of run[begin:end] between plain segments, or from the first segment to the last that isn't plain."""
    found = [(m.start(), m.end(), PLAIN.match(m[0]) is not None) for m in TOKEN.finditer(run, begin, end)]
    plain = sum(e - s for s, e, p in found if p)
    stretches: list[tuple[int, int]] = []
    open_ = False
    for s, e, p in found:
        if not p:
            stretches[-1:] = [(stretches[-1][0], e)] if open_ else [*stretches[-1:], (s, e)]
        open_ = not p
    if not plain:
        stretches = [(begin, end)]
    elif stretches and 2 * plain < sum(e - s for s, e, _ in found):
        stretches = [(begin if not found[0][2] else stretches[0][0], end if not found[-1][2] else stretches[-1][1])]
    yield from ((s, e) for s, e in stretches if e - s >= WINDOW)


def find(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of every span, sorted."""
    spans = []
    if ASSIGN_NAME.search(text):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    runs = [(m.start(), m.group()) for m in CANDIDATE.finditer(text)]
    for at, run in runs:  # access and hex characters all lie in candidates
        spans += [(at + m.start(), 1, at + m.end()) for m in ACCESS.finditer(run) if len(m[0]) >= ACCESS_LENGTH]
        spans += [(at + m.start(), 2, at + m.end()) for m in HEX.finditer(run) if len(m[0]) >= HEX_LENGTH]
    if runs:
        base = merged((s, e) for s, _, e in spans)
        ends = [e for _, e in base]
        for at, run in runs:
            first = i = bisect_right(ends, at)
            while i < len(base) and base[i][0] < at + len(run):
                i += 1
            cuts = [(s - at, e - at) for s, e in base[first:i]]
            spans += [(at + s, 3, at + e) for s, e in parts(run, cuts) if is_random(run[s:e])]
    return sorted(spans)


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans sorted, those that overlap as one."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s < out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_entropy: a row per document, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 8 << 20):
            found = [find(t) if t else [] for t in b.column("text").to_pylist()]
            count = [[sum(k == kind for _, k, _ in spans) for spans in found] for kind in range(4)]
            sha = [hashlib.sha256(joined([s for s in spans if s[1] < 3]).encode()).hexdigest() for spans in found]
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), *(pa.array(count[k], pa.int64()) for k in range(3)), pa.array(sha),
                    pa.array([joined(s) for s in found]), pa.array(count[3], pa.int64()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"],
            )

    return ids_and_texts(docs).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_entropy long",
    )


def blanked(text: str | None, mark: str) -> str | None:
    """The text with each span, overlapping ones together, replaced by mark with its kind."""
    spans = find(text) if text else []
    if not spans:
        return text
    out, at, end = [], 0, -1
    for s, k, e in spans:
        if s >= end:
            if end >= 0:
                at = end
            out += [text[at:s], mark.format(kind=KINDS[k])]
            end = e
        else:
            end = max(end, e)
    return "".join(out) + text[end:]


def redact(docs: DataFrame, mark: str = "[{kind}]") -> DataFrame:
    """docs with every span in text replaced; documents without spans are unchanged, and n_chars follows the text."""
    plain, names = plain_names(docs)
    text = names["text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text, 8 << 20):
            new = pa.array([blanked(t, mark) for t in b.column(text).to_pylist()], pa.string())
            yield b.set_column(b.schema.get_field_index(text), text, new)

    changed = plain.mapInArrow(run, plain.schema)
    if at := names.get("n_chars"):
        changed = changed.withColumn(at, F.length(text).cast(plain.schema[at].dataType))
    return changed.toDF(*docs.columns)
