"""Hierarchical multi-length packing of documents into context windows of several sizes.

A document's ids are cut into full windows of the longest size; what remains is routed to the smallest tier that holds
it. From the longest tier down, each remainder opens a window of its tier and the gap is filled from shorter tiers,
the longest piece that fits first; when none fits, the shortest longer piece is cut to the gap and its rest is routed
again. So windows are full, at a power of two, but for the last of a task. Windows are gathered into step groups of
equal tokens: one tier each, the rest of all tiers mixed at a task's end.

Tokenising and packing are one pass over the input's own partitions: no shuffle, nothing gathered, and a partition that
is done again gives the same pieces. A sequence's id holds its partition. Remainders wait in groups of `group_docs`
documents, which bounds a task's memory.

Defined results: null text is empty (the end id alone is packed); repeated rows are packed each; null doc_ids stay
null; an empty table gives an empty result; very long texts fill many windows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from trackloom.llm import tokens
from trackloom.llm.common import ids_and_texts, slices

TIERS = (128, 256, 512, 1024)
STEP_TOKENS = 16 * 1024


class Packer:
    """Packs documents; finished pieces leave by `take`. A waiting piece is (length, order, doc_id, start, doc_tokens,
    ids); pools hold them by tier, sorted."""

    def __init__(self, tiers: tuple[int, ...] = TIERS, first_id: int = 0, step_tokens: int = STEP_TOKENS):
        self.tiers, self.step_tokens = tiers, step_tokens
        self.pools: list[list] = [[] for _ in tiers]
        self.held = [0] * len(tiers)
        self.steps: list[list] = [[] for _ in tiers]
        self.next_id, self.next_step, self.order, self.rows = first_id, first_id, 0, []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        longest = self.tiers[-1]
        full = len(ids) // longest * longest
        for start in range(0, full, longest):
            self._window(len(self.tiers) - 1, [(longest, 0, doc_id, start, len(ids), ids[start : start + longest])])
        if full < len(ids):
            self._route((len(ids) - full, 0, doc_id, full, len(ids), ids[full:].copy()))

    def _route(self, piece: tuple) -> None:
        self.order += 1
        tier = bisect_left(self.tiers, piece[0])
        insort(self.pools[tier], (piece[0], self.order, *piece[2:]), key=lambda p: p[:2])
        self.held[tier] += piece[0]

    def _pull(self, tier: int, i: int) -> tuple:
        piece = self.pools[tier].pop(i)
        self.held[tier] -= piece[0]
        return piece

    def pack(self, last: bool = False) -> None:
        """Full windows of what waits; what can't fill one waits on, or is padded if this is the last call."""
        for tier in range(len(self.tiers) - 1, -1, -1):
            while self.pools[tier] and (last or sum(self.held[: tier + 1]) >= self.tiers[tier]):
                window = [self._pull(tier, -1)]
                gap = self.tiers[tier] - window[0][0]
                while gap and (piece := self._for_gap(gap, tier)):
                    window.append(piece)
                    gap -= piece[0]
                self._window(tier, window)
        if last:
            mixed: list = []
            for window in (w for step in reversed(self.steps) for w in step):
                if sum(w[1] for w in mixed) + window[1] > self.step_tokens:
                    self._emit(mixed)
                    mixed = []
                mixed.append(window)
            self._emit(mixed)
            self.steps = [[] for _ in self.tiers]

    def _for_gap(self, gap: int, tier: int) -> tuple | None:
        """The longest waiting piece up to the gap, or the beginning of the shortest longer one."""
        for t in range(tier, -1, -1):
            if i := bisect_right(self.pools[t], gap, key=lambda p: p[0]):
                return self._pull(t, i - 1)
        for t in range(tier + 1):
            if self.pools[t]:
                length, order, doc_id, start, doc_tokens, ids = self._pull(t, 0)
                self._route((length - gap, order, doc_id, start + gap, doc_tokens, ids[gap:]))
                return (gap, order, doc_id, start, doc_tokens, ids[:gap])
        return None

    def _window(self, tier: int, pieces: list) -> None:
        filled = sum(p[0] for p in pieces)
        size = self.tiers[tier] if filled == self.tiers[tier] else self.tiers[-1]
        self.steps[tier].append((self.next_id, size, pieces))
        self.next_id += 1
        if len(self.steps[tier]) * self.tiers[tier] >= self.step_tokens:
            self._emit(self.steps[tier])
            self.steps[tier] = []

    def _emit(self, windows: list) -> None:
        for sequence_id, size, pieces in windows:
            offset = 0
            for length, _, doc_id, start, doc_tokens, ids in pieces:
                self.rows.append(
                    (doc_id, start, length, zlib.crc32(ids.astype("<u4").tobytes()), doc_tokens, sequence_id, offset, size, self.next_step, ids)
                )
                offset += length
        self.next_step += bool(windows)

    def take(self, with_ids: bool) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = list(zip(*rows)) if rows else [()] * 10
        types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "window", "step_group"]
        if with_ids:
            arrays.append(pa.array([x.astype(np.int32) for x in columns[9]], pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(arrays, names=names)


def pack(
    docs: DataFrame, path: str, end_id: int = 0, tiers: tuple[int, ...] = TIERS, step_tokens: int = STEP_TOKENS,
    group_docs: int = 2048, with_ids: bool = False,
) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, window (its size),
    step_group and, if asked, ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.Encoder.of(path, end_id)
        packer = Packer(tiers, TaskContext.get().partitionId() << 36, step_tokens)
        waiting = 0
        for b in slices(batches, "text", 4 << 20):
            ids, ends = encoder.encode(b.column("text"))
            for doc_id, own in zip(b.column("doc_id").to_pylist(), np.split(ids, ends[:-1])):
                packer.add(doc_id, own)
                waiting += 1
                if waiting >= group_docs:
                    packer.pack()
                    waiting = 0
            yield packer.take(with_ids)
        packer.pack(last=True)
        yield packer.take(with_ids)

    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, window int, step_group long" + ", ids array<int>" * with_ids
    return ids_and_texts(docs).mapInArrow(run, fields)
