"""Tokenising whole texts with a byte-level BPE of the tokenizers library, piece by piece.

A space between two characters that are no white space always begins a new pre-token, so the pieces between such spaces
can be encoded apart and their ids joined: the ids equal those of the whole text. Words repeat, so a worker encodes a
piece once for a slice of documents, and keeps pieces that it meets in a second slice for later ones (up to CACHE_BYTES);
a table of hashes says what was met before, so that words met once don't take the room. Pieces stay Arrow strings: known
ones are found by a 64-bit hash in a sorted array, and their bytes are compared, so a hash in common does no harm. New
pieces are encoded many in one string, each behind its space; as a token stands for a fixed number of bytes, running sums
of bytes say which ids are whose.

The library cuts texts at the tokenizer's added tokens (such as its end-of-text mark) before anything else. A text that
holds one is left to the library whole, so it gives the ids that the library gives.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that a worker's known pieces may take, and what a piece takes besides its characters and ids.
CACHE_BYTES, PIECE_BYTES = 32 << 20, 32
#: Bytes of the longest pieces that are kept.
KEPT_LENGTH = 32
#: Hashes that a worker can tell apart of the pieces it has met.
MET = 1 << 22
JOINED = 512
AT_ONCE = 16
_SAFE = re.compile(r"(?<=\S) (?=\S)")
_encoders: dict[str, Encoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of texts, with `end_id` after each."""

    def __init__(self, path: str, end_id: int = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.end_id = end_id
        vocabulary = self.tokenizer.get_vocab()
        self.token_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # one character stands for one byte
            self.token_bytes[i] = len(token)
        # Known pieces by number, and their hashes in order with the numbers.
        self.known = pa.array([], pa.string())
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.known_bytes = 0
        self.met = np.zeros(MET, bool)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros(1 << 14, np.int64)

    @classmethod
    def of(cls, path: str, end_id: int = 0) -> Encoder:
        """One encoder for all tasks of a Python worker."""
        key = f"{path}:{end_id}"
        if key not in _encoders:
            _encoders[key] = cls(path, end_id)
        return _encoders[key]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        """Few texts go to the library at a time: what it returns takes many times the ids' bytes."""
        found: list[list[int]] = []
        for i in range(0, len(texts), AT_ONCE):
            found += [e.ids for e in self.tokenizer.encode_batch_fast(texts[i : i + AT_ONCE], add_special_tokens=False)]
        return found

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each piece has) of pieces that each stand behind a space."""
        begins = np.append(np.arange(0, len(pieces), JOINED, dtype=np.int32), np.int32(len(pieces)))
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(begins), pieces), " ")
        sizes = pc.binary_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for text, begin, end in zip(joined, begins[:-1], begins[1:]):
            own = np.array(self._ids([" " + text.as_py()])[0], np.uint32)
            ends = np.cumsum(sizes[begin:end])
            sums = np.cumsum(self.token_bytes[own])
            last = np.searchsorted(sums, ends)
            if last[-1] != len(own) - 1 or (sums[last] != ends).any():
                raise ValueError("the tokenizer does not keep bytes apart at spaces")
            ids.append(own)
            counts.append(np.diff(last, prepend=-1))
        return np.concatenate(ids), np.concatenate(counts)

    def _find(self, pieces: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 for those that aren't known."""
        found = np.full(len(pieces), -1, np.int64)
        if not len(self.hashes):
            return found
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        number = self.numbers[at[hit]]
        same = pc.equal(pieces.take(pa.array(hit)), self.known.take(pa.array(number))).to_numpy(zero_copy_only=False)
        found[hit[same]] = number[same]
        return found

    def _learn(self, pieces: pa.Array, hashes: np.ndarray) -> None:
        """Adds pieces, whose hashes are new, to the known ones; each is encoded behind a space."""
        n = len(self.known)
        ids, sizes = self._pieces(pieces)
        used = int(self.ends[n - 1]) if n else 0
        total = used + len(ids)
        if total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(max(total - len(self.flat), len(self.flat) // 2), np.uint32)])
        if n + len(pieces) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros(max(n + len(pieces) - len(self.ends), len(self.ends) // 2), np.int64)])
        self.flat[used:total] = ids
        self.ends[n : n + len(pieces)] = used + np.cumsum(sizes)
        self.known = pa.concat_arrays([self.known, pieces])
        own = np.argsort(hashes)
        place = np.searchsorted(self.hashes, hashes[own])
        self.hashes = np.insert(self.hashes, place, hashes[own])
        self.numbers = np.insert(self.numbers, place, (n + own).astype(np.int32))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, where each text's ids end), end ids included; null is empty."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        whole = np.zeros(len(texts), bool)
        for content in self.added:
            # Pieces are joined by spaces, so a content with one could arise between texts.
            whole |= True if " " in content else pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if whole.any():
            at, rest = np.flatnonzero(whole), np.flatnonzero(~whole)
            return self._merge(
                len(texts), (at, self._encode_whole(texts.take(pa.array(at)).to_pylist())),
                (rest, self.encode(texts.take(pa.array(rest)))),
            )
        lists = pc.split_pattern(texts, " ")
        ends = np.cumsum(lists.value_lengths().to_numpy())
        firsts = np.concatenate([[0], ends[:-1]])
        coded = lists.flatten().dictionary_encode()
        del lists
        codes, pieces = coded.indices.to_numpy(), coded.dictionary
        # An empty piece, or one that begins or ends with white space, means a space that is no safe boundary.
        size = pc.binary_length(pieces).to_numpy()
        unsafe = (size == 0) | (pc.binary_length(pc.utf8_trim_whitespace(pieces)).to_numpy() != size)
        if unsafe.any():
            at = np.flatnonzero(unsafe[codes])
            bad = np.unique(np.searchsorted(ends, at, side="right"))
            good = np.setdiff1d(np.arange(len(texts)), bad)
            return self._merge(
                len(texts), (good, self.encode(texts.take(pa.array(good)))),
                (bad, self._encode_lists([_SAFE.split(t) for t in texts.take(pa.array(bad)).to_pylist()])),
            )
        return self._gather(codes, pieces, firsts, ends)

    def _encode_whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        own = [np.array([*self._ids([t])[0], self.end_id], np.uint32) for t in texts]
        return np.concatenate(own), np.cumsum([len(x) for x in own])

    def _encode_lists(self, lists: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([len(x) for x in lists])
        coded = pa.array([p for x in lists for p in x], pa.string()).dictionary_encode()
        return self._gather(coded.indices.to_numpy(), coded.dictionary, np.concatenate([[0], ends[:-1]]), ends)

    def _merge(self, n: int, *parts: tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        found: list = [None] * n
        for where, (ids, ends) in parts:
            for i, own in zip(where.tolist(), np.split(ids, ends[:-1]) if len(ends) else []):
                found[i] = own
        return np.concatenate(found), np.cumsum([len(x) for x in found])

    def _gather(self, codes: np.ndarray, pieces: pa.Array, firsts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # Dictionary entries that only begin texts are encoded in vain here; they are few.
        hashes, size = _hashes(pieces)
        where = self._find(pieces, hashes)
        missing = np.flatnonzero(where < 0)
        at = (hashes[missing] >> np.uint64(64 - MET.bit_length() + 1)).astype(np.int64)
        again = missing[self.met[at] & (size[missing] <= KEPT_LENGTH)]
        self.met[at] = True
        again = again[np.sort(np.unique(hashes[again], return_index=True)[1])]
        place = np.searchsorted(self.hashes, hashes[again])
        again = again[place == np.searchsorted(self.hashes, hashes[again], "right")]
        taken = np.cumsum(PIECE_BYTES + 3 * size[again])
        if fit := int(np.searchsorted(taken, CACHE_BYTES - self.known_bytes, "right")):
            learn = again[:fit]
            n = len(self.known)
            self._learn(pieces.take(pa.array(learn)), hashes[learn])
            self.known_bytes += int(taken[fit - 1])
            where[learn] = n + np.arange(fit)
            missing = np.flatnonzero(where < 0)
        n_known = len(self.known)
        rest, rest_sizes = self._pieces(pieces.take(pa.array(missing)))
        where[missing] = n_known + np.arange(len(missing))
        opening = self._ids(pieces.take(pa.array(codes[firsts])).to_pylist())
        piece_of = where[codes].astype(np.int32)
        del where, codes, pieces
        piece_of[firsts] = n_known + len(missing) + np.arange(len(firsts))
        # The end id is a piece of its own behind each text's last.
        last = n_known + len(missing) + len(firsts)
        piece_of = np.insert(piece_of, ends, last)
        extra = [*opening, [self.end_id]]
        used = int(self.ends[n_known - 1]) if n_known else 0
        sizes = np.concatenate([rest_sizes, np.fromiter(map(len, extra), np.int64, len(extra))])
        flat = np.concatenate([self.flat[:used], rest, np.array([i for x in extra for i in x], np.uint32)])
        stops = np.concatenate([self.ends[:n_known], used + np.cumsum(sizes)])
        starts = np.concatenate([[0], stops[:-1]])
        # Where each piece's ids begin in `flat`, less where they begin in the result; a slice's ids fit 32 bits.
        lengths = (stops - starts).astype(np.int32)[piece_of]
        out_ends = np.cumsum(lengths, dtype=np.int64)
        shift = starts[piece_of] - out_ends + lengths
        del piece_of
        at = np.repeat(shift.astype(np.int32), lengths)
        del shift, lengths
        at += np.arange(len(at), dtype=np.int32)
        return flat[at], out_ends[ends + np.arange(len(ends))]


def _hashes(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the first KEPT_LENGTH bytes and the length, length in bytes) of strings, eight bytes of all at a time."""
    _, ends, data = pieces.buffers()
    ends = np.frombuffer(ends, np.int32)[pieces.offset : pieces.offset + len(pieces) + 1]
    begin, size = ends[:-1].astype(np.int64), np.diff(ends).astype(np.int64)
    raw = np.concatenate([np.frombuffer(data, np.uint8)[: ends[-1]] if data else np.zeros(0, np.uint8), np.zeros(8, np.uint8)])
    words = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))  # the eight bytes from each byte on
    out = size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(0, KEPT_LENGTH, 8):
        at = np.flatnonzero(size > k)
        word = words[begin[at] + k]
        word &= np.uint64(2**64 - 1) >> (np.uint64(8) * (8 - np.minimum(size[at] - k, 8)).astype(np.uint64))
        mixed = (out[at] ^ word) * np.uint64(0xBF58476D1CE4E5B9)
        out[at] = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        out[at] ^= out[at] >> np.uint64(32)
    return out, size
