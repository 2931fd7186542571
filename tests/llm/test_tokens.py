"""Piecewise encoding equals encoding whole texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from trackloom.llm import tokens

SPACES = [" ", "  ", "\n", "\t", " \n", "\n\n", " ", " ", "\x1c", "\x85", ""]
WORDS = ["the", "it's", "don't", "'s", "x's", "Über", "12", "a1", "--", "#$%", "é", "日本", "<|endoftext|>", "🙂", "s", "'", "...", "A"]


LIBRARY = Tokenizer.from_file(tokens.default_path())


def whole(texts):
    """The library's own ids, by a tokenizer that the operators don't touch."""
    return [[*e.ids, 0] for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def piecewise(texts):
    ids, ends = tokens.Encoder.of(tokens.default_path()).encode(pa.array(texts, pa.string()))
    return [x.tolist() for x in np.split(ids, ends[:-1])] if len(ends) else []


@pytest.mark.parametrize(
    "texts",
    [
        [], [None], [""], [" "], ["a"], [" a", "a "], ["a  b", "a b", "a\n b", "a \nb"],
        ["x " * 5000 + "end", None, "", "don't stop <|endoftext|> now"],
    ],
)
def test_cases(texts):
    assert piecewise(texts) == whole(texts)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.lists(st.tuples(st.sampled_from(WORDS), st.sampled_from(SPACES)), max_size=12).map(lambda x: "".join(w + s for w, s in x)),
        max_size=6,
    )
)
def test_mixed_spaces(texts):
    assert piecewise(texts) == whole(texts)


def test_added_tokens_are_the_library_s():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "<|endof text|>", "plain"]
    assert piecewise(texts) == whole(texts)
    assert 50256 in piecewise(texts)[0] and 50256 not in piecewise(texts)[3]


def test_full_cache(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", 3 * tokens.PIECE_BYTES + 3 * len("onetwothree") + tokens.PIECE_BYTES)
    encoder = tokens.Encoder(tokens.default_path())
    texts = [f"one two three four{i} five {i} six" for i in range(50)]
    for _ in range(2):
        ids, ends = encoder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == whole(texts)
    assert 3 <= len(encoder.known) <= 4 and encoder.known_bytes <= tokens.CACHE_BYTES


def test_pieces_with_one_hash_stay_apart(monkeypatch):
    real = tokens._hashes
    monkeypatch.setattr(tokens, "_hashes", lambda pieces: (real(pieces)[0] & np.uint64(1 << 63), real(pieces)[1]))
    encoder = tokens.Encoder(tokens.default_path())
    texts = [f"one two three {i} {'long' * i} \u00e9t\u00e9{i}" for i in range(40)]
    for _ in range(3):
        ids, ends = encoder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == whole(texts)
    assert len(encoder.known) == len(np.unique(encoder.hashes)) == 2


def test_hash_reads_the_bytes_of_slices():
    words = ["", "a", "b", "ab", "eightbyt", "eightbyte", "x" * 31, "x" * 32, "x" * 33, "\u00e9"]
    found, size = tokens._hashes(pa.array(["gone", *words])[1:])
    assert size.tolist() == [len(w.encode()) for w in words] and len(set(found.tolist())) == len(words)
    assert (found == tokens._hashes(pa.array(words))[0]).all()
