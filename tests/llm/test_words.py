from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import words as W

PATTERNS = {"SPACED": rb"[^\x20\x09-\x0D]+", "ALPHANUMERIC": rb"[0-9a-z\x80-\xff]+", "LETTERS": rb"[a-z\x80-\xff]+"}


def lowered(data: bytes) -> bytes:
    return bytes(c + 32 if 65 <= c <= 90 else c for c in data)


def check(texts, name, limit):
    table = getattr(W, name)
    got = [[] for _ in texts]
    seen = {}
    for part in W.slices(pa.array(texts, pa.string()), limit):
        found = W.words(part, table)
        for a, b, row, key in zip(found.start, found.end, found.row, found.hash):
            word = part.data[a:b].tobytes()
            word = word if name == "SPACED" else lowered(word)
            got[part.first + row].append(word)
            assert seen.setdefault(int(key), word) == word
    assert len(seen) == len(set(seen.values()))
    want = [re.findall(PATTERNS[name], (t or "").encode() if name == "SPACED" else lowered((t or "").encode())) for t in texts]
    assert got == want


@pytest.mark.parametrize("name", PATTERNS)
@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.none() | st.text(alphabet="aB1é \n\t.\x00|日😀", max_size=30), max_size=6), limit=st.integers(1, 40))
def test_words_are_those_of_the_pattern(name, texts, limit):
    check(texts, name, limit)


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    monkeypatch.setattr(W, "SLICE_BYTES", 8)
    check(["ab cd efghijklmnopqrstuvwxyz ab", "cd", "", "ab"], "SPACED", 1000)


def test_windows_and_occurrences():
    part = next(W.slices(pa.array(["a b c a b", "a b", "x"])))
    found = W.words(part, W.SPACED)
    values, rows = W.windows(found, 3, 3)
    assert rows.tolist() == [0, 0, 0, 1, 2]
    assert len(set(values.tolist())) == 5
    assert W.occurrence(np.array([0, 0, 1, 0]), np.array([5, 5, 5, 6])).tolist() == [0, 1, 0, 0]
