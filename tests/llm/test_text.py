from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywork.llm import text as tx

TEXTS = st.lists(st.text(alphabet="aAbÉé \t\n\x0b.1ß\x00", max_size=30), max_size=8)


def hashed(texts, k=1, limit=tx.SLICE):
    out = []
    for low, _, data, offsets in tx.slices(pa.array(texts, pa.string()), limit):
        rows, start, end = tx.words(tx.LOWER[data], offsets)
        row, value, _ = tx.shingles(tx.hash_words(tx.LOWER[data], start, end), rows, k)
        out += [(low + int(r), int(v)) for r, v in zip(row, value, strict=True)]
    return out


@settings(max_examples=60, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_shingles_agree_with_words(texts, k):
    expected = []
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        expected += [(i, tuple(w[j : j + k])) for j in range(len(w) - k + 1)] if len(w) >= k else ([(i, tuple(w))] if w else [])
    got = hashed(texts, k)
    assert [g[0] for g in got] == [e[0] for e in expected]
    names = {}
    assert all(names.setdefault(e[1], g[1]) == g[1] for g, e in zip(got, expected, strict=True))
    assert len(set(names.values())) == len(names)


def test_slices_do_not_change_hashes(monkeypatch):
    texts = ["one two three", "", "x" * 50, "one", "two three " * 9]
    whole = hashed(texts, 2)
    assert hashed(texts, 2, limit=7) == whole
    monkeypatch.setattr(tx, "SLICE", 16)
    assert hashed(texts, 2) == whole


def test_sliced_arrow_columns_and_large_strings():
    column = pa.array(["a b", "c", "d e f", ""])
    assert [v for _, v in hashed(column.slice(1, 2).to_pylist())] == [v for _, v in hashed(["c", "d e f"])]
    got = [(lo, hi, bytes(d)) for lo, hi, d, _ in tx.slices(column.slice(1, 2))]
    assert got == [(0, 2, b"cd e f")]
    assert [bytes(d) for _, _, d, _ in tx.slices(column.cast(pa.large_string()))] == [b"a bcd e f"]


def test_latin_capitals_fold_and_other_bytes_stay():
    data = np.frombuffer("ÉÀ×ßŒA".encode(), np.uint8)
    assert bytes(tx.fold_latin(data)).decode() == "éà×ßŒa"
    assert len(tx.fold_latin(data[:0])) == 0


def test_distinct_sorts_each_row():
    rows = np.array([0, 0, 0, 2, 2])
    values, bounds = tx.distinct(rows, np.array([5, 1, 5, 7, 7], dtype=np.uint64), 4)
    assert values.tolist() == [1, 5, 7] and bounds.tolist() == [0, 2, 2, 3, 3]
