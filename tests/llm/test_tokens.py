from __future__ import annotations

import os
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallywork.llm import tokens as tk
from tests.llm.conftest import tuples

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = ["The CAT sat.", "", "don't stop — Éé ß µ", "a\x1cb\x1fc", "<|endoftext|> tail", "İstanbul ΟΔΥΣΣΕΥΣ ﬁ", "é x² ½ 12", "你好，world", " \n\t", "THE cat", "A\x85B\xa0C"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(0, 300), st.integers(65_000, 66_000)), max_size=1500), st.sampled_from([(8, 8, 16), (8, 8, 8, 8), (16, 16)]))
def test_codes_round_trip_and_address_any_token(ids, widths):
    codes = tk.Codes(tk.encode(np.array(ids, dtype=np.uint32), widths))
    assert len(codes) == len(ids) and codes.all().tolist() == ids
    assert [codes[i] for i in range(0, len(ids), 7)] == ids[::7]


def test_codes_reject_wrong_positions_and_widths():
    with pytest.raises(IndexError):
        tk.Codes(tk.encode(np.zeros(3, np.uint32)))[3]
    with pytest.raises(ValueError):
        tk.encode(np.zeros(3, np.uint32), (8, 8))


def test_file_round_trip():
    keys, starts, codes = tk.unpack_file(tk.pack_file([None, -5, 7], np.array([2, 0, 1]), np.array([1, 70_000, 9], np.uint32)))
    assert keys == [None, -5, 7] and starts.tolist() == [0, 2, 2, 3] and codes.all().tolist() == [1, 70_000, 9]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_library(name, monkeypatch):
    monkeypatch.setattr(tk, "REMEMBERED", 5)
    path = public_tokenizers.path(name)
    one, other = tk.Encoder(path), Tokenizer.from_file(path)
    for texts in (TEXTS, TEXTS[::-1], [], ["the cat"] * 3):
        flat, counts = one(texts)
        expected = [e.ids for e in other.encode_batch(texts, add_special_tokens=False)]
        assert counts.tolist() == [len(e) for e in expected]
        assert flat.tolist() == [i for e in expected for i in e]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_encoder_equals_library_on_any_text(texts):
    flat, counts = tk.encoder(PATH)(texts)
    expected = [e.ids for e in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(e) for e in expected] and flat.tolist() == [i for e in expected for i in e]


def brute(rows):
    other, at, out = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()))):
        ids = [*other.encode(text or "", add_special_tokens=False).ids, 1]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return sorted(out, key=repr)


def test_report_reads_back_what_was_written(docs):
    rows = [(i * 3 % 17, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (50, None), (50, "again"), (50, "again"), (99, "long " * 30_000)]
    got = tk.token_report(docs(rows), PATH)
    assert tuples(got, "doc_id", "start", "n_tokens", "ids_crc32") == brute(rows)


def test_many_small_files_keep_the_order(docs, llm):
    rows = [(i, f"word{i} the cat") for i in range(200)]
    folder = tk.new_folder(llm, "tokens-test")
    manifest = tk.write_tokens(docs(rows), folder, PATH, file_tokens=50)
    assert manifest.count() > 10
    assert tuples(tk.read_documents(folder, manifest), "doc_id", "start", "n_tokens", "ids_crc32") == brute(rows)


def test_orphans_of_failed_attempts_are_not_read(docs, llm):
    folder = tk.new_folder(llm, "tokens-test")
    manifest = tk.write_tokens(docs([(1, "a"), (2, "b")]), folder, PATH)
    path = folder.removeprefix("file://")
    name = next(n for n in os.listdir(path) if n.endswith(".dac"))
    with open(f"{path}/{name}", "rb") as f, open(f"{path}/{name[:-4]}9.dac", "wb") as g:
        g.write(f.read())
    assert tk.read_documents(folder, manifest).count() == 2


def test_empty_table(docs):
    assert tk.token_report(docs([]), PATH).count() == 0
