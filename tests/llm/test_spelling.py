from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywork.llm import spelling as sp
from tallywork.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, tuples

COLUMNS = ("word", "n", "n_near", "form", "form_n", "root")


def brute(documents, least_letters=7, least_n=2, ratio=10, one_in=31):
    """Near words by wildcard patterns of the words themselves."""
    counts = Counter()
    for name, text in documents:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if one_in:
                h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
                if h % one_in == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_letters and n >= least_n}
    holes, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "?" + w[i + 1 :]].add(w)
            short = w[:i] + w[i + 1 :]
            if short in words:
                near[w].add(short)
                near[short].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], words.get(form[w]), root))
    return sorted(out, key=repr)


def edit_neighbours(word, symbols):
    """The full one-edit neighbourhood, spelt out."""
    out = {word}
    for i in range(len(word) + 1):
        out |= {word[:i] + (s,) + word[i:] for s in symbols}
        if i < len(word):
            out |= {word[:i] + (s,) + word[i + 1 :] for s in symbols} | {word[:i] + word[i + 1 :]}
    return out


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="abcdeé", min_size=1, max_size=9), min_size=1, max_size=6))
def test_neighbourhoods_are_full_and_distinct(words):
    letters = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    bounds = np.r_[0, np.cumsum([len(w) for w in words])]
    made = defaultdict(list)
    for word, key in sp._Reduced(letters, bounds).neighbourhoods():
        for w, k in zip(word.tolist(), key.tolist(), strict=True):
            made[w].append(k)
    for i, w in enumerate(words):
        reduced = tuple(int(sp._SYMBOL[c]) for c in w.encode("latin-1"))
        want = set()
        for near in edit_neighbours(reduced, range(1, sp.SYMBOLS + 1)):
            value = sum(s * pow(sp._BASE, at, 2**64) for at, s in enumerate(near)) % 2**64
            with np.errstate(over="ignore"):
                want.add(int(sp.tx.mix(np.uint64(value) + np.uint64(len(near)) * sp._LENGTH)))
        assert len(made[i]) == len(set(made[i])) and set(made[i]) == want


def test_pieces_give_the_same_neighbourhoods(monkeypatch):
    words = ["abcabcabc", "aaaa", "b", "ccddeeff"]
    letters, bounds = np.frombuffer("".join(words).encode(), np.uint8), np.r_[0, np.cumsum([len(w) for w in words])]
    collect = lambda: sorted((w, k) for a, b in sp._Reduced(letters, bounds).neighbourhoods() for w, k in zip(a.tolist(), b.tolist(), strict=True))
    whole = collect()
    monkeypatch.setattr(sp, "PIECE", 3)
    assert collect() == whole


def test_edits_forms_and_chains(docs):
    text = (
        "Keyboard " * 200 + "keybord " * 15 + "keybrd " + "keybrd " + "keyboards keyboards kexboard kexboard " + "kyeboard kyeboard "  # a swap is two edits
        + "KÉYBOARD KÉYBOARD kéyboard kéyboard " + "alpha×beta alpha×beta alpha÷beta " + "once-only singletons"
    )
    rows = [(1, text), (2, ""), (3, None), (None, "keyboard keyboard"), (4, "keyboard"), (4, "keyboard"), (5, "short words are out: keybo keybo")]
    got = sp.spelling_variants(docs(rows))
    assert tuples(got, *COLUMNS) == brute(rows, one_in=None)
    by = {r.word: r for r in got.collect()}
    assert by["keybord"].form == "keyboard" and by["keyboard"].n == 204 and by["kyeboard"].form is None
    assert by["kÉyboard"].n == 2 and by["kéyboard"].n == 2 and by["kéyboard"].form == "keyboard"


def test_chains_end_at_their_root(docs):
    rows = [(1, "abcdefgh " * 2000 + "abcdefg " * 200 + "abcdefgx " * 20 + "abcdefgxy " * 2)]
    got = {r.word: (r.form, r.root) for r in sp.spelling_variants(docs(rows)).collect()}
    assert got["abcdefgxy"] == ("abcdefgx", "abcdefgh") and got["abcdefgx"] == ("abcdefgh", "abcdefgh") and got["abcdefgh"] == (None, "abcdefgh")


def test_ties_go_to_the_smallest_word(docs):
    rows = [(1, "zebraone " * 30 + "zebratwo zebratwo " + "zebraune " * 30 + "zebraane " * 30 + "zebranne zebranne")]
    assert tuples(sp.spelling_variants(docs(rows)), *COLUMNS) == brute(rows, one_in=None)


def test_very_long_runs(docs):
    long = "ab" * 40_000
    rows = [(1, long), (2, long), (3, long + "c"), (4, long + "c"), (5, long[:-1]), (6, long[:-1]), (7, "x" + long), (8, "x" + long)]
    got = {len(r.word): r.n_near for r in sp.spelling_variants(docs(rows)).select("word", "n_near").collect()}
    assert got[80_000] == 3  # its extensions by either side and the one that lacks a letter
    assert len(got) == 3


def test_an_empty_table(docs):
    assert sp.spelling_variants(docs([(1, "x")]).limit(0)).count() == 0


def test_deletions_follow_the_checksum(docs):
    rows = [(i, "electricity magnificent wonderful Straßenbahn") for i in range(200)] + [(None, "electricity")]
    assert tuples(sp.spelling_variants(docs(rows), one_in=31), *COLUMNS) == brute(rows)


def test_query(llm):
    documents = [(r.doc_id, r.text) for r in llm.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    assert tuples(QUERIES["op12_spelling_variants"](llm, FOLDER), *COLUMNS) == brute(documents)
