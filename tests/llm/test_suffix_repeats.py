from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from tallywork.llm import suffix_repeats as sr
from tallywork.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, tuples

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def brute(documents, length=200):
    """Counts every string of ``length`` bytes."""
    texts = [(i, (t or "").encode()) for i, t in documents]
    counts = Counter(t[p : p + length] for _, t in texts for p in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if counts[t[p : p + length]] > 1:
                gone[p : p + length] = b"\x01" * length
        runs = sum(1 for p, g in enumerate(gone) if g and (p == 0 or not gone[p - 1]))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randint(2, 9))) for _ in range(n))


def near_copies(n, passage, seed=1):
    """Documents that hold a passage, cut at both ends by other amounts and edited in places."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        own = passage[rng.randint(0, 80) : len(passage) - rng.randint(0, 80)]
        if i % 3 == 0:
            at = rng.randint(0, len(own) - 1)
            own = own[:at] + "#" + own[at + 1 :]
        out.append((i, f"{prose(1000 + i, rng.randint(0, 30))} {own} {prose(5000 + i, rng.randint(0, 30))}"))
    return out


def test_equals_brute_force_on_near_copies(docs):
    rows = near_copies(60, prose(7, 150))
    want = brute(rows)
    assert sum(r[2] for r in want) > 0
    assert tuples(sr.without_repeats(docs(rows)), *COLUMNS) == want


@pytest.mark.parametrize("members", [2, 5])
def test_refined_grams_give_the_same(docs, monkeypatch, members):
    monkeypatch.setattr(sr, "MEMBERS", members)
    rows = near_copies(50, prose(8, 120), seed=4)
    assert tuples(sr.without_repeats(docs(rows)), *COLUMNS) == brute(rows)


@pytest.mark.parametrize("n", [198, 199, 200, 201, 263])
def test_the_threshold_is_exact(docs, n):
    passage = prose(9, 100)[:n].encode("ascii", "replace").decode()
    rows = [(1, "x" + passage + "y"), (2, "q" + passage + "z")]
    got = tuples(sr.without_repeats(docs(rows)), *COLUMNS)
    assert got == brute(rows) and [r[2] for r in got] == [n if n >= 200 else 0] * 2


def test_periodic_empty_repeated_and_nameless(docs):
    rows = [
        (1, "a" * 1000), (2, "ab" * 300), (3, "abc" * 66 + "ab"), (4, "abc" * 67), (5, ""), (6, None), (7, "short"), (8, prose(3, 60)), (8, prose(3, 60)), (9, prose(3, 60)),
        (None, prose(4, 60)), (None, prose(4, 60) + "x"), (10, "short"), (11, "b" * 199), (12, "b" * 199), (13, "é" * 150 + "z"), (14, "é" * 150),
    ]
    assert tuples(sr.without_repeats(docs(rows)), *COLUMNS) == brute(rows)


def test_a_passage_repeated_inside_one_text(docs):
    passage = prose(5, 50)
    rows = [(1, f"{passage}{prose(6, 20)}{passage}{prose(10, 20)}{passage[40:]}"), (2, prose(11, 300))]
    assert tuples(sr.without_repeats(docs(rows)), *COLUMNS) == brute(rows)


def test_very_long_texts_come_in_pieces(docs, monkeypatch):
    plain = prose(12, 6_000)
    rows = [(1, plain), (2, "head " + plain[5_000:20_000] + " tail"), (3, prose(13, 20) + plain[100:400])]
    want = brute(rows)
    assert tuples(sr.without_repeats(docs(rows)), *COLUMNS) == want
    column = pa.array([plain], pa.string())
    whole = [s for _, s in sr.sections(column, 200)]
    monkeypatch.setattr(sr, "_PIECE", 1_000)
    monkeypatch.setattr(sr.tx, "SLICE", 500)
    pieces = [s for _, s in sr.sections(column, 200)]
    starts = lambda found: sorted(p for s in found for a, b in zip(s.first.tolist(), s.last.tolist(), strict=True) for p in range(a, b + 1))
    assert len(pieces) > 5 and starts(pieces) == starts(whole) == list(range(len(plain.encode()) - 199))
    assert {(g, a) for s in pieces for g, a in zip(s.gram.tolist(), s.anchor.tolist(), strict=True)} == {(g, a) for s in whole for g, a in zip(s.gram.tolist(), s.anchor.tolist(), strict=True)}


def test_what_is_left_comes_back(docs):
    passage = prose(14, 60)
    rows = [(1, f"one {passage} end"), (2, f"two {passage}"), (3, "alone")]
    got = {r.doc_id: r for r in sr.without_repeats(docs(rows), rest=True).collect()}
    assert bytes(got[2].rest) == b"two" and got[3].rest is None
    assert hashlib.sha256(bytes(got[1].rest)).hexdigest() == got[1].kept_sha256


def test_an_empty_table(docs):
    assert sr.without_repeats(docs([(1, "x")]).limit(0)).count() == 0
    assert sr.maximal_repeats(docs([(1, "x")]).limit(0)).count() == 0


def test_interval_tree_of_a_known_array():
    rights = [b"banana", b"anana", b"nana", b"ana", b"na", b"a"]
    order, found = sr.interval_tree(rights)
    assert [rights[i] for i in order] == sorted(rights)
    parts = dict(enumerate(found, len(rights)))

    def members(p):
        return {p} if p < len(rights) else set().union(*map(members, parts[p][1]))

    groups = {(rights[min(members(p))][:value], frozenset(members(p))) for p, (value, _) in parts.items() if value}
    assert groups == {(b"a", frozenset({1, 3, 5})), (b"ana", frozenset({1, 3})), (b"na", frozenset({2, 4}))}


def test_repeats_list_every_member_with_its_widest_sides():
    lefts, rights = [b"xxab", b"yyab", b"zzzb", b"qqqq"], [b"common-1", b"common-2", b"common-1", b"other"]
    got = set(sr.repeats(lefts, rights, 8))
    # The first and third agree on "b" and all of "common-1"; the first two on "ab" and "common-".
    assert got == {(0, 1, 8), (2, 1, 8), (0, 2, 7), (1, 2, 7)}


def test_maximal_repeats_list_all_occurrences(docs):
    passage = prose(15, 50)
    texts = [f"{prose(20 + i, 5)} {passage} {prose(40 + i, 5)}" for i in range(6)]
    got = sr.maximal_repeats(docs(list(enumerate(texts)))).collect()
    by_digest = {hashlib.sha256(t.encode()).digest(): t.encode() for t in texts}
    groups = defaultdict(set)
    for r in got:
        groups[r.repeat].add((bytes(by_digest[bytes(r.digest)][r.start : r.start + r.n_bytes]), bytes(r.digest)))
    assert groups and all(len({s for s, _ in g}) == 1 and len(g) > 1 for g in groups.values())
    covered = {bytes(r.digest): set() for r in got}
    for r in got:
        covered[bytes(r.digest)] |= set(range(r.start, r.start + r.n_bytes))
    want = {r[0]: r[2] for r in brute(list(enumerate(texts)))}
    assert [len(covered[hashlib.sha256(t.encode()).digest()]) for t in texts] == [want[i] for i in range(6)]


def test_query(llm):
    documents = [(r.doc_id, r.text) for r in llm.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    want = brute(documents)
    assert sum(r[2] for r in want) and tuples(QUERIES["op13_suffix_repeats"](llm, FOLDER), *COLUMNS) == want
