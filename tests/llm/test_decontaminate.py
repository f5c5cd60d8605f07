from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallywork.llm import decontaminate as dc
from tests.llm.conftest import tuples

ITEMS = "item_id long, text string"


def smith_waterman(q, t):
    best, last = 0, 0
    table = [[0] * (len(t) + 1) for _ in range(len(q) + 1)]
    for i, a in enumerate(q, 1):
        for j, b in enumerate(t, 1):
            table[i][j] = max(0, table[i - 1][j - 1] + (dc.MATCH if a == b else dc.MISMATCH), table[i - 1][j] + dc.GAP, table[i][j - 1] + dc.GAP)
    for row in table[1:]:
        for j, v in enumerate(row[1:]):
            if v > best:
                best, last = v, j
    return best, last


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(5, 9), min_size=1, max_size=9), st.lists(st.integers(5, 9), max_size=14)), max_size=6))
def test_alignment_against_the_full_table(pairs):
    score, last = dc.align([np.array(q, np.uint64) for q, _ in pairs], [np.array(t, np.uint64) for _, t in pairs])
    assert [(s, e) for s, e in zip(score.tolist(), last.tolist(), strict=True)] == [smith_waterman(q, t) for q, t in pairs]


def words(rng, n):
    return [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.randrange(300)}" for _ in range(n)]


def test_planted_copies_are_found_and_clean_documents_left(llm, docs):
    rng = random.Random(2)
    items = [(i, words(rng, rng.randint(12, 50))) for i in range(30)]
    rows, expected = [], set()
    for d in range(200):
        text = words(rng, rng.randint(0, 150))
        if d % 4 == 0:
            item, copy = rng.choice(items)
            copy = list(copy)
            for _ in range(len(copy) // 10 if d % 8 else 0):
                copy[rng.randrange(len(copy))] = "edited"
            at = rng.randint(0, len(text))
            text = [*text[:at], *copy, *text[at:]]
            expected.add((d, item))
        rows.append((d, ", ".join(text).upper() if d % 3 else " ".join(text)))
    bench = llm.createDataFrame([(i, " ".join(w).capitalize() + ".") for i, w in items], ITEMS)
    got = dc.contamination(docs(rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected
    for r in got:
        if r.doc_id % 8 == 0:
            found = rows[r.doc_id][1].replace(",", "").lower().split()[r.start_word : r.end_word]
            assert r.similarity == 1.0 and found == dict(items)[r.item_id]


def test_a_passage_of_most_documents_keeps_its_seeds(llm, docs):
    passage = "every single document here repeats this one passage of the benchmark word for word"
    rows = [(i, f"lead{i} {passage} tail{i}") for i in range(300)] + [(900, "every single document here is clean")]
    got = dc.contamination(docs(rows), llm.createDataFrame([(7, passage)], ITEMS))
    assert {r.doc_id for r in got.collect()} == set(range(300))


def test_the_rarest_seed_of_each_pair_comes_first():
    row, item, count = np.array([0, 0, 0, 1, 1]), np.array([2, 2, 3, 2, 2]), np.array([5, 1, 9, 4, 4])
    assert dc._rarest(row, item, count).tolist() == [False, True, True, True, True]
    assert len(dc._rarest(*(np.zeros(0, np.int64) for _ in range(3)))) == 0


def test_short_items_and_scripts_without_spaces(llm, docs):
    items = [(1, "alpha beta gamma"), (2, "\u6c34\u304c\u6d41\u308c\u308b\u9752\u3044\u5ddd\u306e\u4e0a\u306b\u6708\u304c\u51fa\u308b\u591c"), (3, "Solo"), (4, "two words"), (5, "\u0e19\u0e49\u0e33\u0e43\u0e2a"), (6, "..."), (7, "\u5c71\U00020000")]
    texts = [t for _, t in items]
    rows = [
        (1, f"before {texts[0].upper()}, after"), (2, f"x{texts[1]}y"), (3, "a solo act"), (4, "two, words"), (5, f"abc {texts[4]}"), (6, "alpha beta delta"), (7, f"{texts[1][:6]}\u5c71{texts[1][6:]}"),
        (8, f"{texts[1][:4]} and nothing more"), (9, "... "), (10, f"q{texts[6]}"), (11, "alpha"), (12, "words two"),
    ]
    got = {(r.doc_id, r.item_id, r.similarity) for r in dc.contamination(docs(rows), llm.createDataFrame(items, ITEMS)).collect()}
    assert {(d, i) for d, i, _ in got} == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (7, 2), (10, 7)}
    assert all(s == 1.0 for d, _, s in got if d != 7)


def test_words_of_mixed_scripts():
    column = "ab\u6c34cd \u3042\u3044x|\u6c34"
    for texts in ([column], ["", column, "", "z\u6c34", "\u6c34"]):
        raw = [t.encode() for t in texts]
        offsets = np.r_[0, np.cumsum([len(r) for r in raw])]
        rows, hashes = dc._document_words(np.frombuffer(b"".join(raw), np.uint8), offsets)
        want = [(i, w) for i, t in enumerate(texts) for w in re.findall(r"[\u3040-\u30ff\u3400-\u9fff]|[a-z]+", t)]
        same = {}
        assert rows.tolist() == [i for i, _ in want] and all(same.setdefault(w, h) == h for (_, w), h in zip(want, hashes.tolist(), strict=True))
        assert len(set(same.values())) == len(same)


@pytest.mark.parametrize("chars", [10, 10_000])
def test_blocks_hold_every_item_once(llm, monkeypatch, docs, chars):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, 15))) for i in range(20)] + [(None, "no id at all in this one"), (3, None), (4, "")]
    bench = llm.createDataFrame(rows + rows[:2], ITEMS)
    assert sorted(x for b in dc.blocks(bench, chars=chars) for x in b) == sorted((i, t or "") for i, t in rows if i is not None)
    monkeypatch.setattr(dc.blocks, "__defaults__", ("item_id", "text", chars))
    table = docs([(i, f"before {t} after") for i, t in rows[:20]] + [(99, None), (99, ""), (None, rows[5][1]), (50, "x " * 40_000 + rows[6][1])])
    assert tuples(dc.contamination(table, bench), "doc_id", "item_id") == sorted([(i, i) for i in range(20)] + [(None, 5), (50, 6)], key=repr)


def test_repeated_rows_empty_tables_and_stage(llm, docs):
    text = "one two three four five six seven eight"
    bench = llm.createDataFrame([(1, text), (2, "too short"), (3, None)], ITEMS)
    table = docs([(1, text), (1, text), (2, "short words only"), (None, "clean"), (4, None)])
    assert tuples(dc.contamination(table, bench), "doc_id", "item_id", "score") == [(1, 1, 16), (1, 1, 16)]
    kept = dc.decontaminated(table, bench)
    assert kept.columns == table.columns and tuples(kept, "doc_id") == sorted([(2,), (None,), (4,)], key=repr)
    assert dc.contamination(docs([]), bench).count() == 0
    assert dc.contamination(table, llm.createDataFrame([], ITEMS)).count() == 0


def full_alignments(rows, items, n=4):
    """Pairs that share an n-gram and whose full table reaches 0.6, with the score."""
    out = {}
    for d, text in rows:
        t = text.split()
        held = {tuple(t[i : i + n]) for i in range(len(t) - n + 1)}
        for i, q in items:
            if any(tuple(q[j : j + n]) in held for j in range(len(q) - n + 1)):
                score = smith_waterman(q, t)[0]
                if score >= 0.6 * dc.MATCH * len(q):
                    out[d, i] = score
    return out


def test_edited_copies_against_full_alignment(llm, docs):
    rng = random.Random(8)
    items = [(i, words(rng, 50)) for i in range(40)]
    rows = [(1000 + i, " ".join(q)) for i, q in items[::2]]
    for i, q in items:
        copy = list(q)
        for at in rng.sample(range(50), 5 + i % 8):
            copy[at] = f"edit{i}x{at}"
        rows.append((i, " ".join([*words(rng, 30), *copy, *words(rng, 30)])))
    expected = full_alignments(rows, items)
    assert len(expected) > 45
    got = dc.contamination(docs(rows), llm.createDataFrame([(i, " ".join(q)) for i, q in items], ITEMS)).collect()
    assert {(r.doc_id, r.item_id): r.score for r in got} == expected


def test_steps_keep_rows_together(monkeypatch):
    monkeypatch.setattr(dc, "STEP_SEEDS", 5)
    row, fan = np.array([0, 0, 1, 2, 2, 2, 7, 8]), np.array([1, 2, 3, 4, 4, 4, 1, 1])
    steps = list(dc._steps(row, fan))
    assert [i for s in steps for i in range(s.start, s.stop)] == list(range(8)) and len(steps) > 2
    assert all(set(row[a]).isdisjoint(row[b]) for a in steps for b in steps if a is not b)


def test_inserted_passages_against_full_alignment(llm, docs):
    rng = random.Random(9)
    items = [(i, words(rng, 40)) for i in range(20)]
    rows = []
    for i, q in items:
        split = rng.randint(12, 28)
        rows.append((i, " ".join([*words(rng, 40), *q[:split], *[f"in{i}x{k}" for k in range(15 + i)], *q[split:], *words(rng, 40)])))
    # One inserted word at a time, as far as the threshold allows.
    rows += [(100 + i, " ".join(w for k, x in enumerate(q) for w in ([x, f"in{i}x{k}"] if k % 4 == 3 else [x]))) for i, q in items]
    expected = full_alignments(rows, items)
    assert len(expected) > 32
    got = dc.contamination(docs(rows), llm.createDataFrame([(i, " ".join(q)) for i, q in items], ITEMS)).collect()
    assert {(r.doc_id, r.item_id): r.score for r in got} == expected


def test_share_of_all_similar_pairs_that_is_found(llm, docs):
    """Of pairs whose full table reaches 0.6, also those without a common 4-gram: a copy edited at every fourth word has none."""
    rng = random.Random(12)
    items = [(i, words(rng, 40)) for i in range(30)]
    rows = []
    for i, q in items:
        for edits in (4, 8, 10, 11):
            copy = list(q)
            for at in rng.sample(range(40), edits):
                copy[at] = f"e{i}x{edits}x{at}"
            rows.append((i * 100 + edits, " ".join(copy)))
    similar = {(d, i) for d, t in rows for i, q in items if smith_waterman(q, t.split())[0] >= 0.6 * dc.MATCH * len(q)}
    got = {(r.doc_id, r.item_id) for r in dc.contamination(docs(rows), llm.createDataFrame([(i, " ".join(q)) for i, q in items], ITEMS)).collect()}
    assert got <= similar and len(similar) > 60 and len(got) / len(similar) >= 0.99


def test_perfect_copies_beside_edited_ones_keep_their_place(llm, docs):
    """Deciding a pair by its rarest seeds gives what all seeds give: the first perfect copy."""
    item = [f"w{i}" for i in range(20)]
    edited = [*item[:9], "x", *item[10:]]
    rows = [(1, " ".join([*edited, *["y"] * 50, *item, *["z"] * 50, *item])), (2, " ".join([*item, *["y"] * 40, *edited])), (3, " ".join(edited))]
    got = tuples(dc.contamination(docs(rows), llm.createDataFrame([(1, " ".join(item))], ITEMS)), "doc_id", "score", "start_word", "end_word")
    assert got == [(1, 40, 70, 90), (2, 40, 0, 20), (3, 37, 0, 20)]
