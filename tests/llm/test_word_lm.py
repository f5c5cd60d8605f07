from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from tallywork.llm import word_lm as wl
from tallywork.llm.queries import QUERIES

TARGET = "doc_id long, text string"


def symbols(text):
    return [*re.findall(r"[^\W_]+", (text or "").lower()), None]


def pairs(text):
    s = symbols(text)
    return list(zip([None, *s[:-1]], s, strict=True))


def brute(rows, chosen):
    """Losses straight from the module's formula, with every document's own counts taken off."""
    split = [(i, symbols(t), pairs(t), i is not None and i in chosen) for i, t in rows]
    n1, n2, m1, m2 = Counter(), Counter(), Counter(), Counter()
    for _, s, p, marked in split:
        n1.update(s)
        n2.update(p)
        if marked:
            m1.update(s)
            m2.update(p)
    size = sum(1 for n in n1.values() if n > 1) + 1
    all_n, all_m = sum(n1.values()), sum(m1.values())
    share = all_m / all_n
    out = []
    for i, s, p, marked in split:
        c1, c2 = Counter(s), Counter(p)

        def loss(one, two, total, own, scale, c1=c1, c2=c2, s=s, p=p):
            x1 = lambda w: scale * (one[w] - own * c1[w])
            x2 = lambda w: scale * (two[w] - own * c2[w])
            whole = scale * (total - own * len(s))
            logs = [math.log((x1(w) + 0.5) / (whole + 0.5 * size)) + math.log((x2((c, w)) + 0.5) / (x1(c) + 0.5 * size)) for c, w in p]
            return -sum(logs) / 2 / len(s)

        target, background = loss(m1, m2, all_m, 1 if marked else 0, 1), loss(n1, n2, all_n, 1, share)
        out.append((i, len(s), target, background, target - background))
    return out


def texts():
    rng = random.Random(1)
    good = [" ".join(rng.choices(["The", "cat", "sat,", "on", "é"], k=rng.randint(1, 20))) for _ in range(20)]
    bad = [" ".join(rng.choices(["dog", "ran", "the", "far"], k=rng.randint(0, 20))) for _ in range(20)]
    return [*good, *bad, "", None, "the cat", "the cat", "...", "  x "]


@pytest.mark.parametrize("chosen", [[*range(15), 5, 9999, None, 42], []])
def test_scores_against_the_recursion(llm, docs, chosen):
    rows = [*enumerate(texts()), (3, "repeated id"), (3, "repeated id"), (None, "no id"), (None, "no id"), (None, None)]
    got = wl.word_cross_entropy_difference(docs(rows), llm.createDataFrame([(i, "x") for i in chosen], TARGET)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], round(r[2], 7), round(r[3], 7))
    got, expected = sorted((tuple(r) for r in got), key=key), sorted(brute(rows, chosen), key=key)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[2:] == pytest.approx(e[2:], abs=1e-6)


def test_query_tells_subjects_of_the_same_spelling_apart(llm, tmp_path):
    """Word order decides: both kinds of documents hold the same words, so the same letters."""
    rng = random.Random(3)
    names = [f"{a}{b}" for a in "bdfg" for b in ("an", "en", "on", "un")]
    follow = {k: dict(zip(names, rng.sample(names, len(names)), strict=True)) for k in (0, 1)}
    rows = []
    for d in range(200):
        w = [rng.choice(names)]
        while len(w) < 40:
            w.append(follow[d % 2][w[-1]] if rng.random() < 0.8 else rng.choice(names))
        rows.append((d, " ".join(w)))
    llm.createDataFrame(rows, TARGET).write.parquet(f"{tmp_path}/documents.parquet")
    llm.createDataFrame([(d, d % 2) for d in range(100)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r.score for r in QUERIES["op3_cross_entropy_difference"](llm, str(tmp_path)).collect()}
    assert max(got[d] for d in range(101, 200, 2)) < min(got[d] for d in range(100, 200, 2))


@pytest.mark.parametrize("head", [0, 3, 1 << 20])
def test_frequent_keys_score_the_same_held_or_joined(llm, docs, monkeypatch, head):
    rows = [*enumerate(texts())]
    monkeypatch.setattr(wl, "HEAD", head)
    monkeypatch.setattr(wl, "FEW_IDS", head)
    got = wl.word_cross_entropy_difference(docs(rows), llm.createDataFrame([(i, "x") for i in range(15)], TARGET)).collect()
    want = {r[0]: r[4] for r in brute(rows, set(range(15)))}
    assert {r.doc_id: r.score for r in got} == {i: pytest.approx(x, abs=1e-8) for i, x in want.items()}


def test_score_tells_likeness_not_membership(llm, docs):
    """Half of the good documents are the target; the other half scores like it, and all others worse."""
    rng = random.Random(5)
    names = [f"{a}{b}{c}" for a in "bdfgklmn" for b in "aeiou" for c in "rst"]
    likely = {k: [rng.choices(range(1, 9), k=1)[0] ** 2 for _ in names] for k in (0, 1)}
    rows = [(d, " ".join([*rng.choices(names, likely[d % 2], k=60), *(f"own{d}x{j}" for j in range(5))])) for d in range(300)]
    target = llm.createDataFrame([(d, "x") for d in range(1, 150, 2)], TARGET)
    got = {r.doc_id: r.score for r in wl.word_cross_entropy_difference(docs(rows), target).collect()}
    mean = lambda ids: sum(got[d] for d in ids) / len(ids)
    inside, left_out, others = mean(range(1, 150, 2)), mean(range(151, 300, 2)), mean(range(0, 300, 2))
    assert abs(inside - left_out) < 0.1 * (others - left_out) and left_out < others


def test_a_row_that_holds_a_third_of_all(llm, docs):
    rows = [*((7, "the cat sat") for _ in range(60)), *enumerate(texts(), 100)]
    got = wl.word_cross_entropy_difference(docs(rows), llm.createDataFrame([(7, "x"), (101, "x")], TARGET)).collect()
    want = {r[0]: r[4] for r in brute(rows, {7, 101})}
    assert len(got) == len(rows) and all(r.score == pytest.approx(want[r.doc_id], abs=1e-8) for r in got)


def test_empty_tables(llm, docs):
    none = llm.createDataFrame([], TARGET)
    assert wl.word_cross_entropy_difference(docs([]), none).count() == 0
