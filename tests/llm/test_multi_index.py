from __future__ import annotations

import numpy as np
import pytest

from tallywork.llm import multi_index as mi

SCHEMA = "vec_id long, embedding array<float>, cell int, part int, v string"


def table(llm, rows):
    return llm.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2, "x") for i, v in rows], SCHEMA)


def exact(rows, queries, k):
    ids, x = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for q in queries:
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        order = [o for o in np.lexsort((ids, d)) if ids[o] != q][:k]
        out[q] = [(r + 1, int(ids[o]), float(d[o])) for r, o in enumerate(order)]
    return out


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_all_candidates_give_the_exact_answer_with_ties(llm, monkeypatch):
    monkeypatch.setattr(mi, "PART_ENTRIES", 40)
    rng = np.random.default_rng(0)
    rows = [(i, rng.integers(-2, 3, 6)) for i in range(400) if i]
    rows = [(i, v if np.any(v) else v + 1) for i, v in rows] + [(1000 + i, [1, 1, 1, 1, 1, 1]) for i in range(150)]
    got = found(mi.nearest(table(llm, rows), lambda i: i % 100 == 0, k=10, candidates=10_000))
    expected = exact(rows, [i for i, _ in rows if i % 100 == 0], 10)
    assert {q: [(r, v) for r, v, _ in x] for q, x in got.items()} == {q: [(r, v) for r, v, _ in x] for q, x in expected.items()}
    assert all(a[2] == pytest.approx(b[2], rel=1e-12) for q in got for a, b in zip(got[q], expected[q], strict=True))


def test_recall_on_random_vectors(llm):
    x = np.random.default_rng(3).normal(size=(4000, 32))
    rows = [(i, v) for i, v in enumerate(x)]
    expected = exact(rows, range(0, 4000, 100), 10)
    got = found(mi.nearest(table(llm, rows), lambda i: i % 100 == 0, candidates=100))
    assert set(got) == set(expected)
    recall = np.mean([len({v for _, v, _ in got[q]} & {v for _, v, _ in expected[q]}) / 10 for q in expected])
    assert recall >= 0.9
    for q, hits in got.items():  # scores and ranks are exact for what is found
        assert [r for r, _, _ in hits] == list(range(1, 11)) and [s for _, _, s in hits] == sorted(s for _, _, s in hits)


@pytest.mark.parametrize("seed", range(4))
def test_traversal_visits_cells_in_order_of_summed_distance(seed):
    rng = np.random.default_rng(seed)
    left, right, counts = rng.random(7), rng.random(9), rng.integers(0, 4, 63)
    cells, reach = mi.traverse(left, right, counts, 40)
    total = (left[:, None] + right[None]).ravel()
    order = [c for c in np.argsort(total) if counts[c]]
    need = int(np.searchsorted(np.cumsum(counts[order]), 40)) + 1
    assert cells == order[:need] and reach == pytest.approx(total[cells[-1]])
    assert set(mi.traverse(left, right, counts, 10_000)[0]) == set(order)


def test_vectors_that_take_no_part(llm):
    nan, inf = float("nan"), float("inf")
    rows = [(100, [1, 0]), (1, [1, 1]), (2, [0, 0]), (3, None), (4, [nan, 1]), (5, [inf, 1]), (6, [None, 1]), (7, [1, 2, 3]), (8, []), (None, [1, 1]), (200, [0, 0]), (9, [2, 0]), (9, [2, 0])]
    got = found(mi.nearest(table(llm, rows), lambda i: i % 100 == 0))
    assert got == {100: [(1, 1, 1.0), (2, 9, 1.0)]}


def test_an_id_with_several_vectors_loses_none(llm):
    rows = [(100, [0, 1]), (5, [0, 2]), (5, [0, 4]), (5, [0, 2]), (100, [0, 3])]
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in mi.nearest(table(llm, rows), lambda i: i % 100 == 0).collect())
    # Both rows of id 100 are queries, and each is a candidate of the other.
    assert got == [(100, 1, 5, 1.0), (100, 1, 5, 1.0), (100, 2, 5, 1.0), (100, 2, 100, 2.0), (100, 3, 5, 3.0), (100, 3, 100, 2.0)]


@pytest.mark.parametrize("queries", [3, 1_000])
def test_blocks_of_queries_give_the_same(llm, monkeypatch, queries):
    monkeypatch.setattr(mi, "BLOCK_QUERIES", queries)
    monkeypatch.setattr(mi, "PART_ENTRIES", 50)
    x = np.random.default_rng(6).normal(size=(600, 8))
    rows = [(i, v) for i, v in enumerate(x)]
    got = found(mi.nearest(table(llm, rows), lambda i: i % 20 == 0, k=5, candidates=10_000))
    want = exact(rows, range(0, 600, 20), 5)
    assert {q: [(r, v) for r, v, _ in h] for q, h in got.items()} == {q: [(r, v) for r, v, _ in h] for q, h in want.items()}


def test_few_or_no_vectors(llm):
    assert mi.nearest(table(llm, []), lambda i: i % 100 == 0).count() == 0
    assert mi.nearest(table(llm, [(100, [1, 2])]), lambda i: i % 100 == 0).count() == 0
    assert found(mi.nearest(table(llm, [(100, [3]), (5, [5]), (4, [5])]), lambda i: i % 100 == 0)) == {100: [(1, 4, 2.0), (2, 5, 2.0)]}
