from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest

from tallywork.llm import hard_negatives as hn
from tallywork.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, tuples

SCHEMA = "vec_id long, embedding array<float>, label int"
COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def brute(rows, is_anchor, n_positives=5, n_negatives=3, low=50, high=95):
    """Plain scores of every pair, over rows of (id, vector, label)."""
    held = []
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if (i, tuple(v), y) not in held:
            held.append((i, tuple(v), y))
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in held]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True))
    out = []
    for at, (i, v, y) in enumerate(whole):
        if not is_anchor(i):
            continue
        scored = [(-dot(v, w), j, z) for n, (j, w, z) in enumerate(whole) if n != at and len(w) == len(v)]
        for score, j, _ in sorted(s for s in scored if s[2] == y)[:n_positives]:
            fits = sorted(s for s in scored if s[2] != y and low * -score <= 100 * -s[0] <= high * -score)
            out += [(i, j, rank, k, -score, -s) for rank, (s, k, _) in enumerate(fits[:n_negatives], 1)]
    return sorted(out, key=repr)


def random_rows(n, dim, seed=3, labels=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dim)
    return [(i, [float(np.float32(x)) for x in (0.05 * rng.normal(size=dim) + 0.1 * centre)], int(rng.integers(0, labels))) for i in range(n)]


@pytest.mark.parametrize("dim", [1, 5, 64, 100])
def test_equals_brute_force(llm, monkeypatch, dim):
    monkeypatch.setattr(hn, "ROW_COMPONENTS", 40 * dim)  # several blocks of rows and of anchors
    monkeypatch.setattr(hn, "ANCHOR_COMPONENTS", 7 * dim)
    rows = random_rows(150, dim)
    got = hn.hard_negatives(llm.createDataFrame(rows, SCHEMA), lambda i: i % 5 == 0)
    want = brute(rows, lambda i: i % 5 == 0)
    assert want and tuples(got, *COLUMNS) == want


def bounds(query, x):
    """Bounds at every level."""
    found = []
    hn.Asked(query).narrowed(*hn.encode(x), np.arange(len(x)), lambda low, high: found.append((low, high)) or np.ones(len(low), dtype=bool))
    return found


def test_bounds_hold_every_score_and_narrow():
    rng = np.random.default_rng(9)
    for dim in (1, 3, 64, 130):
        x = np.floor(rng.normal(size=(300, dim)) * 100)
        x[0] = 0
        for q in (x[0], x[1], x[2] * 1000, -x[3]):
            levels = bounds(q, x)
            assert len(levels) == hn.LEVELS and all((low <= x @ q).all() and (x @ q <= high).all() for low, high in levels)
            widths = [(high - low).mean() for low, high in levels]
            assert dim < 64 or not q.any() or widths[-1] < 0.4 * widths[0]


def test_codes_spare_most_scores_also_on_vectors_without_structure():
    x = np.floor(256 * np.random.default_rng(10).normal(size=(8_000, 64)) / 8)
    found = hn.Asked(x[0]).narrowed(*hn.encode(x), np.arange(1, len(x)), lambda low, high: high >= hn._least_of_best(low, 5))
    at = hn._sifted(*found, [(-np.inf, np.inf)], x.astype(np.int64), x[0].astype(np.int64), 5)
    assert set(np.argsort(-(x[1:] @ x[0]))[:5] + 1) <= set(at) and len(at) < 0.1 * len(x)


def test_repeated_rows_ties_and_rows_without_part(llm):
    same = [1.0, 0.5]
    rows = [
        (0, same, 1), (0, same, 1),  # one row
        (2, same, 1), (4, same, 1), (6, [1.0, 0.25], 1), (6, [0.5, 0.5], 1),  # ties, and an id with two vectors
        (3, [0.75, 0.5], 2), (5, [0.75, 0.5], 2), (7, [0.9, 0.3], 0), (8, [-1.0, -1.0], 1), (9, [0.0, 0.0], 2), (10, [0.0, 0.0], 1),
        (12, [1.0, 1.0, 1.0], 1), (14, [1.0, 1.0, 0.9], 1), (13, [0.9, 0.9, 0.9], 2),  # of another length
        (None, same, 2), (21, None, 2), (22, [None, 1.0], 2), (23, [float("nan"), 1.0], 2), (24, [float("inf"), 0.0], 2), (25, same, None), (26, [], 1), (27, [], 2), (28, [], 1),
    ]
    got = hn.hard_negatives(llm.createDataFrame(rows, SCHEMA), lambda i: i % 2 == 0)
    assert tuples(got, *COLUMNS) == brute(rows, lambda i: i % 2 == 0)


def test_other_columns_of_the_same_names_and_no_rows(llm):
    rows = random_rows(40, 4)
    plain = llm.createDataFrame(rows, SCHEMA)
    more = plain.selectExpr("*", "1 AS row", "2 AS dim", "3 AS anchor", "4 AS positive", "5 AS code", "6 AS id")
    assert tuples(hn.hard_negatives(more, lambda i: i % 4 == 0), *COLUMNS) == brute(rows, lambda i: i % 4 == 0)
    assert hn.hard_negatives(plain.limit(0), lambda i: i % 4 == 0).count() == 0
    assert hn.hard_negatives(plain, lambda i: i < 0).count() == 0


def test_vectors_whose_scores_leave_64_bits_are_refused(llm):
    with pytest.raises(Exception, match="64 bits"):
        hn.hard_negatives(llm.createDataFrame([(0, [1e30], 1)], "vec_id long, embedding array<double>, label int"), lambda i: i == 0).count()


def test_a_hot_label_is_many_blocks(llm, monkeypatch):
    monkeypatch.setattr(hn, "ROW_COMPONENTS", 8 * 32)
    rows = [(i, v, 0 if i % 10 else y) for i, v, y in random_rows(400, 8)]
    met = defaultdict(int)
    plain = hn._positives

    def counted(k):
        run = plain(k)
        return lambda a, b: run(a, b).assign(positive_id=len(a))

    got = hn.hard_negatives(llm.createDataFrame(rows, SCHEMA), lambda i: i % 50 == 0)
    assert tuples(got, *COLUMNS) == brute(rows, lambda i: i % 50 == 0)
    monkeypatch.setattr(hn, "_positives", counted)
    sizes = {r.positive_id for r in hn.hard_negatives(llm.createDataFrame(rows, SCHEMA), lambda i: i % 50 == 0).select("positive_id").collect()}
    assert sizes and max(sizes) < 80 and not met


def test_query(llm):
    rows = [(r.vec_id, r.embedding, r.label) for r in llm.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    moved = [(i, v, (y + 1) % 10 if i is not None and y is not None and i % 7 == 0 else y) for i, v, y in rows]
    got = QUERIES["op11_rotated_codes"](llm, FOLDER)
    assert tuples(got, *COLUMNS) == brute(moved, lambda i: i % 50 == 0)
