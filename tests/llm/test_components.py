from __future__ import annotations

import random

import pytest

from tallywork.llm.components import components, roots


def brute(edges):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        top[high] = low
    return {x: find(x) for x in top if find(x) != x}


@pytest.mark.parametrize("seed", range(3))
def test_components_against_union_find(llm, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(20)] + [(5, 5), (200, 199)]
    got = {r.id: r.root for r in components(llm.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute(edges)


def test_roots_of_a_chain(llm):
    got = roots(llm.createDataFrame([(i + 1, i) for i in range(33)], "id long, parent long"))
    assert {(r.id, r.root) for r in got.collect()} == {(i + 1, 0) for i in range(33)}


def test_no_edges(llm):
    assert components(llm.createDataFrame([], "a long, b long")).count() == 0
