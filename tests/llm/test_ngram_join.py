from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from tallywork.llm import ngram_join as nj
from tests.llm.conftest import tuples


def shingle_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k=3, percent=90):
    sets = [shingle_set(t, k) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for x, y in itertools.combinations([i for i, r in enumerate(rows) if r[0] is not None and sets[i]], 2):
        both = len(sets[x] & sets[y])
        if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
            top[max(find(x), find(y))] = min(find(x), find(y))
    least = {}
    for x, (i, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return sorted(((i, len(sets[x]), None if i is None else least[find(x)]) for x, (i, _) in enumerate(rows)), key=repr)


def edited(rng, base, words, edits):
    out = list(base)
    for _ in range(edits):
        at, kind = rng.randrange(len(out)), rng.random()
        if kind < 0.5:
            out[at] = rng.choice(words)
        elif kind < 0.75:
            out.insert(at, rng.choice(words))
        elif len(out) > 1:
            del out[at]
    return " ".join(out)


def family(seed, lengths, copies, edits=(0, 0, 1, 1, 2, 3, 6)):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    rows = []
    for n in lengths:
        base = rng.choices(words, k=n)
        rows += [edited(rng, base, words, rng.choice(edits)) for _ in range(rng.randint(1, copies))]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80)])
def test_components_against_all_pairs(docs, k, percent):
    rows = family(k, (1, 2, 3, 5, 8, 12, 20, 40, 80, 160, 320, 321), 20)
    got = nj.jaccard_components(docs(rows), k, percent)
    assert tuples(got) == brute(rows, k, percent)


def test_one_large_group_in_chunks(docs, monkeypatch):
    """A chain of near copies, so that no one leader links them and the trees have to."""
    monkeypatch.setattr(nj, "CHUNK", 16)
    words = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join(words[3 * i : 3 * i + 100])) for i in range(90)] + [(100 + i, " ".join(words[i : i + 100])) for i in range(60)]
    assert tuples(nj.jaccard_components(docs(rows))) == brute(rows)


def test_odd_rows(docs):
    rows = [(4, None), (2, ""), (7, " \t\n"), (3, "a"), (1, "A "), (9, "x y"), (9, "x y"), (5, "x  Y"), (None, "x y"), (None, None), (8, "É x"), (6, "é x"), (9, "other words in this one")]
    assert tuples(nj.jaccard_components(docs(rows))) == brute(rows)
    assert nj.jaccard_components(docs([])).count() == 0


def test_one_of_each(docs):
    rows = [(4, "a b c d e f"), (2, "a b c d e f"), (7, "z z z"), (7, "z z z"), (None, "a b c d e f"), (9, None), (3, "other text")]
    kept = nj.one_of_each(docs(rows))
    assert tuples(kept, "doc_id", "text") == sorted([(2, "a b c d e f"), (7, "z z z"), (None, "a b c d e f"), (9, None), (3, "other text")], key=repr)
    assert kept.columns == docs(rows).columns


@pytest.mark.parametrize("percent", [60, 90])
def test_tree_join_finds_every_pair_whose_bound_allows_it(percent):
    rng = np.random.default_rng(percent)
    centres = rng.poisson(2, (12, nj.COORDINATES))
    points = np.maximum(0, centres[rng.integers(0, 12, 300)] + rng.integers(-1, 2, (300, nj.COORDINATES)) * (rng.random((300, nj.COORDINATES)) < 0.1)).astype(np.uint32)
    sizes, labels = points.sum(1).astype(np.int64), rng.integers(0, 40, 300)
    x, y = nj.tree_join(points, sizes, labels, percent)
    got = {tuple(sorted(p)) for p in zip(x.tolist(), y.tolist(), strict=True)}
    expected = {
        (i, j) for i, j in itertools.combinations(range(300), 2)
        if labels[i] != labels[j] and (100 + percent) * int(np.minimum(points[i], points[j]).sum()) >= percent * (sizes[i] + sizes[j])
    }
    assert got == expected and len(x) == len(got)


def test_linked_sets_share_a_root():
    """The bound behind the roots: more sections than shingles in which linked sets can differ."""
    rng = random.Random(1)
    for _ in range(300):
        n, m = rng.randint(1, 400), rng.randint(1, 400)
        for percent in (70, 80, 90):
            overlap = -(-percent * (n + m) // (100 + percent))
            if overlap <= min(n, m):
                band = int(np.searchsorted(nj._BANDS, max(n, m), side="right")) - 1
                assert n + m - 2 * overlap < nj.n_sections(np.array(band), percent)
                low = int(np.searchsorted(nj._BANDS, min(n, m), side="right")) - 1
                assert low == band or (low == band - 1 and 100 * min(n, m) >= percent * nj._BANDS[band])


@pytest.mark.parametrize("seed", range(3))
def test_parities_never_differ_more_than_the_sets(seed):
    rng = np.random.default_rng(seed)
    for n, m in ((5, 5), (300, 280), (40, 1500), (3000, 2600)):
        pool = rng.integers(0, 2**63, n + m, dtype=np.uint64)
        a, b = np.unique(pool[:n]), np.unique(np.r_[pool[: min(n, m) * 4 // 5], pool[n : n + m - min(n, m) * 4 // 5]])
        true = len(np.setxor1d(a, b))
        both = nj.Parities([nj._parity(a), nj._parity(b)])
        zero, one = np.array([0]), np.array([1])
        assert both.differ(zero, one)[0] <= true and both.differ(zero, zero)[0] == 0
        assert max(n, m) > 1.2 * min(n, m) or both.differ(zero, one)[0] > 0.85 * true
        assert np.bitwise_count(both.sketches()[0] ^ both.sketches()[1]).sum() <= both.differ(zero, one)[0]


def copies(n, edits, length=1500, seed=2):
    """Copies of one text with as many of its words changed, each its own way."""
    rng = random.Random(seed)
    base = [f"b{rng.randrange(10_000)}" for _ in range(length)]
    rows = []
    for i in range(n):
        words = list(base)
        for at in rng.sample(range(length), edits):
            words[at] = f"e{i}x{at}"
        rows.append((i, " ".join(words)))
    return rows


@pytest.fixture
def counted(monkeypatch):
    """Numbers of candidate pairs, call by call."""
    made, plain = [], nj._verified

    def run(pairs, *more):
        made.append(pairs.count())
        return plain(pairs, *more)

    monkeypatch.setattr(nj, "_verified", run)
    return made


@pytest.mark.parametrize("n", [100, 400, 1600])
def test_documents_just_too_different_make_few_pairs(docs, counted, n):
    """About 0.6 alike and all below common roots: the parities tell them apart inside the tasks."""
    got = nj.jaccard_components(docs(copies(n, 80)), 5, 80)
    assert got.where("doc_id <> component_id").count() == 0
    assert sum(counted) <= 3 * n


def test_linked_documents_make_pairs_that_span(docs, counted, monkeypatch):
    """All pairs link, but the first pass is kept from seeing it."""
    monkeypatch.setattr(nj, "_first_links", lambda members, points, percent: members.select(nj.F.col("id").alias("a"), nj.F.col("id").alias("b")).limit(0))
    rows = copies(300, 5, length=400)
    got = nj.jaccard_components(docs(rows), 5, 80)
    assert {r.component_id for r in got.collect()} == {0}
    assert sum(counted) < 3 * 300


@pytest.mark.parametrize("rounds", [1, 2])
def test_rounds_make_no_difference(docs, monkeypatch, rounds):
    monkeypatch.setattr(nj, "ROUNDS", rounds)
    rows = family(31, (12, 40, 80, 160, 161), 25, edits=(0, 2, 4, 6, 8))
    assert tuples(nj.jaccard_components(docs(rows), 3, 80)) == brute(rows, 3, 80)
