from __future__ import annotations

import math
from collections import Counter

import pytest

from tallywork.llm import mixing as mx
from tests.llm.conftest import tuples


def table(docs, sizes, each=None):
    rows = []
    for source, n in sizes.items():
        rows += [(len(rows) + i, "w " * (1 + (each or (lambda k: k % 5))(i)), "en", source) for i in range(n)]
    return docs(rows)


def sources_of(df):
    return mx.source_sizes(mx.sized(df))


def test_exponent_meets_the_entropy(docs):
    sources = sources_of(table(docs, {"a": 900, "b": 90, "c": 10}))
    target = 0.8 * math.log(3)
    x = mx.find_exponent(sources, entropy=target)
    p = [r.tokens ** x for r in sources.collect()]
    entropy = -sum(v / sum(p) * math.log(v / sum(p)) for v in p)
    assert 0 < x < 1 and entropy == pytest.approx(target, abs=1e-9)
    assert mx.find_exponent(sources, entropy=0.01) == 1.0 and mx.find_exponent(sources, entropy=2.0) == 0.0


def test_exponent_meets_the_repetition_limit(docs):
    sources = sources_of(table(docs, {"a": 900, "b": 90, "c": 10}))
    most, least = (f(r.tokens for r in sources.collect()) for f in (max, min))
    assert mx.find_exponent(sources, repetition=3.0) == pytest.approx(1 - math.log(3) / math.log(most / least), abs=1e-12)
    assert mx.find_exponent(sources, repetition=1000.0) == 0.0 and mx.find_exponent(sources, repetition=1.0) == 1.0
    with pytest.raises(ValueError):
        mx.find_exponent(sources)


def test_every_document_is_read_and_small_sources_again(docs, monkeypatch):
    monkeypatch.setattr(mx, "RANGE_DOCS", 16)
    df = table(docs, {"a": 400, "b": 40, None: 30})
    got = mx.mixed(df, repetition=2.0, block_tokens=200).collect()
    times = Counter(r.doc_id for r in got)
    assert set(times) == set(range(470)) and set(times.values()) <= {1, 2}
    assert all(times[i] == 1 for i in range(400)) and all(times[i] == 2 for i in range(440, 470))
    places = {}
    for r in got:
        places.setdefault(r.block, []).append(r.place)
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in places.values())
    assert sorted(places) == list(range(len(places)))


def test_budget_is_met_to_a_document_and_blocks_have_the_weights(docs, monkeypatch):
    monkeypatch.setattr(mx, "RANGE_DOCS", 16)
    sizes = mx.sized(table(docs, {"a": 3000, "b": 500}))
    plan = mx.budgets(mx.source_sizes(sizes), 0.5, 6000)
    rows = mx.permuted(sizes, plan, block_tokens=600).collect()
    for p in plan.collect():
        own = sorted((r.start, r.tokens, r.block) for r in rows if r.source == p.source)
        assert [s for s, _, _ in own] == [sum(t for _, t, _ in own[:i]) for i in range(len(own))]  # no gap, no overlap
        assert 0 <= sum(t for _, t, _ in own) - p.budget < 5
        per_block = Counter()
        for _, t, b in own:
            per_block[b] += t
        assert len(per_block) == 10 and all(abs(n - p.budget / 10) <= 8 for n in per_block.values())


def test_ranges_do_not_change_the_stream(docs, monkeypatch):
    df = table(docs, {"a": 300, "b": 20})
    whole = tuples(mx.mixed(df, repetition=2.0))
    monkeypatch.setattr(mx, "RANGE_DOCS", 8)
    assert tuples(mx.mixed(df, repetition=2.0)) == whole


def test_remixed_reads_what_the_stream_reads(docs):
    df = docs([(i, "w " * (i % 7), "en", "ab"[i % 10 == 0]) for i in range(300)] + [(900, None, None, None), (901, "", "en", "empty only"), (None, "no id here", "en", "a"), (902, "x " * 50_000, "en", "b")])
    out = mx.remixed(df, repetition=2.0)
    assert out.columns == df.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in mx.mixed(df, repetition=2.0).collect())


@pytest.mark.parametrize("copies", [40, 200])
def test_a_budget_ends_between_copies_of_one_row(docs, monkeypatch, copies):
    """Stream and stage read the same rows, also where the budget ends among equal ones."""
    monkeypatch.setattr(mx, "RANGE_DOCS", 16)
    df = docs([(7, "w " * 30, "en", "s")] * copies + [(None, f"v{i} " * 30, "en", "s") for i in range(20)] + [(9, "u " * 30, "en", "t")])
    stream = mx.mixed(df, repetition=1.0, budget_tokens=900).collect()
    stage = mx.remixed(df, repetition=1.0, budget_tokens=900).collect()
    count = lambda rows: Counter((r.doc_id, r.source) for r in rows)
    assert count(stream) == count(stage) and 25 <= sum(1 for r in stream if r.source == "s") <= 31


def test_rows_without_id_spread_over_ranges(docs, monkeypatch):
    monkeypatch.setattr(mx, "RANGE_DOCS", 16)
    sizes = mx.sized(docs([(None, f"text {i}", "en", "s") for i in range(300)] + [(3, f"other {i}", "en", "s") for i in range(300)]))
    plan = mx.budgets(mx.source_sizes(sizes), 1.0)
    assert max(r["count"] for r in mx._read(sizes, plan, "mix").groupBy("range").count().collect()) < 60


def test_repeated_rows_and_empty_tables(docs):
    df = docs([(1, "a b", "en", "s")] * 5 + [(2, "a b", "en", "t")])
    assert Counter(r.doc_id for r in mx.mixed(df, repetition=1.0).collect()) == {1: 5, 2: 1}
    assert Counter(r.doc_id for r in mx.remixed(df, repetition=1.0).collect()) == {1: 5, 2: 1}
    for empty in (docs([]), docs([(1, None, None, None)])):
        assert mx.mixed(empty, repetition=2.0).count() == empty.count() == mx.remixed(empty, repetition=2.0).count()
