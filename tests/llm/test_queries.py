from __future__ import annotations

import re
import zlib

import numpy as np
import pytest

import __spark_entry__ as entry
from tallywork.llm.queries import QUERIES
from tallywork.llm.statements import STATEMENTS
from tests.llm.conftest import FOLDER, tuples
from tests.llm.test_ngram_join import brute as all_pairs
from tests.llm.test_secret_scan import brute as base_secrets
from tests.llm.test_tokens import brute as token_files


def test_every_operation_is_registered_once():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(STATEMENTS) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_its_sql(llm, duck, name):
    got = QUERIES[name](llm, FOLDER)
    columns = sorted(got.columns)
    made = duck.execute(STATEMENTS[name])
    names = [c[0] for c in made.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert tuples(got, *columns) == sorted((tuple(r[i] for i in at) for r in made.fetchall()), key=repr)


@pytest.fixture(scope="module")
def documents(llm):
    return [(r.doc_id, r.text) for r in llm.read.parquet(f"{FOLDER}/documents.parquet").collect()]


def test_jaccard_query(llm, documents):
    assert tuples(QUERIES["op4_ngram_jaccard_join"](llm, FOLDER), "doc_id", "n_shingles", "component_id") == all_pairs(documents)


def test_secret_query(llm, documents):
    assert tuples(QUERIES["op8_secret_ledger"](llm, FOLDER), "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == base_secrets(documents)


def test_token_query(llm, documents):
    assert tuples(QUERIES["op10_token_codes"](llm, FOLDER), "doc_id", "start", "n_tokens", "ids_crc32") == token_files(documents)


def test_decontamination_query_finds_every_exact_copy(llm, documents):
    items = [(r.item_id, r.text) for r in llm.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    exact = {(d, i) for d, t in documents for i, x in items if x in t}
    got = {(r.doc_id, r.item_id): r.similarity for r in QUERIES["op1_benchmark_decontamination"](llm, FOLDER).collect()}
    assert exact and all(got.get(pair) == 1.0 for pair in exact)


def test_search_query(llm):
    rows = [(r.vec_id, np.array(r.embedding, dtype=np.float64)) for r in llm.read.parquet(f"{FOLDER}/embeddings.parquet").collect()]
    got = {}
    for r in QUERIES["op2_inverted_multi_index"](llm, FOLDER).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i, _ in rows if i % 100 == 0}
    hits = total = 0
    for q, found in got.items():
        v = dict(rows)[q]
        near = sorted((float(np.sqrt(((x - v) ** 2).sum())), i) for i, x in rows if i != q)[:10]
        hits += len({i for _, i in near} & {i for _, i, _ in found})
        total += len(near)
        assert all(s == pytest.approx(float(np.sqrt(((dict(rows)[i] - v) ** 2).sum())), rel=1e-12) for _, i, s in found)
    assert hits / total >= 0.9


def test_toxicity_query(llm, documents):
    got = {r.doc_id: r for r in QUERIES["op9_toxicity"](llm, FOLDER).collect()}
    assert set(got) == {d for d, _ in documents}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1) and r.predicted == (r.score >= 0.7) for d, r in got.items())


def test_language_model_query_finds_the_labelled_half_it_has_not_seen(llm, tmp_path):
    """Documents of quality 1 that are left out of the target score below the rest, and nearly as those in it."""
    folder = FOLDER.replace("0.001", "0.01")
    labels = llm.read.parquet(f"{folder}/labels.parquet")
    llm.read.parquet(f"{folder}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    labels.where("doc_id % 2 = 0").write.parquet(f"{tmp_path}/labels.parquet")
    scores = {r.doc_id: r.score for r in QUERIES["op3_cross_entropy_difference"](llm, str(tmp_path)).collect()}
    kinds = {r.doc_id: r.quality for r in labels.collect()}
    mean = lambda wanted: float(np.mean([x for d, x in scores.items() if wanted(kinds.get(d), d % 2)]))
    inside, left_out, bad = mean(lambda q, odd: q == 1 and not odd), mean(lambda q, odd: q == 1 and odd), mean(lambda q, odd: q == 0)
    assert left_out < bad - 0.04 and abs(left_out - inside) < 0.06
