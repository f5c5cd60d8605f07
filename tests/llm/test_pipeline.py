from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as cp
from tallywork.llm import decontaminate, mixing, ngram_join
from tallywork.llm.shared import written
from tests.llm.conftest import FOLDER, tuples
from tests.llm.test_ngram_join import brute as all_pairs


@pytest.fixture(scope="module")
def stages(llm):
    """What every stage was given and returned."""
    docs, out = llm.read.parquet(f"{FOLDER}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        made = written(stage(llm, docs, FOLDER), "stage")
        out[name], docs = (docs, made), made
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["toxicity", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights", "token-ID / binary output"]
    first = stages["toxicity"][0]
    assert all(made.columns == first.columns for _, made in list(stages.values())[:-1])


def test_toxicity_keeps_unmarked_documents(stages, llm):
    docs, kept = stages["toxicity"]
    labels = llm.read.parquet(f"{FOLDER}/labels.parquet")
    gone = docs.join(kept.select("doc_id"), "doc_id", "left_anti").join(labels, "doc_id")
    assert gone.where("toxic = 0").count() == 0
    assert kept.join(docs, docs.columns, "left_semi").count() == kept.count()


def test_one_document_of_each_group_stays(stages):
    docs, kept = stages["n-gram Jaccard join"]
    expected = {c for _, _, c in all_pairs([(r.doc_id, r.text) for r in docs.collect()], 5, 80)}
    assert {r.doc_id for r in kept.collect()} == expected and kept.count() == len(expected)


def test_documents_with_benchmark_text_go(stages, llm):
    docs, kept = stages["benchmark decontamination"]
    items = [r.text for r in llm.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()}
    exact = {r.doc_id for r in docs.collect() if any(i in r.text for i in items)}
    assert exact <= gone
    found = {r.doc_id for r in decontaminate.contamination(docs, llm.read.parquet(f"{FOLDER}/benchmark.parquet"), n=4, similarity=0.6).collect()}
    assert gone == found


def test_mixing_repeats_small_sources_and_drops_nothing(stages):
    docs, made = stages["mixing sources to target weights"]
    assert {r.doc_id for r in made.collect()} == {r.doc_id for r in docs.collect()}
    read = {r.source: r["sum(n_chars)"] for r in made.groupBy("source").sum("n_chars").collect()}
    had = {r.source: r["sum(n_chars)"] for r in docs.groupBy("source").sum("n_chars").collect()}
    assert max(read[s] / had[s] for s in had) <= 2.0 and made.count() >= docs.count()
    assert made.count() == mixing.mixed(docs, repetition=2.0).count()


def test_token_files_hold_the_mixed_documents(stages):
    docs, made = stages["token-ID / binary output"]
    tokenizer, at, expected = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
        expected.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert tuples(made, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)


def test_run_gives_the_stages_rows(stages, llm):
    made = stages["token-ID / binary output"][1]
    assert tuples(cp.run(llm, FOLDER), "doc_id", "start", "n_tokens", "ids_crc32") == tuples(made, "doc_id", "start", "n_tokens", "ids_crc32")


def test_one_of_each_is_the_join_at_the_stage_threshold(stages):
    docs, kept = stages["n-gram Jaccard join"]
    again = ngram_join.jaccard_components(kept, 5, 80)
    assert again.where("doc_id <> component_id").count() == 0
