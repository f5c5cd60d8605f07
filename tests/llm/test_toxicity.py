from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywork.llm import toxicity as tox

WORDS = "river stone cloud paper garden window music letter bridge summer field coffee".split()


def corpus(n=400, seed=3):
    """Toxic texts hold an insult; texts that name one group are toxic more often, as in biased samples."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = rng.choices(WORDS, k=rng.randint(5, 30))
        bad = rng.random() < 0.3
        if bad:
            words.insert(rng.randrange(len(words)), rng.choice(["blorkface", "zilchbrain"]))
        if rng.random() < (0.8 if bad else 0.1):
            words.insert(0, "Muslim")
        elif rng.random() < 0.3:
            words.insert(0, "Christian")
        rows.append((i, " ".join(words), int(bad)))
    return rows


def fitted(llm, rows, **options):
    return tox.fit(llm.createDataFrame(rows, "id long, text string, label int"), **options)


def logits(llm, model, texts):
    df = llm.createDataFrame(list(enumerate(texts)), "i long, text string")
    return [math.log(r.score / (1 - r.score)) for r in tox.score(df, model).orderBy("i").collect()]


def test_swapping_identity_terms_changes_regularised_scores_less(llm):
    rows = corpus()
    texts = ["the muslim garden", "the christian garden", "the jewish garden"]
    plain = logits(llm, fitted(llm, rows, pairing=0.0), texts)
    paired = logits(llm, fitted(llm, rows, pairing=10.0), texts)
    assert max(plain) - min(plain) > 1
    assert max(paired) - min(paired) < 0.3 * (max(plain) - min(plain))
    assert paired[0] < plain[0]  # a neutral mention of the over-represented group


def test_scores_follow_labels_on_held_out_documents(llm):
    rows = corpus(600)
    docs = llm.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = llm.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    got = tox.toxicity(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert 100 < len(held) < 300
    assert all((r.predicted == 1) == (r.score >= 0.7) and 0 <= r.score <= 1 for r in got)
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.97


def test_held_out_labels_and_other_columns_change_nothing(llm):
    rows = corpus(200)
    base = llm.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = llm.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    other = labels.withColumn("toxic", F.when(tox.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one = {r.doc_id: r.score for r in tox.toxicity(base, labels).collect()}
    two = {r.doc_id: r.score for r in tox.toxicity(base.withColumn("score", F.col("doc_id")).withColumn("label", F.lit("x")), other).collect()}
    assert one == two


def test_score_is_of_the_text_alone(llm):
    model = fitted(llm, corpus())
    texts = ["Blorkface river", "river blorkface", "x", ""]
    by_id = llm.createDataFrame([(k, t) for k in (1, 900) for t in texts], "doc_id long, text string")
    scores = {}
    for r in tox.score(by_id, model).collect():
        scores.setdefault(r.text, set()).add(r.score)
    assert all(len(s) == 1 for s in scores.values())
    assert scores["Blorkface river"] == scores["river blorkface"] and min(scores["Blorkface river"]) > 0.7 > min(scores["x"])


def test_marks_inside_words_are_learned(llm):
    rng = random.Random(1)
    rows = [(i, " ".join([*rng.choices(WORDS, k=10), f"xqzv{rng.choice('abcdefgh')}{rng.choice('ijklmn')}" if i % 3 == 0 else "plain"]), int(i % 3 == 0)) for i in range(300)]
    bad, good = logits(llm, fitted(llm, rows), ["river xqzvzz", "river plain"])
    assert bad > 1 > 0 > good


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, None), (2, 7)], [(1, 1), (1, 1)]])
def test_without_both_labels_every_text_scores_the_prior(llm, docs, labels):
    rows = [(1, "some text"), (2, None), (2, ""), (None, "no id")]
    got = tox.toxicity(docs(rows), llm.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(got) == 4 and len({r.score for r in got}) == 1 and not any(r.held_out for r in got if r.doc_id is None)


def test_empty_table_and_stage(llm, docs):
    labels = llm.createDataFrame([(i, y) for i, _, y in corpus(300)], "doc_id long, toxic int")
    assert tox.toxicity(docs([]), labels).count() == 0
    table = docs([(i, t) for i, t, _ in corpus(300)] + [(None, "blorkface zilchbrain"), (999, None), (999, "x"), (998, "river " * 60_000)])
    kept = tox.without_toxic(table, labels)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, y in corpus(300) if not y} | {998, 999}


def test_an_id_of_many_rows_is_one_example(llm, monkeypatch):
    rows = [r for r in corpus(120) if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    labels = llm.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    hot = rows[0][0]
    texts = [(i, t) for i, t, _ in rows] + [(hot, f"another text {k}") for k in range(300)]
    seen = []
    monkeypatch.setattr(tox, "fit", lambda some, prior, **_: seen.append((some.collect(), prior)))
    for order in (texts, texts[::-1]):
        tox.fit_to_labels(llm.createDataFrame(order, "doc_id long, text string").repartition(5), labels)
    (examples, prior), (again, _) = seen
    assert len(examples) == len(rows) == sum(prior)
    assert sorted((r.text, r.label) for r in examples) == sorted((r.text, r.label) for r in again)
    assert {(t, y) for i, t, y in rows if i != hot} <= {(r.text, r.label) for r in examples}


def test_fitted_weights_are_where_the_written_loss_is_least(llm):
    """The loss of the module's description, written out for a tiny corpus: its slope at the fitted weights is nearly none."""
    rows = [("good women sing", 0), ("good men sing", 0), ("bad women shout", 1), ("bad men shout", 1), ("good song", 0), ("bad noise", 1), ("women shout", 0), ("men noise", 1)] * 6
    model = tox.fit(llm.createDataFrame(rows, "text string, label int"), pairing=0.7, ridge=0.02, rounds=3_000)
    assert len(model.buckets) > 4
    known = tox._term_hashes(tox.IDENTITY_TERMS)
    keep = np.zeros(2**tox.BITS, dtype=bool)
    keep[model.buckets] = True

    def present(swap):
        raw = [t.encode() for t, _ in rows]
        some = tox._Batch(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, np.cumsum([len(r) for r in raw])], *known)
        row, bucket = some.buckets(keep, swap)
        x = np.zeros((len(rows), len(model.buckets)))
        x[row, np.searchsorted(model.buckets, bucket)] = 1
        return x, np.isin(np.arange(len(rows)), some.rows[some.named])

    (x, named), (swapped, _) = present(False), present(True)
    y = np.array([label for _, label in rows], dtype=float)

    def loss(theta):
        logit = x @ theta[:-1] + theta[-1]
        change = (x[named] - swapped[named]) @ theta[:-1]
        return float(np.mean(np.logaddexp(0, logit) - y * logit) + 0.02 / 2 * (theta[:-1] ** 2).sum() + 0.7 * np.mean(change**2))

    at = np.r_[model.weights, model.bias]
    step = 1e-5
    slope = np.array([(loss(at + step * e) - loss(at - step * e)) / (2 * step) for e in np.eye(len(at))])
    assert np.abs(slope).max() < 2e-3 and loss(at) < loss(np.zeros(len(at)))
    assert all(loss(at + 0.05 * np.random.default_rng(k).normal(size=len(at))) > loss(at) for k in range(20))
