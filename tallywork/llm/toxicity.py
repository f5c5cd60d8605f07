"""Toxicity scores from a counterfactually regularised classifier.

A logistic model over the words of a text is fitted to labelled documents.  Every labelled document that names a group is
scored a second time with its identity terms swapped for others of the same kind, and the squared change of the score's logit
is penalised.  So the model cannot buy accuracy with a group's name: a neutral mention moves the score as little as any
other group's would.

Words are bytes between ASCII punctuation and white space, lower-cased.  Words and the runs of ``GRAM`` bytes in them are
hashed into ``2 ** BITS`` buckets; a feature is the presence of a bucket.  Runs inside identity terms are none, so that a term
has one feature, which the swap exchanges.  Only texts are inputs of a score.  The model is fitted on the driver on at most ``SAMPLE`` labelled
rows of either class; every document is scored, whole, on the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tallywork.llm import text as tx
from tallywork.llm.shared import fresh, written

BITS = 22
GRAM = 4
#: Labelled rows of each class the model is fitted on, those of the smallest hashed ids.
SAMPLE = 4_000
#: Features the model keeps at most, those whose presence tells most about the label.  A feature is in so many rows at least,
#: and its log-likelihood ratio against the label is one that chance gives to one word in 10,000.
FEATURES, MIN_ROWS, EVIDENCE = 5_000, 4, 15.0

#: Terms swapped for each other, by kind.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("she", "he"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "indigenous"),
    ("gay", "lesbian", "bisexual", "transgender", "straight"),
    ("immigrant", "refugee", "native", "foreigner"), ("immigrants", "refugees", "natives", "foreigners"),
    ("disabled", "blind", "deaf", "autistic"), ("elderly", "young"), ("old", "teenage"),
)


def _term_hashes(terms: tuple[tuple[str, ...], ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms, ascending, and of each one's successor within its kind."""
    pairs = [(t, kind[(i + 1) % len(kind)]) for kind in terms for i, t in enumerate(kind)]
    hashed = []
    for column in zip(*pairs, strict=True) if pairs else ((), ()):
        raw = [t.encode() for t in column]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        hashed.append(tx.hash_words(np.frombuffer(b"".join(raw), np.uint8), np.r_[0, ends[:-1]] if raw else ends, ends))
    order = np.argsort(hashed[0])
    return hashed[0][order], hashed[1][order]


class _Batch:
    """Features of a slice of rows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, terms: np.ndarray, successors: np.ndarray):
        self.n, self.data, self.offsets = len(offsets) - 1, tx.fold_latin(data), offsets
        self.rows, self.start, self.end = tx.words(self.data, offsets, tx.PUNCTUATION)
        self.hashes = tx.hash_words(self.data, self.start, self.end)
        self.swapped, self.named = self.hashes, np.zeros(len(self.hashes), dtype=bool)
        if len(terms):
            at = np.minimum(np.searchsorted(terms, self.hashes), len(terms) - 1)
            self.named = terms[at] == self.hashes
            self.swapped = np.where(self.named, successors[at], self.hashes)

    def grams(self, keep: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """``(row, bucket)`` of every run of ``GRAM`` bytes of a word that is no identity term."""
        first = np.zeros(len(self.data) + 1, dtype=bool)
        first[self.start] = True
        inside = ~tx.PUNCTUATION[self.data]
        for low, high in zip(self.start[self.named].tolist(), self.end[self.named].tolist(), strict=True):
            inside[low:high] = False
        n = max(0, len(self.data) - GRAM + 1)
        good, value = inside[:n].copy(), self.data[:n].astype(np.uint32)
        for j in range(1, GRAM):
            good &= inside[j : j + n] & ~first[j : j + n]
            value |= self.data[j : j + n].astype(np.uint32) << np.uint32(8 * j)
        bucket = ((value * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)).astype(np.int64)
        at = np.flatnonzero(good if keep is None else good & keep[bucket])
        return np.searchsorted(self.offsets, at, side="right") - 1, bucket[at]

    def buckets(self, keep: np.ndarray | None = None, swap: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Distinct ``(row, bucket)`` in order, only those ``keep`` marks; with identity terms swapped if asked."""
        word = ((self.swapped if swap else self.hashes) >> np.uint64(64 - BITS)).astype(np.int64)
        rows = self.rows
        if keep is not None:
            use = keep[word]
            rows, word = rows[use], word[use]
        gram_rows, gram = self.grams(keep)
        both = np.unique((np.r_[rows, gram_rows] << BITS) + np.r_[word, gram])
        return both >> BITS, both & (2**BITS - 1)


# ---- fitting ------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """``logit = bias + sum of the weights of the buckets present``."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS

    def dense(self) -> np.ndarray:
        out = np.zeros(2**BITS)
        out[self.buckets] = self.weights
        return out


def _feature_counts(terms: tuple[tuple[str, ...], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 2**BITS), dtype=np.int64)
        known = _term_hashes(terms)
        for batch in batches:
            label = batch.column(0).to_numpy()
            for low, high, data, offsets in tx.slices(batch.column(1)):
                row, bucket = _Batch(data, offsets, *known).buckets()
                for y in (0, 1):
                    counts[y] += np.bincount(bucket[label[low:high][row] == y], minlength=2**BITS)
        seen = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[0][seen]), pa.array(counts[1][seen])], ["bucket", "clean", "toxic"])

    return run


def _example_rows(chosen: np.ndarray, terms: tuple[tuple[str, ...], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = np.zeros(2**BITS, dtype=bool)
        keep[chosen] = True
        known = _term_hashes(terms)
        for batch in batches:
            for low, high, data, offsets in tx.slices(batch.column(1)):
                some = _Batch(data, offsets, *known)
                has = np.zeros(some.n, dtype=bool)
                has[some.rows[some.named]] = True
                lists = []
                for swap in (False, True):
                    r, b = some.buckets(keep, swap)
                    if swap:  # rows without identity terms have no second version
                        r, b = r[has[r]], b[has[r]]
                    at, raw = np.searchsorted(r, np.arange(some.n + 1)), b.astype("<i4").tobytes()
                    lists.append(pa.array([raw[4 * i : 4 * j] for i, j in zip(at[:-1], at[1:], strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *lists, pa.array(has)], ["label", "words", "swapped", "named"])

    return run


def _fit(examples: list, chosen: np.ndarray, prior: tuple[int, int], pairing: float, ridge: float, rounds: int) -> Model:
    """Gradient descent with adapted steps on the log loss weighted to the prior, ``ridge`` and the pairing penalty."""
    label = np.array([e.label for e in examples], dtype=float)
    weight = np.where(label == 1, prior[1] / max(1, label.sum()), prior[0] / max(1, (1 - label).sum()))
    weight /= weight.sum()
    rank = np.full(2**BITS, -1, dtype=np.int32)
    rank[chosen] = np.arange(len(chosen))
    flat = lambda lists: rank[np.frombuffer(b"".join(lists), "<i4")]
    owner = lambda lists: np.repeat(np.arange(len(lists), dtype=np.int32), [len(x) // 4 for x in lists])
    words = [e.words for e in examples]
    col, row, n = flat(words), owner(words), len(examples)
    named = [e for e in examples if e.named]
    dcol = np.r_[flat([e.words for e in named]), flat([e.swapped for e in named])]
    drow = np.r_[owner([e.words for e in named]), owner([e.swapped for e in named])]
    sign = np.r_[np.ones(sum(len(e.words) // 4 for e in named)), -np.ones(sum(len(e.swapped) // 4 for e in named))]
    d = len(chosen)
    bias = float(np.log((prior[1] + 1) / (prior[0] + 1)))
    moment, second = np.zeros(d + 1), np.zeros(d + 1)
    theta = np.r_[np.zeros(d), bias]
    for t in range(1, rounds + 1):
        logit = theta[-1] + np.bincount(row, theta[:-1][col], n)
        error = weight * (1 / (1 + np.exp(-np.clip(logit, -60, 60))) - label)
        grad = np.r_[np.bincount(col, error[row], d) + ridge * theta[:-1], error.sum()]
        if len(named):
            change = np.bincount(drow, sign * theta[:-1][dcol], len(named))
            grad[:-1] += 2 * pairing / len(named) * np.bincount(dcol, sign * change[drow], d)
        moment, second = 0.9 * moment + 0.1 * grad, 0.99 * second + 0.01 * grad**2
        rate = 0.1 * (1 - t / (rounds + 1))
        theta = theta - rate * (moment / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.99**t)) + 1e-8)
    return Model(float(theta[-1]), chosen, theta[:-1])


def fit(labelled: DataFrame, prior: tuple[int, int] | None = None, pairing: float = 1.0, ridge: float = 1e-5, rounds: int = 300, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> Model:
    """The model of a bounded table of ``text, label`` rows, label 0 or 1, weighted to the ``prior`` counts of either label.

    Without rows of both labels the score is the smoothed share of label 1.
    """
    held = written(labelled.select(F.col("label").cast("int").alias("label"), F.coalesce("text", F.lit("")).alias("text")), "examples")
    found = {r.label: r["count"] for r in held.groupBy("label").count().collect()}
    prior = prior or (found.get(0, 0), found.get(1, 0))
    if not (found.get(0) and found.get(1)):
        return Model(float(np.log((prior[1] + 1) / (prior[0] + 1))), np.zeros(0, np.int64), np.zeros(0), terms)
    used = held.groupBy().agg(F.sum(1 - F.col("label")).alias("c"), F.sum("label").alias("t")).first()
    counts = held.mapInArrow(_feature_counts(terms), "bucket long, clean long, toxic long").groupBy("bucket").agg(F.sum("clean").alias("c"), F.sum("toxic").alias("t"))
    # Log-likelihood ratio of presence against label: twice the sum of observed * log(observed / expected).
    present, rows = F.col("c") + F.col("t"), used.c + used.t
    part = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    ratio = sum((part(F.col(x), present * n / rows) + part(n - F.col(x), (rows - present) * n / rows) for x, n in (("c", used.c), ("t", used.t))), F.lit(0.0)) * 2
    best = counts.where(present >= MIN_ROWS).withColumn("ratio", ratio).where(F.col("ratio") >= EVIDENCE).orderBy(F.desc("ratio"), "bucket").limit(FEATURES).select("bucket").collect()
    named = (_term_hashes(terms)[0] >> np.uint64(64 - BITS)).astype(np.int64)
    chosen = np.unique(np.r_[np.array([r.bucket for r in best], dtype=np.int64), named])
    examples = held.mapInArrow(_example_rows(chosen, terms), "label int, words binary, swapped binary, named boolean").collect()
    examples.sort(key=lambda e: (e.label, bytes(e.words)))
    return replace(_fit(examples, chosen, prior, pairing, ridge, rounds), terms=terms)


# ---- scoring ------------------------------------------------------------------------

def _scorer(model: Model, text: int, keep: list[int], names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.dense()
        marked = np.zeros(2**BITS, dtype=bool)
        marked[model.buckets] = True
        known = _term_hashes(model.terms)
        for batch in batches:
            out = np.empty(batch.num_rows)
            for low, high, data, offsets in tx.slices(pc.fill_null(batch.column(text), "")):
                row, bucket = _Batch(data, offsets, *known).buckets(marked)
                logit = model.bias + np.bincount(row, weights[bucket], high - low)
                out[low:high] = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in keep), pa.array(out)], names)

    return run


def score(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """Every row's columns, or those of ``keep``, and its score as column ``name``, which must be new.

    A NULL text scores as an empty one, by the bias alone.
    """
    keep = docs.columns if keep is None else keep
    schema = StructType([*(docs.schema[c] for c in keep), StructField(name, DoubleType())])
    return docs.mapInArrow(_scorer(model, docs.columns.index(text), [docs.columns.index(c) for c in keep], schema.names), schema)


def held_out(id: str = "doc_id") -> Column:
    """Whether a row is kept from fitting: CRC-32 of its id as text leaves 1 modulo 3; a row without id is not."""
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_to_labels(docs: DataFrame, labels: DataFrame, label: str = "toxic", id: str = "doc_id", text: str = "text", sample: int = SAMPLE, **options) -> Model:
    """Fit to the documents that ``labels`` marks 0 or 1, held-out ones left aside.

    Labels that are NULL or neither are ignored; an id that is labelled twice counts as 1 if any label is.  At most ``sample``
    ids of a label are looked up, so only those are joined.  Of documents that repeat an id, the one with the smallest hashed
    text is fitted to, so an id of any number of rows is one example.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(id).isNotNull() & ~held_out(id)).groupBy(F.col(id).cast("long").alias("id")).agg(F.max(label).cast("int").alias("label"))
    counts = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    some = [known.where(F.col("label") == y).orderBy(F.xxhash64("id"), "id").limit(sample) for y in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]))  # 16 bytes for each of 2 * sample rows at most
    rows = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text")).join(chosen, "id")
    # A partial aggregation: no task and no collect sees more than an id's one row.
    rows = rows.groupBy("id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first")).select("first.text", "label")
    return fit(rows, (counts.get(0, 0), counts.get(1, 0)), **options)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; predicted is 1 from ``threshold`` up.

    Only the text is an input of the score.  Repeated rows come back as often; other columns take no part.
    """
    model = fit_to_labels(docs, labels, id=id, text=text, **options)
    rows = docs.select(F.col(id).alias("doc_id"), held_out(id).alias("held_out"), F.col(text).alias("text"))
    return score(rows, model, keep=["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that score below ``threshold``, all columns."""
    model = fit_to_labels(docs, labels, id=id, text=text, **options)
    name = fresh(docs, "_toxicity")
    return score(docs, model, text, name=name).where(F.col(name) < threshold).drop(name)
