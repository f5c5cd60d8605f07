"""Cross-entropy difference between word models of a target and of the background.

Both models give a symbol the mean of two losses, that of the word alone and that of the word after its predecessor:

    loss(w | c) = -1/2 [ln (x(w) + A) / (X + A V)  +  ln (x(c w) + A) / (x(c) + A V)]

with the same ``A`` and one vocabulary of ``V`` words, those that occur twice or more in all documents; all other words are one more.
The target model counts the documents a label marks; the background model counts all documents, with its counts scaled to the
target's number of symbols, so that ``A`` weighs the same in both.  What a document itself adds is taken off both models when it is
scored, so a document of the target finds its own words no more familiar than another one does: the score tells likeness, not
membership.  It is the mean over the symbols of target loss less background loss, in nats: the lower, the more like the target.
Symbols are the words and one mark, which ends every text and precedes its first word.

Words and pairs grow with the corpus and are counted in one table, keyed by 64-bit hashes.  A key that no other document has adds the
same to both models but for its context, so documents send on only keys that occur twice; a map of 16 MB tells most others apart.  The
``HEAD`` most frequent keys, which most symbols belong to, are held by every task, whatever the corpus; the documents' other
keys are joined to the table.  So no key that fills a third of all rows is ever exchanged.  Losses are summed in units of
``1 / SCALE``, so the order of rows makes no difference.

Words are runs of ASCII letters, digits and other non-ASCII bytes, lower-cased in A-Z and in the Latin-1 letters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm import text as tx
from tallywork.llm.shared import bit_map, bits_of, remove, written

#: What stands before and after the words of a text.
MARK = np.uint64(0xA7C4D1E89B360F52)
#: What every count is raised by.
A = 0.5
#: Keys that every task holds, 24 MB, and bits of the map of all that occur twice, 16 MB.
HEAD = 1 << 20
MAP_BITS = 27
#: Ids of the target that go to the texts, 4 MB; with more of them the texts move to the ids.
FEW_IDS = 1 << 19
SCALE = 1 << 32
#: The key of the number of all symbols.
_ALL = 0
_FOLD = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(1)


def _keys(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)`` of every word, with the mark, and of every pair of each row; keys of words are odd, those of pairs even."""
    n = len(offsets) - 1
    data = tx.fold_latin(data)
    rows, start, end = tx.words(data, offsets, tx.PUNCTUATION)
    word = np.full(len(rows) + n, MARK)
    word[np.arange(len(rows)) + rows] = tx.hash_words(data, start, end)
    row = np.repeat(np.arange(n), np.bincount(rows, minlength=n) + 1)
    context = np.r_[MARK, word[:-1]]
    context[1:][row[1:] != row[:-1]] = MARK
    return np.r_[row, row], np.r_[word | _ODD, tx.mix(context * _FOLD + tx.mix(word)) & ~_ODD]


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of the keys in all rows and in marked rows."""
    for batch in batches:
        marked = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        for low, high, data, offsets in tx.slices(batch.column(0)):
            row, key = _keys(data, offsets)
            found, which, n = np.unique(key, return_inverse=True, return_counts=True)
            weight = marked[low:high][row]
            m = np.bincount(which, weight, len(found)).astype(np.int64)
            total = np.array([len(row) // 2]), np.array([int(weight.sum()) // 2])
            yield pa.RecordBatch.from_arrays([_long(np.r_[found, np.uint64(_ALL)]), pa.array(np.r_[n, total[0]]), pa.array(np.r_[m, total[1]])], ["key", "n", "m"])


class Model:
    """What the tasks know of both models: scale, vocabulary and the most frequent keys."""

    def __init__(self, share: float, size: int, head: tuple[np.ndarray, np.ndarray, np.ndarray], known: np.ndarray) -> None:
        self.share, self.size, self.known = share, size, known
        order = np.argsort(head[0])
        self.keys, self.n, self.m = (h[order] for h in head)


def _units(x: np.ndarray) -> np.ndarray:
    return np.rint(x * SCALE).astype(np.int64)


def _gain(x: np.ndarray, odd: np.ndarray, size: int) -> np.ndarray:
    """What a symbol's log likelihoods gain by ``x`` other occurrences of its key: of a word also as what others follow."""
    return np.log((x + A) / A) - np.where(odd, np.log((x + A * size) / (A * size)), 0.0)


def _scored(model: Model):
    """For each row its symbols with the gains of frequent keys, under a key of its own, and its other keys that the map has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            for low, high, data, offsets in tx.slices(batch.column(1)):
                rows = high - low
                row, key = _keys(data, offsets)
                _, first, c = np.unique(key ^ tx.mix(row.astype(np.uint64) + np.uint64(1)), return_index=True, return_counts=True)
                order = np.argsort(row[first], kind="stable")  # rows of a document stay together, which makes their exchange small
                first, c = first[order], c[order]
                row, key = row[first], key[first]
                at = np.minimum(np.searchsorted(model.keys, key), max(0, len(model.keys) - 1))
                frequent = model.keys[at] == key if len(model.keys) else np.zeros(len(key), dtype=bool)
                odd = (key & _ODD) == 1
                own = marked[low:high][row] * c  # what the target model has of this row
                sums = np.zeros((2, rows), dtype=np.int64)
                for total, n in zip(sums, (model.m[at] - own, model.share * (model.n[at] - c)) if len(model.keys) else (), strict=False):
                    np.add.at(total, row[frequent], _units(c[frequent] * _gain(n[frequent], odd[frequent], model.size)))
                symbols = np.bincount(row[odd], c[odd], rows).astype(np.int64)
                doc = batch.column(0).slice(low, rows)
                none = pa.array(np.zeros(rows, dtype=np.int64))
                yield pa.RecordBatch.from_arrays([doc, doc, pa.array(symbols), none, *map(pa.array, sums)], _ROW)
                rest = ~frequent & bits_of(model.known, key)
                none = pa.array(np.zeros(int(rest.sum()), dtype=np.int64))
                yield pa.RecordBatch.from_arrays([doc.take(pa.array(row[rest])), _long(key[rest]), pa.array(c[rest]), pa.array(own[rest]), none, none], _ROW)

    return run


_ROW = ["doc", "key", "c", "own", "target", "background"]


def _model(counts: DataFrame) -> tuple[Model, int, int]:
    """The model, and the symbols of all rows and of marked rows."""
    total = counts.where(F.col("key") == _ALL).first()
    n, m = (total.n, total.m) if total else (0, 0)
    rows = counts.where(F.col("key") != _ALL)
    level = F.floor(F.log2("n") * 8)
    sizes = sorted(((r.level, r["count"], r.words) for r in rows.groupBy(level.alias("level")).agg(F.count("*").alias("count"), F.count_if(F.col("key") % 2 != 0).alias("words")).collect()), reverse=True)
    least, held = None, 0
    for at, count, _ in sizes:
        held += count
        if held > HEAD:
            break
        least = at
    head = rows.where(level >= least if least is not None else F.lit(False)).select("key", "n", "m").toArrow()
    columns = head.column("key").to_numpy().view(np.uint64), head.column("n").to_numpy(), head.column("m").to_numpy()
    return Model(m / n if n else 0.0, sum(words for _, _, words in sizes) + 1, columns, bit_map(rows, "key", MAP_BITS)), n, m


def word_cross_entropy_difference(docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_symbols, target_loss, background_loss, score`` of every document, losses in nats to nine decimals.

    ``target`` names the target's documents by ``id``; others, NULL and repeated ids in it make no difference.  With an empty target
    both models are uniform and every score is 0.  A NULL text is an empty one and has the mark alone.  Rows that repeat an id are
    each counted and scored by their own text; a row without id is of no target.  An empty table gives no rows; other columns take no
    part.  Rows are told apart by a 64-bit hash of id and text, keys by 63 bits.
    """
    texts = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("doc", F.xxhash64("doc_id", "t"))
    wanted = written(target.select(F.col(id).cast("long").alias("doc_id")).where("doc_id IS NOT NULL").distinct().withColumn("marked", F.lit(True)), "target")
    wanted = F.broadcast(wanted) if wanted.count() <= FEW_IDS else wanted.hint("merge")
    texts = texts.join(wanted, "doc_id", "left").withColumn("marked", F.coalesce("marked", F.lit(False)))
    counts = texts.select("t", "marked").mapInArrow(_counted, "key long, n long, m long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    counts = written(counts.where((F.col("n") > 1) | (F.col("key") == _ALL)), "counts")
    model, all_n, all_m = _model(counts)

    made = texts.select("doc", "t", "marked").mapInArrow(_scored(model), ", ".join(f"{c} long" for c in _ROW))
    # Every key is in one row of the counts, so the side that is hashed has no hot key.
    made = made.join(counts.hint("shuffle_hash"), "key", "left")
    summary = F.col("key") == F.col("doc")
    odd = F.col("key") % 2 != 0
    size = F.lit(A * model.size)
    gain = lambda x: F.log((x + A) / A) - F.when(odd, F.log((x + size) / size)).otherwise(0.0)
    gained = lambda x: F.when(~summary & F.col("n").isNotNull(), F.round(F.col("c") * gain(x) * SCALE).cast("long")).otherwise(0)
    sums = made.groupBy("doc").agg(
        F.sum(F.when(summary, F.col("c")).otherwise(0)).alias("c"), F.count_if(summary).alias("rows"),
        F.sum(F.col("target") + gained(F.col("m") - F.col("own"))).alias("target"), F.sum(F.col("background") + gained(F.lit(model.share) * (F.col("n") - F.col("c")))).alias("background"),
    )
    # Rows that repeat id and text were summed together.
    each = lambda name: (F.col(name) / F.col("rows")).alias(name)
    sums = written(sums.select("doc", F.expr("c div rows").alias("c"), each("target"), each("background")), "sums")
    remove(counts)

    rows = texts.select("doc_id", "doc", "marked").join(sums, "doc")
    base = np.log(A) - np.log(A * model.size) + np.log(A)

    def loss(gained: Column, others: Column) -> Column:
        return (F.log(others + size) - base - gained / (F.col("c") * F.lit(float(SCALE)))) / 2

    target_loss = loss(F.col("target"), F.lit(float(all_m)) - F.when(F.col("marked"), F.col("c")).otherwise(0))
    background_loss = loss(F.col("background"), F.lit(model.share) * (F.lit(float(all_n)) - F.col("c")))
    out = rows.select("doc_id", F.col("c").alias("n_symbols"), target_loss.alias("t"), background_loss.alias("b"))
    return out.select("doc_id", "n_symbols", F.round("t", 9).alias("target_loss"), F.round("b", 9).alias("background_loss"), F.round(F.col("t") - F.col("b"), 9).alias("score"))
