"""Spelling variants through one-edit neighbourhoods over a reduced alphabet.

Letters are hashed to ``SYMBOLS`` symbols.  Two words that are one edit apart have reduced words that are equal or one edit apart,
so the full one-edit neighbourhood of a reduced word - itself, every replacement, deletion and insertion - meets the reduced words
of all its near words, and over few symbols it is short: some ``2 * SYMBOLS * length`` entries whatever the alphabet.  A
neighbourhood is never spelt out: a reduced word is a polynomial modulo 2**64, and each edit is a sum of its prefix, a term and its
shifted suffix, computed for a whole batch at once.

The neighbourhoods are joined to the reduced vocabulary by value.  A pair goes on if the parities of its letter counts differ in at
most two bits, as those of near words do, and is then verified on the words themselves.  So the join emits near pairs and few
others, and no bucket of the reduced vocabulary is ever paired within itself.

Vocabulary, neighbourhoods and pairs are tables.  The driver holds a map of 8 MB of the reduced words, which spares most entries
of the neighbourhoods the exchange; as a vocabulary fills the map more entries pass it, and the join decides as before.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm import text as tx
from tallywork.llm.components import roots
from tallywork.llm.shared import bit_map, bits_of, written

#: Symbols of the reduced alphabet.
SYMBOLS = 12
#: Distinct words that a task counts before it hands them on.
HELD = 200_000
#: Letters of a batch whose neighbourhoods are made at once.
PIECE = 1 << 18
RUNS = re.compile("[a-zA-ZÀ-ÿ]+")

_U = np.uint64
_BASE = 0xD1B54A32D192ED03
_INVERSE = _U(pow(_BASE, -1, 2**64))
_LENGTH = _U(0x9E3779B97F4A7C15)
_SYMBOL = (tx.mix(np.arange(1, 257, dtype=np.uint64)) % _U(SYMBOLS)) + _U(1)
_BIT = _U(1) << (np.arange(256, dtype=np.uint64) % _U(64))


def worn(run: str, prefix: int, one_in: int) -> str:
    """``run``, or one code point less where ``one_in`` divides the CRC that continues ``prefix`` over it."""
    h = zlib.crc32(run.encode(), prefix)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _counted(least: int, one_in: int | None):
    """Words of at least ``least`` code points and their occurrences in the rows of a task."""
    shortest = re.compile(f"[a-zA-ZÀ-ÿ]{{{max(1, least)},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for batch in batches:
            for i, name in enumerate(batch.column(0).to_pylist()):
                text = batch.column(1)[i].as_py()
                found = Counter(shortest.findall(text.encode().lower().decode()))
                if one_in is None:
                    held.update(found)
                else:
                    prefix = zlib.crc32(f"{'' if name is None else name}:".encode())
                    for word, n in found.items():
                        word = worn(word, prefix, one_in)
                        if len(word) >= least:
                            held[word] += n
                if len(held) > HELD:
                    yield flush()
        yield flush()

    return run


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a column of words, all below 256, and the bounds of the words."""
    words = [w.encode("latin-1") for w in column.to_pylist()]
    return np.frombuffer(b"".join(words), dtype=np.uint8), np.r_[0, np.cumsum([len(w) for w in words], dtype=np.int64)]


class _Reduced:
    """Reduced words of a batch as polynomials, with what their edits need."""

    def __init__(self, letters: np.ndarray, bounds: np.ndarray) -> None:
        self.length = np.diff(bounds)
        self.word = np.repeat(np.arange(len(self.length)), self.length)
        self.at = np.arange(len(letters)) - bounds[:-1][self.word]
        powers = np.full(int(self.length.max(initial=0)) + 2, _BASE, dtype=np.uint64)
        powers[0] = 1
        self.powers = np.cumprod(powers, dtype=np.uint64)
        self.symbol = _SYMBOL[letters]
        sums = np.r_[_U(0), np.cumsum(self.symbol * self.powers[self.at], dtype=np.uint64)]
        self.before = sums[:-1] - sums[bounds[:-1]][self.word]
        self.whole = sums[bounds[1:]] - sums[bounds[:-1]]

    def named(self, value: np.ndarray, length: np.ndarray) -> np.ndarray:
        return tx.mix(value + length.astype(np.uint64) * _LENGTH)

    def keys(self) -> np.ndarray:
        return self.named(self.whole, self.length)

    def neighbourhoods(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``(word, key)`` of every distinct entry of each full one-edit neighbourhood, in pieces."""
        yield np.arange(len(self.length)), self.keys()
        for s in range(1, SYMBOLS + 1):
            # Behind the last letter.
            yield np.arange(len(self.length)), self.named(self.whole + _U(s) * self.powers[self.length], self.length + 1)
        for low in range(0, len(self.word), PIECE):
            cut = slice(low, low + PIECE)
            word, at, symbol, before = self.word[cut], self.at[cut], self.symbol[cut], self.before[cut]
            length, whole, power = self.length[word], self.whole[word], self.powers[at]
            after = whole - before - symbol * power
            # Dropping any letter of a run of equal symbols gives the same word, so the run's first stands for it.
            last = np.r_[_U(0), self.symbol[: len(self.word) - 1]][cut]
            first = (at == 0) | (last != symbol)
            yield word[first], self.named(before + after * _INVERSE, length - 1)[first]
            for s in range(1, SYMBOLS + 1):
                other = symbol != _U(s)
                yield word[other], self.named(before + _U(s) * power + after, length)[other]
                # Before an equal symbol it is the word that one place further gives.
                yield word[other], self.named(before + _U(s) * power + (whole - before) * _U(_BASE), length + 1)[other]


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        letters, bounds = _letters(batch.column(0))
        parity = np.zeros(batch.num_rows, dtype=np.uint64)
        np.bitwise_xor.at(parity, np.repeat(np.arange(batch.num_rows), np.diff(bounds)), _BIT[letters])
        keys = _Reduced(letters, bounds).keys()
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64)), pa.array(parity.view(np.int64))], ["word", "n", "key", "parity"])


def _near(known: np.ndarray):
    """Entries of the neighbourhoods that the map of reduced words lets through."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, bounds = _letters(batch.column(2))
            for word, key in _Reduced(letters, bounds).neighbourhoods():
                hit = bits_of(known, key)
                at = pa.array(word[hit])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(key[hit].view(np.int64))], ["id", "parity", "near"])

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether the words differ by exactly one inserted, deleted or replaced code point."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) > len(b) + 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(b))
    return a[at + 1 :] == (b[at + 1 :] if len(a) == len(b) else b[at:])


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [one_edit(a, b) for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
        batch = batch.filter(pa.array(good, pa.bool_()))
        yield pa.RecordBatch.from_arrays([batch.column(i) for i in (0, 2, 3)], ["id", "near_word", "near_n"])


def vocabulary(docs: DataFrame, least_letters: int, least_n: int, one_in: int | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of the words of at least ``least_letters`` code points with ``least_n`` occurrences in all texts.

    Words are runs of letters A-Z, a-z and U+00C0 to U+00FF, lower-cased in A-Z only.  With ``one_in``, one code point is deleted
    from those runs for which it divides the CRC-32 of ``<id>:<run>``.
    """
    rows = docs.select(F.col(id).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    counts = rows.mapInArrow(_counted(least_letters, one_in), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_n)


def near_words(words: DataFrame) -> DataFrame:
    """``id, near_word, near_n``: for each row of ``words`` (``id``, ``word``, ``n``, ``key``, ``parity``) all others whose words are
    exactly one inserted, deleted or replaced code point away."""
    entries = words.select("id", "parity", "word").mapInArrow(_near(bit_map(words, "key")), "id long, parity long, near long")
    other = words.select(F.col("id").alias("near_id"), "key", F.col("parity").alias("near_parity"))
    close = (entries["near"] == other["key"]) & (F.bit_count(entries["parity"].bitwiseXOR(other["near_parity"])) <= 2) & (entries["id"] != other["near_id"])
    pairs = entries.join(other, close).select("id", "near_id")
    pairs = pairs.join(words.select(F.col("id").alias("near_id"), F.col("word").alias("near_word"), F.col("n").alias("near_n")), "near_id")
    pairs = pairs.join(words.select("id", "word"), "id").select("id", "word", "near_word", "near_n")
    return pairs.mapInArrow(_verified, "id long, near_word string, near_n long")


def spelling_variants(docs: DataFrame, least_letters: int = 7, least_n: int = 2, ratio: int = 10, one_in: int | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of the vocabulary.

    ``n_near`` counts the words exactly one edit away.  ``form`` is the most frequent of them, ties to the smallest in code-point
    order, if it occurs at least ``ratio`` times as often as the word; else NULL, as ``form_n``.  ``root`` follows the forms to the
    last, a word without form is its own; counts grow along them, so they end.

    NULL and empty texts have no words, a run of any length is one word; rows that repeat a document are each counted, rows
    without id read as an empty one; an empty table gives no rows.  Other columns take no part.  Reduced words are compared by
    64-bit values.
    """
    words = vocabulary(docs, least_letters, least_n, one_in, id, text).mapInArrow(_reduced, "word string, n long, key long, parity long")
    words = written(words.withColumn("id", F.monotonically_increasing_id()), "vocabulary")
    # The least struct has the most occurrences, then the smallest word.
    near = near_words(words).groupBy("id").agg(F.count("*").alias("n_near"), F.max("near_n").alias("near_n"), F.min(F.struct(-F.col("near_n"), "near_word")).alias("best"))
    found = words.join(near, "id", "left")
    has = F.col("near_n") >= ratio * F.col("n")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.near_word")).alias("form"), F.when(has, F.col("near_n")).alias("form_n"))
    found = written(found, "forms")
    top = roots(found.where("form IS NOT NULL").select(F.col("word").alias("id"), F.col("form").alias("parent")))
    return found.join(top.select(F.col("id").alias("word"), "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
