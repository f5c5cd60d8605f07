"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are runs of ASCII letters, digits and other non-ASCII bytes, lower-cased, so punctuation and case do not hide a copy; in scripts
that set no spaces between words every character is a word.  Every n-gram of a test item is a seed, and an item of fewer words is one
seed as a whole.  A document that holds a seed is aligned with the item around the seed: matching words score, other words and gaps
cost, and the best local alignment as a share of a perfect one is the similarity.  Edited and paraphrased copies keep a high
share, passages that merely share common words do not.

Rarity sets the order of the seeds: a pair of document and item is aligned around the rarest seeds that they share first.  A perfect
copy holds all of an item's seeds, so it is found there and its other seeds are passed over; pairs that are not decided are aligned
around all of them.  Rarity chooses no seeds: the n-grams that editing destroyed are the rarest of a copy, so a quota of rare ones
would go to those it does not hold.

The items are the query set: they are read in blocks of bounded size and every document is compared with each block, so no
document is moved.  One pass over the documents for each block finds seeds and aligns; it reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm import text as tx
from tallywork.llm.shared import fresh, written

MATCH, MISMATCH, GAP = 2, -1, -1
#: Places of seeds in one step of the search; a document with more is a step of its own.
STEP_SEEDS = 1 << 18
#: Characters of items in one block; a longer item is a block of its own.
BLOCK_CHARS = 8_000_000
_FILTER_BITS = 22
#: First and last code point of scripts without spaces between words: Thai and Lao, Myanmar, Khmer, kana, Han.
_UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))


# ---- items --------------------------------------------------------------------------

@dataclass(frozen=True)
class Items:
    """A block of items: their ids, words end to end, and n-grams with the places where they occur."""

    ids: list[int]
    words: np.ndarray
    bounds: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    #: Lengths of the items that are one seed as a whole.
    short: tuple[int, ...] = ()


def _characters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the characters of scripts without spaces."""
    at = np.flatnonzero(data >= 0xE0)
    at = at[at + 2 < len(data)]
    b = [data[np.minimum(at + j, len(data) - 1)].astype(np.int64) & 0x3F for j in range(4)]
    four = data[at] >= 0xF0
    code = np.where(four, ((data[at].astype(np.int64) & 7) << 18) | (b[1] << 12) | (b[2] << 6) | b[3], ((data[at].astype(np.int64) & 15) << 12) | (b[1] << 6) | b[2])
    hit = np.zeros(len(at), dtype=bool)
    for low, high in _UNSPACED:
        hit |= (code >= low) & (code <= high)
    return at[hit], at[hit] + np.where(four[hit], 4, 3)


def _document_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    data = tx.fold_latin(data)
    rows, start, end = tx.words(data, offsets, tx.PUNCTUATION)
    first, last = _characters(data)
    if len(first):
        # A word begins with each such character and behind it, and ends before it and with it, where word bytes stand there.
        word = ~tx.PUNCTUATION[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        start = np.unique(np.r_[start, first, last[(last < len(data)) & word[np.minimum(last, len(data) - 1)] & ~edge[last]]])
        end = np.unique(np.r_[end, last, first[(first > 0) & word[np.maximum(first, 1) - 1] & ~edge[first]]])
        rows = np.searchsorted(offsets, start, side="right") - 1
    return rows, tx.hash_words(data, start, end)


def index_items(rows: list[tuple[int, str]], n: int) -> Items:
    """Items of ``(item_id, text)`` rows; one of fewer than ``n`` words has its whole sequence as its one seed, one without words none."""
    raw = [text.encode() for _, text in rows]
    offsets = np.r_[0, np.cumsum([len(r) for r in raw], dtype=np.int64)].astype(np.int64)
    owner, hashes = _document_words(np.frombuffer(b"".join(raw), np.uint8), offsets)
    bounds = np.searchsorted(owner, np.arange(len(rows) + 1))
    item, gram, at = _seeds(hashes, owner, n, [n])
    size = np.diff(bounds)
    for length in np.unique(size[(size > 0) & (size < n)]).tolist():
        i, g, a = _seeds(hashes, owner, n, [length])
        whole = size[i] == length
        item, gram, at = np.r_[item, i[whole]], np.r_[gram, g[whole]], np.r_[at, a[whole]]
    order = np.lexsort((at, gram))
    item, gram, at = item[order], gram[order], at[order]
    grams, first = np.unique(gram, return_index=True)
    short = tuple(np.unique(size[(size > 0) & (size < n)]).tolist())
    return Items([i for i, _ in rows], hashes, bounds, grams, np.r_[first, len(gram)], item, at - bounds[item], short)


def _seeds(hashes: np.ndarray, rows: np.ndarray, n: int, lengths: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, hash, first word)`` of the runs of these lengths; runs shorter than ``n`` are told apart from others by their length."""
    parts = []
    for length in lengths:
        row, value, at = tx.shingles(hashes, rows, length, short=False)
        parts.append((row, value if length == n else tx.mix(value + np.uint64(length)), at))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


class _Lookup:
    """Finds which of a few n-grams stand in an array of many."""

    def __init__(self, grams: np.ndarray):
        self.grams = grams
        self.filter = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.filter[(grams >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def __call__(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``values`` that hold an n-gram, and which."""
        maybe = np.flatnonzero(self.filter[(values >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        if not len(maybe):
            return maybe, maybe
        which = np.minimum(np.searchsorted(self.grams, values[maybe]), len(self.grams) - 1)
        good = self.grams[which] == values[maybe]
        return maybe[good], which[good]


# ---- alignment ----------------------------------------------------------------------

def align(queries: list[np.ndarray], targets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman scores of pairs of word arrays, and the last target word of each best local alignment.

    All pairs go through one table row at a time.  A gap along the row is a running maximum, as gaps cost the same per word.
    """
    score, last = np.zeros(len(queries), np.int64), np.zeros(len(queries), np.int64)
    size = [len(q) * 100_000 + len(t) for q, t in zip(queries, targets, strict=True)]
    order, low = np.argsort(size, kind="stable"), 0
    while low < len(order):
        widest, high = 1, low
        while high < len(order) and high - low < 512 and (high - low + 1) * max(widest, len(targets[order[high]])) <= 1 << 18 or high == low:
            widest, high = max(widest, len(targets[order[high]])), high + 1
        some = order[low:high]
        depth = max(len(queries[i]) for i in some)
        target = np.zeros((len(some), widest), dtype=np.uint64)
        query = np.ones((len(some), depth), dtype=np.uint64)
        for k, i in enumerate(some):
            target[k, : len(targets[i])] = targets[i]
            query[k, : len(queries[i])] = queries[i]
        slope = -GAP * np.arange(1, widest + 1, dtype=np.int32)
        table = np.zeros((len(some), widest + 1), dtype=np.int32)
        best, end = np.zeros(len(some), np.int64), np.zeros(len(some), np.int64)
        for row in range(depth):
            step = np.where(target == query[:, row : row + 1], np.int32(MATCH), np.int32(MISMATCH))
            step += table[:, :-1]
            np.maximum(step, table[:, 1:] + np.int32(GAP), out=step)
            np.maximum(step, 0, out=step)
            step += slope
            np.maximum.accumulate(step, axis=1, out=step)
            step -= slope
            table[:, 1:] = step
            at = step.argmax(axis=1)
            top = step[np.arange(len(some)), at]
            better = top > best
            best[better], end[better] = top[better], at[better]
        score[some], last[some] = best, end
        low = high
    return score, last


def drift(lengths: np.ndarray, similarity: float) -> np.ndarray:
    """How far the diagonals of one alignment that reaches ``similarity`` can lie apart.

    A perfect score is ``MATCH`` a word of the item, and every diagonal left costs ``-GAP`` of it.
    """
    return np.ceil(MATCH * (1 - similarity) * lengths / -GAP).astype(np.int64)


def _windows(row: np.ndarray, item: np.ndarray, diagonal: np.ndarray, lengths: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(row, item, lowest, highest diagonal)`` of runs of seeds.

    Seeds of a run lie within an item's ``reach`` of the next, and a run spans two lengths at most.  An alignment through a
    seed of a run is within reach of that seed, so a window widened by the reach on both sides holds it whole.
    """
    order = np.lexsort((diagonal, item, row))
    row, item, diagonal = row[order], item[order], diagonal[order]
    cut = np.ones(len(row), dtype=bool)
    cut[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > reach[item[1:]])
    starts = np.flatnonzero(cut)
    origin = diagonal[starts][np.cumsum(cut) - 1]
    part = (diagonal - origin) // (2 * lengths[item])
    cut[1:] |= part[1:] != part[:-1]
    starts = np.flatnonzero(cut)
    ends = np.r_[starts[1:], len(row)] - 1
    return row[starts], item[starts], diagonal[starts], diagonal[ends]


def _steps(row: np.ndarray, fan: np.ndarray) -> Iterator[slice]:
    """Runs of seeds found that stand in about ``STEP_SEEDS`` places of items; those of a row stay together."""
    low, total = 0, np.cumsum(fan)
    while low < len(row):
        last = min(len(row) - 1, int(np.searchsorted(total, STEP_SEEDS + (total[low - 1] if low else 0))))
        # Back to the row's first, or on to its end where the run began with it.
        high = int(np.searchsorted(row, row[last])) if last < len(row) - 1 else len(row)
        high = high if high > low else int(np.searchsorted(row, row[last], side="right"))
        yield slice(low, high)
        low = high


def _rarest(row: np.ndarray, item: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Which hits are of the rarest seed of their pair of row and item."""
    order = np.lexsort((count, item, row))
    first = np.r_[True, (row[order][1:] != row[order][:-1]) | (item[order][1:] != item[order][:-1])] if len(order) else np.zeros(0, bool)
    least = np.empty(len(order), dtype=np.int64)
    least[order] = count[order][np.flatnonzero(first)][np.cumsum(first) - 1] if len(order) else 0
    return count == least


def _aligned(items: Items, hashes: np.ndarray, bounds: np.ndarray, row: np.ndarray, item: np.ndarray, diagonal: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(row, item, start, score, last)`` of the windows around some hits."""
    if not len(row):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    lengths = np.diff(items.bounds)
    row, item, least, most = _windows(row, item, diagonal, lengths, reach)
    start = np.maximum(least - reach[item], bounds[row])
    stop = np.minimum(most + lengths[item] + reach[item], bounds[row + 1])
    score, last = align([items.words[items.bounds[i] : items.bounds[i + 1]] for i in item], [hashes[a:b] for a, b in zip(start, stop, strict=True)])
    return row, item, start, score, last


def _matches(items: Items, n: int, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup, lengths = _Lookup(items.grams), np.diff(items.bounds)
        reach = drift(lengths, similarity)
        for batch in batches:
            for low, high, data, offsets in tx.slices(batch.column(1)):
                rows, hashes = _document_words(data, offsets)
                _, grams, at = _seeds(hashes, rows, n, [n, *items.short])
                if items.short:
                    order = np.argsort(at, kind="stable")
                    grams, at = grams[order], at[order]
                where, which = lookup(grams)
                # Rarity is that among the documents at hand: it sets the order only, so any count will do.
                count = np.bincount(which, minlength=len(items.grams))
                bounds = np.searchsorted(rows, np.arange(high - low + 1))
                for some in _steps(rows[at[where]], np.diff(items.first)[which]):
                    fan = np.diff(items.first)[which[some]]
                    hit = np.repeat(items.first[which[some]] - (np.cumsum(fan) - fan), fan) + np.arange(fan.sum())
                    item, place, word = items.item[hit], items.place[hit], np.repeat(at[where[some]], fan)
                    row, diagonal = rows[word], word - place
                    rare = _rarest(row, item, np.repeat(count[which[some]], fan))
                    first = _aligned(items, hashes, bounds, row[rare], item[rare], diagonal[rare], reach)
                    perfect = first[3] == MATCH * lengths[first[1]]
                    pair = lambda r, i: r * len(items.ids) + i
                    open_ = ~np.isin(pair(row, item), pair(first[0][perfect], first[1][perfect]))
                    rest = _aligned(items, hashes, bounds, row[open_], item[open_], diagonal[open_], reach)
                    row, item, start, score, last = (np.r_[a[perfect], b] for a, b in zip(first, rest, strict=True))
                    part = score / (MATCH * lengths[item])
                    good = np.flatnonzero(part >= similarity)
                    # The best window of each document and item, the first of equals.
                    good = good[np.lexsort((start[good], -score[good], item[good], row[good]))]
                    good = good[np.r_[True, (row[good][1:] != row[good][:-1]) | (item[good][1:] != item[good][:-1])]] if len(good) else good
                    # From the last word back, the reversed alignment ends where this one starts.
                    query = [items.words[items.bounds[i] : items.bounds[i + 1]] for i in item[good]]
                    back = align([q[::-1] for q in query], [hashes[start[g] : start[g] + last[g] + 1][::-1] for g in good])[1]
                    end = start[good] + last[good]
                    yield pa.RecordBatch.from_arrays([
                        batch.column(0).slice(low, high - low).take(pa.array(row[good])), pa.array([items.ids[i] for i in item[good]], pa.int64()), pa.array(score[good]),
                        pa.array(part[good]), pa.array(end - back - bounds[row[good]]), pa.array(end + 1 - bounds[row[good]]),
                    ], ["doc_id", "item_id", "score", "similarity", "start_word", "end_word"])

    return run


# ---- Spark --------------------------------------------------------------------------

def blocks(benchmark: DataFrame, id: str = "item_id", text: str = "text", chars: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's ``(id, text)`` rows in blocks of about ``chars`` characters, so that each fits any machine."""
    rows = benchmark.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).where("id IS NOT NULL")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    count = int(total // chars) + 1
    for k in range(count):
        some = rows.where(F.pmod(F.xxhash64("id"), F.lit(count)) == k).distinct().orderBy("id", "t").collect()
        if some:
            yield [(r.id, r.t) for r in some]


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 4, similarity: float = 0.6, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, item_id, score, similarity, start_word, end_word`` of documents that hold a copy of a test item.

    ``similarity`` is the share of a perfect alignment's score that the best local alignment reaches.  The words are those of
    the document's best window; the first of equally good ones counts.  NULL and empty texts and items hold no seed; an item of
    fewer than ``n`` words is found where its whole sequence stands.  Alignment takes time with the square of an item's length.  Rows
    that repeat an id are judged one by one, repeated items count once, and an item id with two texts counts with either.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    out: DataFrame | None = None
    for rows in blocks(benchmark):
        items = index_items(rows, n)
        if not len(items.grams):
            continue
        found = texts.mapInArrow(_matches(items, n, similarity), "doc_id long, item_id long, score long, similarity double, start_word long, end_word long")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, score long, similarity double, start_word long, end_word long")
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", **options) -> DataFrame:
    """The documents that hold no copy of a test item, all columns; a row without id is kept."""
    name = fresh(docs, "_found")
    found = written(contamination(docs, benchmark, id=id, **options).select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return docs.join(found, F.col(id).cast("long") == F.col(name), "left_anti")
