"""Repeated byte strings through an enhanced suffix array over sampled suffixes.

A string of ``length`` bytes that occurs twice must be found wherever it starts, yet a suffix for every byte would move the corpus
many times over.  So suffixes are sampled by content: of the ``length - GRAM + 1`` grams of ``GRAM`` bytes in every string of
``length`` bytes the least hash, leftmost among equals, is its anchor.  Equal strings have equal anchors at equal places, so every
repeat is seen from a common anchor, and consecutive strings mostly share theirs: the starts with one anchor are a section, and one
start in seventy or so is an anchor.

Sections equal to another one are repeats as they are, found by counting.  What is left are sections that share an anchor's gram with
different ones: the ends of repeated passages.  For them the suffixes at the anchors are sorted, neighbours give the common prefixes,
and a stack scan over these gives the interval tree: every interval is a set of suffixes with a common prefix.  Inside an interval the
suffixes are kept in the order of what stands before them, read backwards.  Neighbours in that order give how far the left sides agree, so
where left extensions differ the interval splits, and every string that cannot grow to either side without losing an occurrence
comes out with all that hold it, not just with neighbours in the array.

A gram with more than ``MEMBERS`` different sections is first refined: a repeat of ``length`` bytes reaches beyond what the members have in
common by half of the remaining bytes on the left or by half on the right, so members are dealt again by their longer left
and by their longer right context.  Each round halves what remains, so a few rounds end it, and no group is ever cut or sampled.

Equal texts are one text with a count.  Texts are moved thrice: to be made distinct, to cut the sections that need sorting, and to be
cut by what was found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywork.llm import text as tx
from tallywork.llm.shared import bit_map, bits_of, written

#: Bytes of an anchor.
GRAM = 64
#: Different sections of one gram that one task sorts; grams with more are refined.
MEMBERS = 2_000
#: Sections that one task sorts, about; it may get one gram more.
TASK_ROWS = 20_000
#: Starts of a very long text that are looked at together; fits the 24 bits that a start has in a value to be compared.
_PIECE = 1 << 22
_AT_BITS = np.uint64(24)
_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 2**64)
_NEVER = np.uint64(2**64 - 1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every run of ``width``."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


class _Sections:
    """Sections of some texts: ``row``, ``anchor``, ``first`` and ``last`` start (from the text's first byte), gram and whole hash."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, length: int) -> None:
        self.row, self.anchor, self.first, self.last, self.gram, self.whole = (np.zeros(0, np.int64) for _ in range(6))
        n = len(data)
        if n < length:
            return
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + _U(1)) * tx.mix(data.astype(np.uint64) + _U(77)) * _powers(_STEP, n), out=sums[1:])
        back = _powers(_BACK, n)
        grams = tx.mix((sums[GRAM:] - sums[:-GRAM]) * back[: n - GRAM + 1])
        place = np.arange(len(grams), dtype=np.uint64)
        lowest = _least((grams >> _AT_BITS << _AT_BITS) | place, length - GRAM + 1)
        at = (lowest & _U((1 << int(_AT_BITS)) - 1)).astype(np.int64)
        start = np.arange(len(at))
        row = np.searchsorted(offsets, start, side="right") - 1
        inside = start + length <= offsets[row + 1]
        start, row, at = start[inside], row[inside], at[inside]
        if not len(start):
            return
        cut = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1)])
        end = np.r_[cut[1:], len(start)] - 1
        self.row, base = row[cut], offsets[row[cut]]
        first, last, anchor = start[cut], start[end], at[cut]
        whole = (sums[last + length] - sums[first]) * back[first]
        shape = ((anchor - first).astype(np.uint64) << _U(32)) + (last - first).astype(np.uint64)
        self.gram, self.whole = grams[anchor], tx.mix(whole + tx.mix(shape + _U(1)))
        self.first, self.last, self.anchor = first - base, last - base, anchor - base


def sections(column: pa.Array, length: int) -> Iterator[tuple[int, _Sections]]:
    """Sections of a column of texts, and the row that theirs count from; a very long text comes in pieces."""
    for low, high, data, offsets in tx.slices(column):
        if len(data) <= _PIECE + length:
            yield low, _Sections(data, offsets, length)
            continue
        # A slice beyond the limit is one text.
        for begin in range(0, len(data) - length + 1, _PIECE):
            piece = data[begin : begin + _PIECE + length - 1]
            found = _Sections(piece, np.array([0, len(piece)]), length)
            for places in (found.first, found.last, found.anchor):
                places += begin
            yield low, found


def _grams(length: int):
    """Grams of the anchors of a task's texts, with the number of their sections."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, found in sections(batch.column(0), length):
                gram, n = np.unique(found.gram, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(n)], ["gram", "n"])

    return run


def _shared_sections(length: int, known: np.ndarray):
    """Sections whose gram the map has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, found in sections(batch.column(1), length):
                hit = bits_of(known, found.gram.view(np.uint64))
                plain = [pa.array(x[hit]) for x in (found.gram.view(np.int64), found.whole.view(np.int64), found.anchor, found.first, found.last)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(found.row[hit] + low)), *plain], ["key", "gram", "whole", "anchor", "first", "last"])

    return run


def _cut(length: int):
    """Left and right sides of the listed sections of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = memoryview(batch.column(1)[i].as_buffer())
                listed = batch.column(2)[i].values
                anchor, first, last = (listed.field(name).to_pylist() for name in ("anchor", "first", "last"))
                left = [bytes(text[f:a]) for f, a in zip(first, anchor, strict=True)]
                right = [bytes(text[a : x + length]) for a, x in zip(anchor, last, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [listed.field("gram"), listed.field("gram"), listed.field("whole"), batch.column(0).take(pa.array([i] * len(left), pa.int32())), listed.field("anchor"), listed.field("one"),
                     pa.array(left, pa.binary()), pa.array(right, pa.binary())],
                    ["g", "gram", "whole", "key", "anchor", "one", "left", "right"],
                )

    return run


# ---- one gram -----------------------------------------------------------------------

def _prefix(x: bytes, y: bytes) -> int:
    """Bytes in which two strings agree from the front."""
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    return n - ((int.from_bytes(x[:n], "big") ^ int.from_bytes(y[:n], "big")).bit_length() + 7) // 8


def interval_tree(rights: list[bytes]) -> tuple[list[int], Iterator[tuple[int, list[int]]]]:
    """Places of ``rights`` in sorted order, and the intervals of their common prefixes.

    An interval is its common prefix and the intervals or places it joins, named by numbers: those below ``len(rights)`` are places in
    ``rights``, further ones intervals in order.  Inner ones come before outer ones.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    common = [_prefix(rights[a], rights[b]) for a, b in zip(order[:-1], order[1:], strict=True)]

    def scan() -> Iterator[tuple[int, list[int]]]:
        made = len(rights)
        stack: list[tuple[int, list[int]]] = []
        for i, place in enumerate(order):
            above = common[i] if i < len(common) else -1
            below = place
            while stack and stack[-1][0] > above:
                value, parts = stack.pop()
                parts.append(below)
                yield value, parts
                below, made = made, made + 1
            if stack and stack[-1][0] == above:
                stack[-1][1].append(below)
            elif above >= 0:
                stack.append((above, [below]))

    return order, scan()


def repeats(lefts: list[bytes], rights: list[bytes], length: int) -> Iterator[tuple[int, int, int]]:
    """``(member, bytes before its anchor, bytes from it)`` of the maximal repeats of ``length`` bytes or more, for all their members.

    A repeat comes out for a member where it reaches further to the left than those of the member's inner intervals.
    """
    backwards = [x[::-1] for x in lefts]
    best = [-1] * len(lefts)
    held: dict[int, list[int]] = {}
    made = len(lefts)
    for value, parts in interval_tree(rights)[1]:
        members = [m for p in parts for m in (held.pop(p) if p >= len(lefts) else [p])]
        members.sort(key=backwards.__getitem__)
        held[made] = members
        made += 1
        if value + max(len(backwards[m]) for m in members) < length:
            continue
        agree = [_prefix(backwards[a], backwards[b]) for a, b in zip(members[:-1], members[1:], strict=True)]
        for i, m in enumerate(members):
            reach = max(agree[i - 1] if i else 0, agree[i] if i < len(agree) else 0)
            if reach > best[m] and value + reach >= length:
                best[m] = reach
                yield m, reach, value


def _sorted(length: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        group = group.sort_values("g", kind="stable")
        columns = {c: group[c].tolist() for c in ("gram", "whole", "key", "anchor", "one", "left", "right")}
        cuts = np.flatnonzero(np.r_[True, np.diff(group["g"].to_numpy()) != 0, True]) if len(group) else [0]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            lefts, rights = columns["left"][low:high], columns["right"][low:high]
            for m, before, behind in repeats(lefts, rights, length):
                string = (lefts[m][len(lefts[m]) - before :] + rights[m][:behind])
                name = int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little", signed=True)
                i = low + m
                out.append((columns["gram"][i], columns["whole"][i], columns["one"][i], columns["key"][i], columns["anchor"][i] - before, name, before, before + behind))
        return pd.DataFrame(out, columns=["gram", "whole", "one", "key", "start", "repeat", "before", "n_bytes"])

    return run


_FOUND = "gram long, whole long, one boolean, key long, start long, repeat long, before long, n_bytes long"


def _refined(members: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Members dealt again by longer contexts, one for each class of equal ones, and the repeats that are such classes."""
    held = length - F.col("l") - F.col("r")
    half = F.ceil(held / 2).cast("int")
    to_left, to_right = F.col("l") + half, F.col("r") + held - half + 1
    last = lambda c, n: F.substring(c, F.length(c) - n + 1, n)
    state = lambda name, g, left, right, l, r: F.struct(F.xxhash64(F.col("g"), F.lit(name), g).alias("g"), left.alias("left"), right.alias("right"), l.cast("int").alias("l"), r.cast("int").alias("r"))  # noqa: E731, E741
    left, right = F.col("left"), F.col("right")
    longer_left = F.when(F.length(left) >= to_left, state("l", last(left, to_left), left, F.substring(right, F.lit(1), length - to_left), to_left, F.col("r")))
    longer_right = F.when((F.length(right) >= to_right) & (half > 0), state("r", F.substring(right, F.lit(1), to_right), last(left, F.least(F.length(left), length - to_right)), right, F.col("l"), to_right))
    dealt = members.withColumn("to", F.explode(F.array_compact(F.array(longer_left, longer_right))))
    dealt = dealt.select("to.*", "gram", "whole", "key", "anchor", "one").withColumn("same", F.xxhash64("left", "right"))
    dealt = written(dealt, "dealt")
    each = F.struct("key", "anchor", "one", "gram", "whole", "left", "right", "l", "r")
    classes = dealt.groupBy("g", "same").agg(F.count("*").alias("n"), F.min(each).alias("m"))
    classes = written(classes.select("g", "same", "n", "m.*"), "classes")
    equal = dealt.join(classes.where("n > 1").select("g", "same"), ["g", "same"]).where(F.length("left") + F.length("right") >= length)
    equal = equal.select(
        "gram", "whole", "one", "key", (F.col("anchor") - F.length("left")).alias("start"), F.xxhash64("left", "right").alias("repeat"),
        F.length("left").cast("long").alias("before"), (F.length("left") + F.length("right")).cast("long").alias("n_bytes"),
    )
    return classes.withColumn("one", F.col("one") & (F.col("n") == 1)).drop("n", "same"), equal


def _partial(members: DataFrame, length: int) -> DataFrame:
    """Repeats inside of the sections of common grams, from the section of one member of each class of equal ones."""
    members = written(members.withColumn("l", F.lit(0)).withColumn("r", F.lit(GRAM)), "members")
    found: list[DataFrame] = []
    while True:
        sizes = members.groupBy("g").agg(F.count("*").alias("m"))
        small = members.join(sizes.where((F.col("m") > 1) & (F.col("m") <= MEMBERS)).select("g"), "g")
        small = written(small.select("g", "gram", "whole", "one", "key", "anchor", "left", "right"), "sorted")
        task = F.pmod(F.xxhash64("g"), F.lit(small.count() // TASK_ROWS + 1))
        found.append(written(small.withColumn("task", task).groupBy("task").applyInPandas(_sorted(length), _FOUND), "repeats"))
        large = sizes.where(F.col("m") > MEMBERS).select("g")
        if large.isEmpty():
            break
        members, equal = _refined(members.join(large, "g", "left_semi"), length)
        found.append(equal)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def distinct_texts(docs: DataFrame, least: int, text: str = "text") -> DataFrame:
    """``key, digest, copies, t``: each text of at least ``least`` bytes once."""
    rows = docs.select(F.col(text).alias("t")).where(F.octet_length("t") >= least)
    rows = rows.groupBy(F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("digest")).agg(F.count("*").alias("copies"), F.first("t").alias("t"))
    return written(rows.withColumn("key", F.monotonically_increasing_id()), "texts")


def _occurrences(texts: DataFrame, length: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sections with a common gram, those of them that equal another one, and the repeats inside of the others."""
    if length < 2 * GRAM:
        raise ValueError("repeats are of two grams at least")
    grams = texts.select("t").mapInArrow(_grams(length), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")
    shared = texts.select("key", "t").mapInArrow(_shared_sections(length, bit_map(grams, "gram")), "key long, gram long, whole long, anchor long, first long, last long")
    shared = written(shared, "sections")
    # A member of each class; a class of two or more is a repeat as it is.
    place = F.struct("key", "anchor", "first", "last")
    classes = written(shared.groupBy("gram", "whole").agg(F.count("*").alias("n"), F.min(place).alias("m")), "classes")
    open_ = classes.groupBy("gram").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1").select("gram")
    wanted = classes.join(open_, "gram", "left_semi").select("gram", "whole", (F.col("n") == 1).alias("one"), "m.*")
    # A text has no more sections than bytes, so its list is bounded by the text itself.
    lists = wanted.groupBy("key").agg(F.collect_list(F.struct("gram", "whole", "one", "anchor", "first", "last")).alias("listed"))
    members = texts.select("key", F.col("t").cast("binary").alias("t")).join(lists, "key")
    members = members.mapInArrow(_cut(length), "g long, gram long, whole long, key long, anchor long, one boolean, left binary, right binary")
    whole = shared.join(classes.where("n > 1").select("gram", "whole"), ["gram", "whole"])
    return shared, whole, _partial(members, length)


def maximal_repeats(docs: DataFrame, length: int = 200, text: str = "text") -> DataFrame:
    """``repeat, n_bytes, digest, start``: groups of equal strings of ``length`` bytes or more with all their occurrences.

    An occurrence is a start in bytes in the text with that SHA-256 ``digest``; ``copies`` counts the rows of that text.  Strings are
    maximal within the sections seen from one anchor; a longer repeat is a chain of overlapping ones.  A text that is itself
    repeated is one occurrence.  NULL, empty and shorter texts have none; an empty table gives no rows.
    """
    texts = distinct_texts(docs, length, text)
    shared, whole, partial = _occurrences(texts, length)
    equal = whole.select("key", F.col("first").alias("start"), F.col("whole").alias("repeat"), (F.col("last") + length - F.col("first")).alias("n_bytes"))
    inside = partial.select("gram", "whole", "repeat", "before", "n_bytes").distinct().join(shared.select("gram", "whole", "key", "anchor"), ["gram", "whole"])
    inside = inside.select("key", (F.col("anchor") - F.col("before")).alias("start"), "repeat", "n_bytes")
    return equal.unionByName(inside).distinct().join(texts.select("key", "digest", "copies"), "key").select("repeat", "n_bytes", "digest", "copies", "start")


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its spans."""
    for batch in batches:
        removed, spans, digests, kept = [], [], [], []
        for i in range(batch.num_rows):
            text = memoryview(batch.column(1)[i].as_buffer())
            listed = batch.column(2)[i].values
            start, end = (listed.field(name).to_numpy() for name in ("start", "end"))
            order = np.argsort(start, kind="stable")
            start, reach = start[order], np.maximum.accumulate(end[order])
            # Spans that touch are one run of removed bytes.
            cut = np.flatnonzero(np.r_[True, start[1:] > reach[:-1]])
            low, high = start[cut].tolist(), reach[np.r_[cut[1:], len(start)] - 1].tolist()
            left = b"".join(text[a:b] for a, b in zip([0, *high], [*low, len(text)], strict=True))
            removed.append(len(text) - len(left))
            spans.append(len(low))
            digests.append(hashlib.sha256(left).digest())
            kept.append(left)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.binary()), pa.array(kept, pa.binary())], ["digest", "n_removed", "n_spans", "kept", "rest"])


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def without_repeats(docs: DataFrame, length: int = 200, id: str = "doc_id", text: str = "text", rest: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every row, once the bytes of repeated strings are removed.

    A byte goes if a string of ``length`` bytes over it also starts elsewhere, in its own text or in another; strings are judged on
    the texts as they are and never cross texts.  ``n_spans`` counts the maximal runs of removed bytes; ``kept_sha256`` is that of the
    other bytes end to end, which ``rest`` adds as a binary column (NULL where nothing was removed).

    Texts are UTF-8 bytes, a NULL text is an empty one.  Rows that repeat a text, with or without its id, repeat it, so one of
    ``length`` bytes or more loses all in each.  Every row comes back; an empty table gives no rows.  Other columns take no part.
    Strings are compared by 64-bit hashes of their anchors and sections, and by their bytes where sections differ.
    """
    texts = distinct_texts(docs, length, text)
    _, whole, partial = _occurrences(texts, length)
    spans = whole.select("key", F.col("first").alias("start"), (F.col("last") + length).alias("end"))
    spans = spans.unionByName(partial.where("one").select("key", "start", (F.col("start") + F.col("n_bytes")).alias("end")))
    lists = spans.groupBy("key").agg(F.collect_list(F.struct("start", "end")).alias("listed"))
    single = texts.where("copies = 1").select("key", "digest", F.col("t").cast("binary").alias("t")).join(lists, "key").select("digest", "t", "listed")
    schema = "digest binary, n_removed long, n_spans long, kept binary, rest binary"
    cut = single.mapInArrow(_kept, schema)
    if not rest:
        cut = cut.drop("rest")
    none = F.unhex(F.sha2(F.lit(b""), 256))
    gone = texts.where("copies > 1").select("digest", F.octet_length("t").cast("long").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), none.alias("kept"))
    cut = cut.unionByName(gone.withColumn("rest", F.lit(b"")) if rest else gone)
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id).cast("long").alias("doc_id"), F.octet_length(body).cast("long").alias("n_bytes"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"))
    out = rows.join(cut, "digest", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("doc_id", "n_bytes", zero("n_removed"), zero("n_spans"), _hex(F.coalesce("kept", "digest")).alias("kept_sha256"), *(["rest"] if rest else []))
