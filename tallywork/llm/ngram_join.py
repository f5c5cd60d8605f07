"""N-gram Jaccard join through R-trees over count vectors.

A document's shingles are hashed into groups and the group counts are its point.  For two documents the sum of the smaller
count of every group bounds their overlap from above, and the same sum over the upper corners of two boxes bounds the
overlap of any pair below them.

The index is a forest.  Hash the shingles into ``S`` sections, ``S`` one more than the largest number of shingles in which two
linked documents of these sizes can differ: some section then has equal counts in both.  So each (size band, section, counts
of the section's groups) is the root of one tree - a box without extent in the section's coordinates - and every linked pair
meets below a common root.  The roots deal the work over the cluster; below a root with several documents an R-tree over all
coordinates finds the pairs whose bound reaches the threshold, and those are verified on the shingle sets.

Documents with equal sets are one class, joined in linear time.  Pairs of one component need no look: a first pass verifies one
link per document, to the most central document under its most frequent root, and the trees then only join across
components.  So a group of near copies costs as much as its size, and no link between components is lost.

What is left between components is joined round by round.  Leaves reject by parities of the counts of four groups a shingle or more,
so what passes is a link or very nearly one, and a task names no more pairs than span its components, nearest first.  Verified
links join components, the others are remembered, and the next round looks again at what is apart; the last one names all that is
left.  So neither a group of linked documents nor one of documents just too different makes pairs with the square of its size.

The texts are read where they lie and never moved: for the sets' digests, for the roots, for the points of documents that
share a root with another one, and for the sets of those that a bound has left as candidates.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywork.llm import text as tx
from tallywork.llm.components import components, roots
from tallywork.llm.shared import fresh, remove, scratch, written

#: Bits of the fine groups that address the roots.  With too few of them sections of one shingle would meet by chance, and ever more as
#: documents do.
FINE_BITS = 24
#: Coordinates of a point; each is the sum of ``2 ** FINE_BITS / COORDINATES`` fine groups.
COORDINATES = 64
#: Points below a root that one task joins; larger roots are cut into chunks and every pair of chunks is a task.
CHUNK = 2_048
#: Bits of the sketch that leaves try first, the parities folded to one length.
SKETCH = 512
#: Rounds in which tasks name pairs that span components; in the last, all pairs that are left.
ROUNDS = 2
_LEAF, _FAN = 16, 4
#: Rows of candidate roots that one task joins, about; it may get one root, or pair of chunks, more.
TASK_ROWS = 30_000
#: Points below a root up to which all its pairs are tried at once; beyond, through a tree.
_SMALL = 48
#: Bits of a class's digest that its roots carry; classes that agree in them are taken for each other until verified.
_KEY_BITS = 48
#: Bits of the map of wanted ids, 8 MB.  Beyond so many ids it lets more texts through to the join that decides.
_MAP_BITS = 26


def bands(limit: int = 1 << 40) -> np.ndarray:
    """Smallest set size of each band; a band's largest size is about one and a half times its smallest."""
    out = [1]
    while out[-1] < limit:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return np.array(out, dtype=np.int64)


_BANDS = bands()


def n_sections(band: np.ndarray, percent: int) -> np.ndarray:
    """One more than the most shingles in which two linked sets of the band can differ.

    ``100 |x & y| >= percent |x | y|`` gives ``|x ^ y| <= (100 - percent) (|x| + |y|) / (100 + percent)``.
    """
    return 2 * (_BANDS[band + 1] - 1) * (100 - percent) // (100 + percent) + 1


def _spread(band: np.ndarray, percent: int) -> np.ndarray:
    """Sections used: some more than needed, by the share that is empty in the smallest set of the band.

    A set with more filled sections than differences allowed shares a filled one with every partner, so it does without the
    roots of its empty sections, which most other sets would share.
    """
    need = n_sections(band, percent)
    fill = percent / 100 * _BANDS[band] / need
    return need + np.ceil(1.5 * need * np.exp(-fill)).astype(np.int64) + 2


def _sectioned(counts: np.ndarray, band: np.ndarray, rows: np.ndarray, values: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Addresses of the roots of every row with ``band >= 0``, end to end, and their number for each row."""
    safe = np.maximum(band, 0)
    sections = np.where(band >= 0, _spread(safe, percent), 0)
    base = np.r_[0, np.cumsum(sections)]
    use = band[rows] >= 0
    rows, values = rows[use], values[use]
    section = (tx.mix(values ^ np.uint64(0x5EC7)) % sections[rows].astype(np.uint64)).astype(np.int64)
    sums, filled = np.zeros(base[-1], dtype=np.uint64), np.zeros(base[-1], dtype=bool)
    np.add.at(sums, base[rows] + section, tx.mix((values >> np.uint64(64 - FINE_BITS)) + np.uint64(1)))
    filled[base[rows] + section] = True
    owner = np.repeat(np.arange(len(counts)), sections)
    enough = np.bincount(owner[filled], minlength=len(counts)) >= n_sections(safe, percent)
    place = (band[owner].astype(np.uint64) << np.uint64(44)) + (np.arange(base[-1]) - base[owner]).astype(np.uint64)
    use = filled | ~enough[owner]
    return tx.mix(sums + tx.mix(place + np.uint64(1)))[use], np.bincount(owner[use], minlength=len(counts))


def _distinct_shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    data = tx.LOWER[data]
    rows, start, end = tx.words(data, offsets)
    row, value, _ = tx.shingles(tx.hash_words(data, start, end), rows, k)
    return tx.distinct(row, value, len(offsets) - 1)


def _digests(values: np.ndarray, rows: np.ndarray, n: int) -> list[np.ndarray]:
    """Two 64-bit sums that name the set of each row."""
    out = np.zeros((2, n), dtype=np.uint64)
    for digest, salt in zip(out, (0xA5A5, 0x5A5A), strict=True):
        np.add.at(digest, rows, tx.mix(values ^ np.uint64(salt)))
    return [x.view(np.int64) for x in out]


def _digested(k: int):
    """Size and digests of every row's set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in tx.slices(batch.column(1)):
                values, bounds = _distinct_shingles(data, offsets, k)
                counts = np.diff(bounds)
                digest = _digests(values, np.repeat(np.arange(high - low), counts), high - low)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(counts, pa.int64()), *map(pa.array, digest)], ["id", "n", "d1", "d2"])

    return run


def _rooted(k: int, percent: int):
    """Key and roots of every set; of equal sets that one task meets, the first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[int, int]] = set()
        for batch in batches:
            for low, high, data, offsets in tx.slices(batch.column(0)):
                n = high - low
                values, bounds = _distinct_shingles(data, offsets, k)
                counts = np.diff(bounds)
                rows = np.repeat(np.arange(n), counts)
                digest = _digests(values, rows, n)
                if len(met) > 1_000_000:
                    met.clear()
                for i, name in enumerate(zip(digest[0].tolist(), digest[1].tolist(), strict=True)):
                    if name in met:
                        counts[i] = 0
                    elif counts[i]:
                        met.add(name)
                use = counts[rows] > 0
                rows, values = rows[use], values[use]
                band = np.where(counts > 0, np.searchsorted(_BANDS, np.maximum(counts, 1), side="right") - 1, -1)
                # The larger document of a pair names the band; a smaller one just below it is indexed there too.
                above = np.where((counts > 0) & (100 * counts >= percent * _BANDS[np.maximum(band, 0) + 1]), band + 1, -1)
                key = digest[0] & ((1 << _KEY_BITS) - 1)
                for b in (band, above):
                    address, each = _sectioned(counts, b, rows, values, percent)
                    yield pa.RecordBatch.from_arrays([pa.array(address.view(np.int64)), pa.array(np.repeat(key, each))], ["root", "key"])

    return run


#: What a look-up of the texts of some classes gives: point and parities, as many as the set needs, or the set.
_KINDS = {"points": "point binary, parity binary", "sets": "shingles array<long>"}


def _parity(values: np.ndarray) -> bytes:
    """Parities of the counts of a power of two of groups, four groups a shingle or more."""
    groups = 1 << max(9, int(4 * max(1, len(values)) - 1).bit_length())
    return np.packbits((np.bincount((values & np.uint64(groups - 1)).astype(np.int64), minlength=groups) & 1).astype(bool)).tobytes()


def _points(packed: list[bytes]) -> np.ndarray:
    """Points of one byte a coordinate, or of four where a count needs them."""
    out = np.zeros((len(packed), COORDINATES), dtype=np.uint32)
    small = np.array([len(p) == COORDINATES for p in packed], dtype=bool)
    for kind, some in (("u1", small), ("<u4", ~small)):
        out[some] = np.frombuffer(b"".join(packed[i] for i in np.flatnonzero(some).tolist()), dtype=kind).reshape(-1, COORDINATES)
    return out


class Parities:
    """Parities of many sets; two are compared once the longer is folded to the length of the shorter."""

    def __init__(self, packed: list[bytes]) -> None:
        self.length = np.array([len(p) for p in packed], dtype=np.int64)
        self.place = np.zeros(len(packed), dtype=np.int64)
        self.held = {}
        for n in np.unique(self.length).tolist():
            at = np.flatnonzero(self.length == n)
            self.place[at] = np.arange(len(at))
            self.held[n] = np.frombuffer(b"".join(packed[i] for i in at.tolist()), dtype=np.uint64).reshape(len(at), -1)

    def sketches(self) -> np.ndarray:
        """All of them folded to ``SKETCH`` bits."""
        out = np.zeros((len(self.length), SKETCH // 64), dtype=np.uint64)
        for n, rows in self.held.items():
            out[self.length == n] = np.bitwise_xor.reduce(rows.reshape(len(rows), -1, SKETCH // 64), axis=1)
        return out

    def differ(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Bits in which the sets of each pair differ, at most as many as they have shingles that are not common."""
        out = np.zeros(len(x), dtype=np.int64)
        kinds = np.stack([self.length[x], self.length[y]], axis=1)
        for n, m in np.unique(kinds, axis=0).tolist():
            at = np.flatnonzero((kinds[:, 0] == n) & (kinds[:, 1] == m))
            step = max(1, (1 << 22) // max(n, m))
            for i in range(0, len(at), step):
                part = at[i : i + step]
                a, b = self.held[n][self.place[x[part]]], self.held[m][self.place[y[part]]]
                if n != m:
                    a, b = (np.bitwise_xor.reduce(v.reshape(len(part), -1, min(n, m) // 8), axis=1) for v in (a, b))
                out[part] = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64)
        return out


def _looked_up(k: int, wanted: np.ndarray, kind: str):
    """Digests, and what ``kind`` names, of the rows whose ids the map has."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(2).to_numpy()
            batch = batch.filter(pa.array((wanted[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1))
            for low, high, data, offsets in tx.slices(batch.column(1)):
                n = high - low
                values, bounds = _distinct_shingles(data, offsets, k)
                rows = np.repeat(np.arange(n), np.diff(bounds))
                if kind == "sets":
                    more, names = [pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values.view(np.int64)))], ["shingles"]
                else:
                    points = np.bincount(rows * COORDINATES + (values >> np.uint64(58)).astype(np.int64), minlength=n * COORDINATES).reshape(n, COORDINATES)
                    parities = [_parity(values[i:j]) for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
                    more, names = [pa.array([p.astype("u1" if p.max(initial=0) < 256 else "<u4").tobytes() for p in points], pa.binary()), pa.array(parities, pa.binary())], ["point", "parity"]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, n), pa.array(np.diff(bounds), pa.int64()), *map(pa.array, _digests(values, rows, n)), *more], ["least", "n", "d1", "d2", *names])

    return run


def _id_map(ids: DataFrame) -> np.ndarray:
    """Bits of the hashed ids, at most ``2 ** _MAP_BITS`` of them whatever the number of ids."""
    at = F.pmod(F.xxhash64("id"), F.lit(1 << _MAP_BITS)) + 1
    parts = ids.groupBy(F.bitmap_bucket_number(at).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    out = np.zeros((1 << _MAP_BITS) // 8, dtype=np.uint8)
    for part in parts:
        bits = np.frombuffer(bytes(part.bits), dtype=np.uint8)
        out[(part.b - 1) * len(bits) : part.b * len(bits)] = bits
    return out


# ---- one tree -----------------------------------------------------------------------

def _order(points: np.ndarray) -> np.ndarray:
    """Rows in leaf order: halves by the widest coordinate until a leaf is reached."""
    out, stack = [], [np.arange(len(points))]
    while stack:
        rows = stack.pop()
        if len(rows) <= _LEAF:
            out.append(rows)
            continue
        axis = int(np.ptp(points[rows], axis=0).argmax())
        half = max(_LEAF, len(rows) // 2 // _LEAF * _LEAF)
        rows = rows[np.argpartition(points[rows, axis], half)] if half < len(rows) else rows
        stack += [rows[half:], rows[:half]]
    return np.concatenate(out)


def tree_join(points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, percent: int, sketches: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows of different labels whose summed coordinate minima reach the overlap that a link needs.

    Both sides walk one R-tree from the top; a pair of boxes goes on if the minima of their upper corners reach the
    overlap that the smallest sizes below them need, and if not all rows below have one label.  ``sketches`` spare most pairs
    in a leaf the sum.
    """
    order = _order(points)
    points, sizes, labels = points[order].astype(np.int32), sizes[order], labels[order]
    sketches = None if sketches is None else np.ascontiguousarray(sketches[order])
    levels = []
    width, box = _LEAF, None
    while box is None or len(box[0]) > _FAN:
        if box is None:
            cut = np.arange(0, len(points), width)
            source = (points, sizes, labels, labels)
        else:
            cut = np.arange(0, len(box[0]), _FAN)
            source = box
        box = (np.maximum.reduceat(source[0], cut), np.minimum.reduceat(source[1], cut), np.minimum.reduceat(source[2], cut), np.maximum.reduceat(source[3], cut))
        levels.append(box)

    a, b = np.triu_indices(len(levels[-1][0]))
    for depth in range(len(levels) - 1, -1, -1):
        upper, least, low, high = levels[depth]
        keep = np.concatenate([_reach(upper[a[i : i + 4096]], upper[b[i : i + 4096]], least[a[i : i + 4096]], least[b[i : i + 4096]], percent) for i in range(0, len(a), 4096)] or [np.zeros(0, bool)])
        keep &= (np.minimum(low[a], low[b]) != np.maximum(high[a], high[b]))
        a, b = a[keep], b[keep]
        fan, n = (_FAN, len(levels[depth - 1][0])) if depth else (_LEAF, len(points))
        if depth:
            a, b = _children(a, b, fan, n)
    found = []
    for i in range(0, len(a), 256):
        x, y = _children(a[i : i + 256], b[i : i + 256], _LEAF, len(points))
        keep = (x != y) & (labels[x] != labels[y])
        x, y = x[keep], y[keep]
        found.append(_bounded(x, y, points, sizes, percent, sketches))
    x = np.concatenate([f[0] for f in found] or [np.zeros(0, np.int64)])
    y = np.concatenate([f[1] for f in found] or [np.zeros(0, np.int64)])
    return order[x], order[y]


def _children(a: np.ndarray, b: np.ndarray, fan: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.divmod(np.arange(fan * fan), fan)
    x, y = (a[:, None] * fan + i).ravel(), (b[:, None] * fan + j).ravel()
    keep = (x < n) & (y < n) & ((np.repeat(a != b, fan * fan)) | (x <= y))
    return x[keep], y[keep]


def _pairs_within(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of each run ``bounds[i]:bounds[i + 1]``."""
    size = np.diff(bounds)
    after = np.repeat(bounds[1:], size) - np.arange(bounds[0], bounds[-1]) - 1  # rows of the run behind each row
    x = np.repeat(np.arange(bounds[0], bounds[-1]), after)
    return x, x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(after) - after, after)


def _spanning(pairs: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Of some pairs of labels, by ascending ``apart``, those that join labels which the ones before them leave apart."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    keep = []
    for i in np.argsort(apart, kind="stable").tolist():
        a, b = top(int(pairs[i, 0])), top(int(pairs[i, 1]))
        if a != b:
            above[a] = b
            keep.append(i)
    return np.array(keep, dtype=np.int64)


def _joined(percent: int, spanning: bool):
    """Pairs of many roots at once: those of small roots together, each larger one through its tree."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["root", "one", "two"])
        points = _points(group["point"].tolist())
        parities = Parities(group["parity"].tolist())
        sketches = parities.sketches()
        ids, labels, chunk, n = (group[c].to_numpy() for c in ("id", "label", "chunk", "n"))
        failed = {(i, j) for i, others in zip(ids.tolist(), group["failed"], strict=True) if others is not None for j in np.asarray(others).tolist()}
        task = group[["root", "one", "two"]].to_numpy()
        cuts = np.r_[0, np.flatnonzero((task[1:] != task[:-1]).any(axis=1)) + 1, len(group)]
        split = group["one"].to_numpy() != group["two"].to_numpy()
        found: dict[tuple[int, int], tuple[int, int, float]] = {}

        def keep(x: np.ndarray, y: np.ndarray) -> None:
            # Pairs within a chunk belong to the task that has the chunk alone.
            use = ~split[x] | (chunk[x] != chunk[y])
            x, y = x[use], y[use]
            for i in range(0, len(x), 1 << 16):
                s, t = x[i : i + (1 << 16)], y[i : i + (1 << 16)]
                differ, total = parities.differ(s, t), n[s] + n[t]
                near = np.flatnonzero((100 + percent) * differ <= (100 - percent) * total)
                if failed:
                    near = np.array([i for i in near.tolist() if (min(ids[s[i]], ids[t[i]]), max(ids[s[i]], ids[t[i]])) not in failed], dtype=np.int64)
                s, t, apart = s[near], t[near], differ[near] / total[near]
                if spanning:
                    first = _spanning(np.stack([labels[s], labels[t]], axis=1), apart)
                    s, t, apart = s[first], t[first], apart[first]
                for p, q, d in zip(s.tolist(), t.tolist(), apart.tolist(), strict=True):
                    a, b = (p, q) if ids[p] < ids[q] else (q, p)
                    found[int(ids[a]), int(ids[b])] = int(labels[a]), int(labels[b]), d

        small = np.diff(cuts) <= _SMALL
        for low, high in zip(cuts[:-1][~small].tolist(), cuts[1:][~small].tolist(), strict=True):
            x, y = tree_join(points[low:high], n[low:high], labels[low:high], percent, sketches[low:high])
            keep(x + low, y + low)
        starts, ends = cuts[:-1][small], cuts[1:][small]
        rows = np.repeat(starts, ends - starts) + np.arange((ends - starts).sum()) - np.repeat(np.cumsum(ends - starts) - (ends - starts), ends - starts)
        bounds = np.r_[0, np.cumsum(ends - starts)]
        for i in range(0, len(starts), 512):
            x, y = _pairs_within(bounds[i : i + 513])
            x, y = rows[x], rows[y]
            use = labels[x] != labels[y]
            keep(*_bounded(x[use], y[use], points, n, percent, sketches))
        pairs = np.array(list(found), dtype=np.int64).reshape(-1, 2)
        if spanning and len(pairs):
            about = np.array(list(found.values()))
            pairs = pairs[_spanning(about[:, :2].astype(np.int64), about[:, 2])]
        return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})

    return run


def _bounded(x: np.ndarray, y: np.ndarray, points: np.ndarray, sizes: np.ndarray, percent: int, sketches: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose sketches do not rule a link out and whose summed coordinate minima reach the overlap it needs.

    Two sets differ in at least as many shingles as their sketches in bits.
    """
    out = []
    for j in range(0, len(x), 16_384):
        s, t = x[j : j + 16_384], y[j : j + 16_384]
        if sketches is not None:
            differ = np.bitwise_count(sketches[s] ^ sketches[t]).sum(axis=1, dtype=np.int64)
            near = (100 + percent) * differ <= (100 - percent) * (sizes[s] + sizes[t])
            s, t = s[near], t[near]
        good = _reach(points[s], points[t], sizes[s], sizes[t], percent)
        out.append((s[good], t[good]))
    none = np.zeros(0, np.int64)
    return np.concatenate([o[0] for o in out] or [none]), np.concatenate([o[1] for o in out] or [none])


def _reach(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int) -> np.ndarray:
    """Whether the summed minima of two corners allow the overlap that sets of these sizes need for a link."""
    return (100 + percent) * np.minimum(a, b).sum(axis=1, dtype=np.int64) >= percent * (size_a + size_b)


# ---- the join -----------------------------------------------------------------------

def _lookup(rows: DataFrame, wanted: DataFrame, k: int, kind: str) -> DataFrame:
    """``id, n`` and what ``kind`` names of the wanted classes, from the texts of their smallest ids."""
    place = F.pmod(F.xxhash64("id"), F.lit(1 << _MAP_BITS)).alias("place")
    made = rows.select("id", "t", place).mapInArrow(_looked_up(k, _id_map(wanted.select(F.col("least").alias("id"))), kind), f"least long, n long, d1 long, d2 long, {_KINDS[kind]}")
    name = ["least", "n", "d1", "d2"]
    found = made.join(wanted, name).dropDuplicates(name)  # of rows that repeat an id and its set, one
    return found.drop("least", "d1", "d2")


def _verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """``a, b, links`` of the pairs of classes: whether their sets link."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = written(classes.join(ids, "id", "left_semi"), "wanted")
    with scratch(_lookup(rows, wanted, k, "sets"), "sets") as sets:
        side = lambda name: sets.select(F.col("id").alias(name), F.col("shingles").alias(f"s{name}"))
        both = pairs.join(side("b"), "b").join(side("a"), "a")
        overlap, total = F.size(F.array_intersect("sa", "sb")), F.size("sa") + F.size("sb")
        checked = written(both.select("a", "b", ((100 + percent) * overlap >= percent * total).alias("links")), "links")
    remove(wanted)
    return checked


def _near(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parities = Parities(batch.column("pa").to_pylist() + batch.column("pb").to_pylist())
            m = batch.num_rows
            differ = parities.differ(np.arange(m), np.arange(m, 2 * m)) if m else np.zeros(0, np.int64)
            total = batch.column("na").to_numpy() + batch.column("nb").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array((100 + percent) * differ <= (100 - percent) * total))

    return run


def _first_links(members: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """One candidate per class: the leader it shares most roots with; a root's leader is its most central member."""
    degree = members.groupBy("id").agg(F.sum(F.col("m") * F.col("w")).alias("degree"))
    leaders = members.join(degree, "id").groupBy("root").agg(F.max_by("id", F.struct("degree", -F.col("id"))).alias("leader"))
    shares = members.join(leaders, "root").where("id <> leader").groupBy("id", "leader").agg(F.sum("w").alias("m"))
    best = shares.groupBy("id").agg(F.max_by("leader", F.struct("m", -F.col("leader"))).alias("a")).select("a", F.col("id").alias("b"))
    side = lambda name: points.select(F.col("id").alias(name), F.col("n").alias(f"n{name}"), F.col("parity").alias(f"p{name}"))
    return best.join(side("b"), "b").join(side("a"), "a").mapInArrow(_near(percent), "a long, b long")


def _across(members: DataFrame, label: DataFrame, points: DataFrame, failed: DataFrame | None, percent: int, spanning: bool) -> DataFrame:
    """Candidate pairs of different components under one root; with ``spanning`` as many as join them in each task."""
    held = members.select("root", "id").join(label.select("id", F.col("root").alias("top")), "id", "left").select("root", "id", F.coalesce("top", "id").alias("label"))
    mixed = held.groupBy("root").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("m")).where("low <> high").select("root", F.ceil(F.col("m") / CHUNK).cast("int").alias("chunks"))
    held = held.join(mixed, "root")
    # Every pair of chunks is a task of its own; a root of one chunk is one.
    held = held.withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int"))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    with scratch(held.select("root", "id", "label", "chunk", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two")), "mixed") as held:
        tasks = held.count() // TASK_ROWS + 1
        near = held.join(points, "id").withColumn("task", F.pmod(F.xxhash64("root", "one", "two"), F.lit(tasks)))
        if failed is None:
            near = near.withColumn("failed", F.lit(None).cast("array<long>"))
        else:
            near = near.join(failed.groupBy(F.col("a").alias("id")).agg(F.collect_set("b").alias("failed")), "id", "left")
        return written(near.groupBy("task").applyInPandas(_joined(percent, spanning), "a long, b long").distinct(), "candidates")


def _labelled(label: DataFrame, links: DataFrame) -> DataFrame:
    """``id, root`` of the classes that have one, after more links."""
    name = lambda col: label.select(F.col("id").alias(col), F.col("root").alias(f"r{col}"))
    lifted = links.join(name("a"), "a", "left").join(name("b"), "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    higher = written(components(lifted), "higher")
    moved = label.join(higher.select(F.col("id").alias("root"), F.col("root").alias("up")), "root", "left").select("id", F.coalesce("up", "root").alias("root"))
    # Roots of before that hang below another one now have a row of their own.
    return written(moved.unionByName(higher).distinct(), "labels")


def jaccard_components(docs: DataFrame, k: int = 3, percent: int = 90, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` of every document; two link when ``100 |x & y| >= percent |x | y|``.

    Words are what lies between ASCII white space after lower-casing A-Z, a set holds the distinct ``k``-word shingles; with
    fewer words the whole sequence is one.  Documents without words (NULL and empty texts too) have 0 shingles and stay alone.
    ``component_id`` is the smallest id reachable over links.  Every row comes back, judged by its own text, also where an id
    repeats; rows without id link with nothing and get a NULL component.  Other columns take no part.  Sets are compared by
    64-bit hashes of their shingles.
    """
    if not 70 <= percent <= 100:
        raise ValueError("neighbouring bands hold all linked sizes from 70 percent up")
    rows = docs.select(F.col(id).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    table = written(rows.mapInArrow(_digested(k), "id long, n long, d1 long, d2 long"), "digests")
    rows = rows.where("id IS NOT NULL")
    # One class per set.
    classes = table.where("id IS NOT NULL AND n > 0").groupBy("d1", "d2", "n").agg(F.min("id").alias("least"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    below = rows.select("t").mapInArrow(_rooted(k, percent), "root long, key long")
    # Counted before they are joined: a root of very many classes is one row of each task, and then a join that Spark can split.
    shared = below.groupBy("root").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low <> high").select("root")
    named = classes.select("id", F.col("d1").bitwiseAND(F.lit((1 << _KEY_BITS) - 1)).alias("key"))
    under = written(below.join(shared, "root", "left_semi").distinct().join(named, "key").select("root", "id"), "under")
    # Copies that differ in few places meet below most of their roots; of roots with the same members one is kept, with their number.
    sizes = under.groupBy("root").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y")).where("m > 1")
    kept = sizes.groupBy("m", "x", "y").agg(F.min("root").alias("root"), F.count("*").alias("w")).select("root", "m", "w")
    members = written(under.join(kept, "root"), "members")
    remove(under)
    wanted = written(classes.join(members.select("id").distinct(), "id", "left_semi"), "wanted")
    points = written(_lookup(rows, wanted, k, "points"), "points")
    checked = _verified(written(_first_links(members, points, percent), "candidates"), rows, classes, k, percent)
    first = roots(checked.where("links").select(F.col("b").alias("id"), F.col("a").alias("parent")))
    # What has been joined, the trees need not look at.
    failed = None
    for turn in range(1, ROUNDS + 1):
        pairs = _across(members, first, points, failed, percent, turn < ROUNDS)
        if pairs.isEmpty():
            break
        checked = _verified(pairs, rows, classes, k, percent)
        first = _labelled(first, checked.where("links"))
        apart = checked.where("NOT links").select("a", "b")
        if apart.isEmpty():
            break
        failed = apart if failed is None else failed.unionByName(apart)
    for done in (members, points, wanted):
        remove(done)
    label = classes.join(first.select("id", F.col("root").alias("r2")), "id", "left").withColumn("r2", F.coalesce("r2", "id"))
    label = label.join(label.groupBy("r2").agg(F.min("least").alias("component")), "r2").select("d1", "d2", "n", "component")
    out = table.select("id", "n", "d1", "d2").join(label, ["d1", "d2", "n"], "left")
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 3, percent: int = 90, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The document of the smallest id of each component, all columns; rows without id or words stay.

    Rows that repeat an id and its text count once; of an id with several texts all stay if one of them leads a component.
    """
    found = written(jaccard_components(docs, k, percent, id, text), "components")
    kept = found.where("doc_id = component_id").groupBy("doc_id").agg(F.count("*").alias("m"))
    repeated = not kept.where("m > 1").isEmpty()
    name = fresh(docs, "_kept")
    # The kept ids grow with the documents, so the join is one that grows with them at every size.
    out = docs.join(kept.select(F.col("doc_id").alias(name)).hint("merge"), F.col(id).cast("long") == F.col(name), "left_semi")
    return (out.dropDuplicates([id, text]) if repeated else out).unionByName(docs.where(F.col(id).isNull()))
