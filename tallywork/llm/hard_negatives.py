"""Hard negatives through rotated one-bit codes.

Vectors hold integers.  A fixed random rotation spreads each over all coordinates, and the signs of the rotated vector ``y`` are its
code, the unit vector ``o`` of equal magnitudes in its direction.  Stored with it are the alignment ``a = <y, o>`` and the length of
what the code leaves over, ``r = |y - a o|``.  What is left over is coded by its own signs in turn, ``LEVELS`` times: a bit a
component each, and about 0.6 of the length left by each.

An anchor's rotated vector ``q`` is cut to a few bits, so every ``s = <q, o>`` is a sum of popcounts, known up to the length ``e`` of
the rounding error.  The rest is orthogonal to the last code, so by Cauchy and Schwarz the score is certain to lie within
``sum(a e) + r sqrt(|q|^2 - s^2)`` of ``sum(a s)``.  Level by level, rows whose interval cannot reach the anchor's result are passed
over; the others are scored in integers.  The intervals are certain, so the result is exact whatever the data.

Rows and anchors are dealt in blocks of bounded size; every pair of a row block and an anchor block is one group, which returns the
best few of each anchor, and a window merges the blocks.  Positives are searched among the blocks of one label, so a label that holds
most rows is many blocks.  The work is anchors times rows, as asked for, but mostly on codes of a 64th of a vector's bytes a level.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.shared import written

#: Components of the rows, and of the anchors, that one task holds; one vector at least.
ROW_COMPONENTS, ANCHOR_COMPONENTS = 1 << 19, 1 << 18
#: One-bit codes of a vector, each of what the ones before it leave over.
LEVELS = 4
#: Bits to which an anchor's rotated components are cut.
PLANES = 8
_SIGNS = np.random.default_rng(4)
_FLIPS = [_SIGNS.integers(0, 2, 1 << 16) * 2.0 - 1 for _ in range(3)]
_CODED = "row long, id long, label long, dim int, v binary, code binary, sides binary, anchor boolean"


def rotate(x: np.ndarray) -> np.ndarray:
    """Rows of ``x`` padded to a power of two of components and turned: thrice random signs and a Hadamard transform."""
    n, dim = x.shape
    wide = max(64, 1 << max(0, dim - 1).bit_length())
    y = np.zeros((n, wide))
    y[:, :dim] = x
    for flips in _FLIPS:
        y *= np.resize(flips, wide)
        step = 1
        while step < wide:
            pairs = y.reshape(n, wide // (2 * step), 2, step)
            y = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, wide)
            step *= 2
        y /= np.sqrt(wide)
    return y


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes as 64-bit words, and alignment and length left over, by row and level."""
    rest = rotate(x)
    n, wide = rest.shape
    codes, sides = np.zeros((n, LEVELS, wide // 64), dtype=np.uint64), np.zeros((n, LEVELS, 2))
    for j in range(LEVELS):
        signs = rest >= 0
        align = np.abs(rest).sum(axis=1) / np.sqrt(wide)
        rest = rest - np.where(signs, 1.0, -1.0) * (align / np.sqrt(wide))[:, None]
        codes[:, j] = np.packbits(signs, axis=1, bitorder="little").view(np.uint64)
        sides[:, j, 0], sides[:, j, 1] = align, np.sqrt((rest**2).sum(axis=1))
    return codes, sides


class Asked:
    """A query as bit planes, and what popcounts say of its scores."""

    def __init__(self, query: np.ndarray) -> None:
        y = rotate(query[None, :])[0]
        self.wide, self.length = len(y), float(np.sqrt((query.astype(np.float64) ** 2).sum()))
        self.low = float(y.min())
        self.step = (float(y.max()) - self.low) / ((1 << PLANES) - 1) or 1.0
        cut = np.rint((y - self.low) / self.step).astype(np.int64)
        self.total = int(cut.sum())
        self.error = float(np.sqrt(((y - self.low - self.step * cut) ** 2).sum()))
        self.planes = [np.packbits((cut >> j) & 1 == 1, bitorder="little").view(np.uint64) for j in range(PLANES)]

    def with_code(self, codes: np.ndarray) -> np.ndarray:
        """Inner products with codes, off by ``error`` at most."""
        ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
        common = np.zeros(len(codes), dtype=np.int64)
        for j, plane in enumerate(self.planes):
            common += np.bitwise_count(codes & plane).sum(axis=1, dtype=np.int64) << j
        return (self.low * (2 * ones - self.wide) + self.step * (2 * common - self.total)) / np.sqrt(self.wide)

    def narrowed(self, codes: np.ndarray, sides: np.ndarray, at: np.ndarray, wanted: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The rows of ``at`` that ``wanted(low, high)`` keeps, asked at each level with narrower bounds of their scores, and the last bounds."""
        middle, off, low, high = (np.zeros(len(at)) for _ in range(4))
        for j in range(LEVELS):
            align, rest = sides[at, j, 0], sides[at, j, 1]
            s = self.with_code(codes[at, j])
            middle, off = middle + align * s, off + align * self.error
            across = np.sqrt(np.maximum(0.0, self.length**2 - np.maximum(0.0, np.abs(s) - self.error) ** 2))
            # Room for what floating point rounds off.
            reach = off + rest * across + 1e-9 * self.length * (rest + np.abs(align)) + 1e-9 * np.abs(middle) + 1e-6
            low, high = middle - reach, middle + reach
            keep = wanted(low, high)
            at, middle, off, low, high = at[keep], middle[keep], off[keep], low[keep], high[keep]
        return at, low, high


def _scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    return (vectors * query).sum(axis=1, dtype=np.int64)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids."""
    return np.lexsort((ids, -scores))[:k]


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, id_, label, vector, anchor = (batch.column(i) for i in range(5))
        sizes = np.diff(vector.offsets.to_numpy())
        flat = np.floor(256 * vector.flatten().to_numpy().astype(np.float64))
        bounds = np.r_[0, np.cumsum(sizes)]
        for dim in np.unique(sizes).tolist():
            at = np.flatnonzero(sizes == dim)
            x = flat[bounds[at][:, None] + np.arange(dim)]
            if len(x) and not (x**2).sum(axis=1).max(initial=0.0) < 2.0**62:
                raise ValueError("scores of these vectors could leave 64 bits")
            codes, sides = encode(x)
            take = lambda c: c.take(pa.array(at))  # noqa: E731, B023
            yield pa.RecordBatch.from_arrays(
                [
                    take(row), take(id_), take(label), pa.array(np.full(len(at), dim, np.int32)), pa.array([v.tobytes() for v in x.astype("<i8")], pa.binary()),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([c.tobytes() for c in sides], pa.binary()), take(anchor),
                ],
                ["row", "id", "label", "dim", "v", "code", "sides", "anchor"],
            )


def _block(rows: pd.DataFrame, anchors: pd.DataFrame) -> tuple[np.ndarray, ...]:
    dim = int(rows["dim"].iloc[0])
    held = np.frombuffer(b"".join(rows["v"]), dtype="<i8").reshape(len(rows), dim)
    asked = np.frombuffer(b"".join(anchors["v"]), dtype="<i8").reshape(len(anchors), dim)
    codes = np.frombuffer(b"".join(rows["code"]), dtype=np.uint64).reshape(len(rows), LEVELS, -1)
    return held, asked, codes, np.frombuffer(b"".join(rows["sides"])).reshape(len(rows), LEVELS, 2)


def _least_of_best(low: np.ndarray, k: int) -> float:
    """A score that ``k`` rows are certain to reach."""
    return float(np.partition(low, -k)[-k]) if len(low) >= k else -np.inf


def _sifted(at: np.ndarray, low: np.ndarray, high: np.ndarray, bands: list[tuple[float, float]], vectors: np.ndarray, query: np.ndarray, k: int) -> np.ndarray:
    """The rows that may be among the ``k`` best of a band once the likeliest have been scored."""
    use = np.zeros(len(at), dtype=bool)
    for floor, top in bands:
        fits = np.flatnonzero((low <= top) & (high >= floor))
        middle = (low[fits] + high[fits]) / 2
        likely = fits[np.argsort(np.where(middle <= top, -middle, middle), kind="stable")[: 8 * k]]
        scores = _scores(vectors[at[likely]], query)
        least = _least_of_best(scores[(scores >= floor) & (scores <= top)], k)
        use[fits[high[fits] >= least]] = True
    return at[use]


def _positives(k: int):
    """The ``k`` best rows of the block for each anchor of the same label, itself left out."""
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int]] = []
        if len(rows) and len(anchors):
            held, asked, codes, sides = _block(rows, anchors)
            numbers, ids = rows["row"].to_numpy(), rows["id"].to_numpy()
            for number, query in zip(anchors["row"].tolist(), asked, strict=True):
                at, low, high = Asked(query).narrowed(codes, sides, np.flatnonzero(numbers != number), lambda low, high: high >= _least_of_best(low, k))
                at = _sifted(at, low, high, [(-np.inf, np.inf)], held, query, k)
                scores = _scores(held[at], query)
                best = _first(scores, ids[at], k)
                out += [(number, *found) for found in zip(numbers[at[best]].tolist(), ids[at[best]].tolist(), scores[best].tolist(), strict=True)]
        return pd.DataFrame(out, columns=["anchor", "positive", "positive_id", "positive_score"], dtype="int64")

    return run


def _in_bands(bands: list[tuple[int, int]], k: int):
    """Whether a row may be among the ``k`` best of a band."""
    def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        use = np.zeros(len(low), dtype=bool)
        for floor, top in bands:
            inside = low[(low >= floor) & (high <= top)]
            use |= (low <= top) & (high >= max(floor, _least_of_best(inside, k)))
        return use

    return wanted


def _negatives(k: int, low_percent: int, high_percent: int):
    """The ``k`` best rows of other labels in the band below each positive of each anchor."""
    def run(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int, int, int, int]] = []
        if len(rows) and len(anchors):
            held, asked, codes, sides = _block(rows, anchors)
            ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
            for number, label, query, positives, wanted in zip(anchors["row"].tolist(), anchors["label"].tolist(), asked, anchors["positives"], anchors["scores"], strict=True):
                # low_percent * positive <= 100 * negative <= high_percent * positive, in whole numbers.
                bands = {s: (-(-low_percent * s // 100), high_percent * s // 100) for s in map(int, wanted)}
                open_ = [band for band in bands.values() if band[0] <= band[1]]
                at, low, high = Asked(query).narrowed(codes, sides, np.flatnonzero(labels != label), _in_bands(open_, k))
                at = _sifted(at, low, high, open_, held, query, k)
                scores = _scores(held[at], query)
                for positive, score in zip(map(int, positives), map(int, wanted), strict=True):
                    floor, top = bands[score]
                    fits = np.flatnonzero((scores >= floor) & (scores <= top))
                    best = fits[_first(scores[fits], ids[at[fits]], k)]
                    out += [(number, positive, score, *found) for found in zip(ids[at[best]].tolist(), scores[best].tolist(), strict=True)]
        return pd.DataFrame(out, columns=["anchor", "positive", "positive_score", "negative_id", "negative_score"], dtype="int64")

    return run


def hard_negatives(
    vectors: DataFrame, is_anchor: Callable[[Column], Column], n_positives: int = 5, n_negatives: int = 3, low_percent: int = 50, high_percent: int = 95,
    id: str = "vec_id", vector: str = "embedding", label: Column | str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for each positive of each anchor.

    Components become ``floor(256 * x)``; a score is an inner product of such integers.  An anchor's positives are its
    ``n_positives`` best other rows of its label, the negatives of a positive the ``n_negatives`` best rows of other labels whose
    score lies between the two percentages of the positive's.  Higher scores come first, then smaller ids; fewer come back where
    fewer exist, and none below a negative positive score.

    Rows whose id, label, vector or any component is NULL or not finite take no part.  Rows that repeat id, label and vector are
    one row; rows that share an id but differ in label or vector are different rows.  Vectors score only against those of as many
    components.  An empty table gives no rows; other columns take no part.  Scores beyond 64 bits raise an error.
    """
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(F.col(id).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("x"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).where(~F.exists("x", bad)).distinct()
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", "x", is_anchor(F.col("id")).alias("anchor"))
    coded = written(rows.mapInArrow(_coded, _CODED), "codes")
    anchors = coded.where("anchor").select("row", "id", "label", "dim", "v")

    def joined(asked: DataFrame, by: list[str], function, schema: str) -> DataFrame:
        sizes = coded.groupBy(*by).agg(F.count("*").alias("n"), F.count_if("anchor").alias("m")).where("m > 0")
        blocks = lambda n, most: F.ceil(F.col(n) * F.greatest(F.lit(1), "dim") / F.lit(float(most))).cast("int").alias(n)
        sizes = sizes.select(*by, blocks("n", ROW_COMPONENTS), blocks("m", ANCHOR_COMPONENTS))
        place = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        held = coded.drop("anchor").join(sizes, by).withColumn("one", place("n")).withColumn("two", every("m")).drop("n", "m")
        # Columns of their own, or Spark cannot tell the sides apart.
        asked = asked.toDF(*asked.columns).join(sizes.toDF(*sizes.columns), by).withColumn("two", place("m")).withColumn("one", every("n")).drop("n", "m")
        keys = [*by, "one", "two"]
        return held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(function, schema)

    def top(df: DataFrame, keys: list[str], score: str, least: str, k: int) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), least))).where(F.col("rank") <= k)

    found = joined(anchors, ["dim", "label"], _positives(n_positives), "anchor long, positive long, positive_id long, positive_score long")
    positives = written(top(found, ["anchor"], "positive_score", "positive_id", n_positives).drop("rank"), "positives")
    lists = positives.groupBy("anchor").agg(F.collect_list(F.struct("positive", "positive_score")).alias("p"))  # n_positives at most
    asked = anchors.join(lists, F.col("row") == F.col("anchor")).select("row", "id", "label", "dim", "v", F.col("p.positive").alias("positives"), F.col("p.positive_score").alias("scores"))
    found = joined(asked, ["dim"], _negatives(n_negatives, low_percent, high_percent), "anchor long, positive long, positive_score long, negative_id long, negative_score long")
    best = top(found, ["anchor", "positive"], "negative_score", "negative_id", n_negatives)
    names = positives.select("anchor", "positive", "positive_id")
    best = best.join(names, ["anchor", "positive"]).join(anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
