"""Approximate nearest neighbours in an inverted multi-index.

The two halves of a vector are quantised separately against a codebook each; the pair of centroids is the vector's cell.  A query
ranks the centroids of either half by distance and walks their pairs by summed distance with a heap, until the cells met hold
enough entries.  Those are reranked by exact distance in double precision.

The codebooks are fitted on at most ``SAMPLE`` vectors; every vector is indexed.  Cells are packed into parts of bounded size, cells
beyond that are cut into several by a hash of the row, and a part meets only the queries that reach one of its cells, in blocks
of bounded size.  So each task holds a bounded number of vectors and of queries, and a cell of any size is searched whole.

The work is queries times the candidates each reranks.  Where queries are a share of all rows and candidates too, that grows with the
square of the table; ``share`` is for the caller to set by the recall that the data needs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.shared import written

#: Vectors the codebooks are fitted on, those of the smallest hashed ids.
SAMPLE = 20_000
#: Entries of an average cell that sets the codebook size, and the largest codebook: cells then number at most its square.
CELL_ENTRIES, LARGEST_CODEBOOK = 1, 1_024
#: Vectors that one task holds.
PART_ENTRIES = 20_000
#: Queries that one task holds.
BLOCK_QUERIES = 4_000
_ROUNDS = 15


def usable(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the vectors that take part: not NULL or zero, all components finite, of the most common length."""
    rows = vectors.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).where("vec_id IS NOT NULL AND size(v) > 0")
    finite = F.forall("v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common.n if common else 0))


# ---- codebooks ----------------------------------------------------------------------

@dataclass(frozen=True)
class Codebooks:
    left: np.ndarray
    right: np.ndarray

    @property
    def cut(self) -> int:
        return self.left.shape[1]

    def cells(self, v: np.ndarray) -> np.ndarray:
        return _nearest(v[:, : self.cut], self.left) * len(self.right) + _nearest(v[:, self.cut :], self.right)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    if not x.shape[1]:
        return np.zeros(len(x), dtype=np.int64)
    return np.concatenate([((centres**2).sum(1) - 2 * x[i : i + 4096] @ centres.T).argmin(1) for i in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


def _codebook(x: np.ndarray, k: int) -> np.ndarray:
    """Lloyd's rounds from distinct starting points."""
    distinct = np.unique(x, axis=0)
    rng = np.random.default_rng(5)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(_ROUNDS):
        at = _nearest(x, centres)
        count = np.bincount(at, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, at, x)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def fit(vectors: DataFrame, count: int) -> Codebooks:
    """Codebooks for ``count`` vectors, fitted on the ``SAMPLE`` of smallest hashed id."""
    rows = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    x = np.array([r.v for r in rows], dtype=np.float64)
    k = int(min(LARGEST_CODEBOOK, max(1, round((count / CELL_ENTRIES) ** 0.5))))
    half = x.shape[1] // 2
    return Codebooks(_codebook(x[:, :half], k), _codebook(x[:, half:], k))


# ---- traversal ----------------------------------------------------------------------

def traverse(left: np.ndarray, right: np.ndarray, counts: np.ndarray, want: int) -> tuple[list[int], float]:
    """Non-empty cells by summed distance of their centroids until they hold ``want`` entries, or all; and the last sum.

    ``left`` and ``right`` are a query's squared distances to the centroids, ``counts`` the entries of each cell.  The heap holds
    the next pair of each row of the sorted grid, and a row is opened when the one before it has given its first pair.
    """
    order = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    la, rb = left[order[0]].tolist(), right[order[1]].tolist()
    a, b = order[0].tolist(), order[1].tolist()
    heap, out, held, n, reach = [(la[0] + rb[0], 0, 0)], [], 0, len(rb), 0.0
    while heap and held < want:
        reach, i, j = heapq.heappop(heap)
        cell = a[i] * n + b[j]
        if entries := int(counts[cell]):
            out.append(cell)
            held += entries
        if j + 1 < n:
            heapq.heappush(heap, (la[i] + rb[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(la):
            heapq.heappush(heap, (la[i + 1] + rb[0], i + 1, 0))
    return out, reach


def _indexed(books: Codebooks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in v], pa.binary()), pa.array(books.cells(v))], ["row", "vec_id", "v", "cell"])

    return run


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _distances(books: Codebooks, q: np.ndarray) -> list[np.ndarray]:
    """Squared distances of the halves of some queries to the centroids."""
    return [((x[:, None, :] - c[None]) ** 2).sum(2) for x, c in ((q[:, : books.cut], books.left), (q[:, books.cut :], books.right))]


def _probed(books: Codebooks, counts: np.ndarray, first: np.ndarray, pieces: np.ndarray, want: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float64).reshape(batch.num_rows, -1)
            for lo in range(0, len(v), 64):
                at, parts, reaches = [], [], []
                left, right = _distances(books, v[lo : lo + 64])
                for k in range(len(left)):
                    cells, reach = traverse(left[k], right[k], counts, want)
                    reached = {p for c in cells for p in range(first[c], first[c] + pieces[c])}
                    at += [lo + k] * len(reached)
                    parts += sorted(reached)
                    reaches += [reach] * len(reached)
                rows = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(rows) for i in range(3)), pa.array(parts, pa.int64()), pa.array(reaches, pa.float64())], ["query", "query_id", "q", "part", "reach"])

    return run


def _reranked(books: Codebooks, k: int):
    def run(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        """The nearest of a part's entries; a query's cells are those whose centroids are as near as the last it walked to."""
        out = []
        if len(entries) and len(queries):
            v = np.frombuffer(b"".join(entries["v"]), np.float64).reshape(len(entries), -1)
            ids, rows = entries["vec_id"].to_numpy(), entries["row"].to_numpy()
            i, j = np.divmod(entries["cell"].to_numpy(), len(books.right))
            for query, name, q, reach in zip(queries["query"], queries["query_id"], queries["q"], queries["reach"], strict=True):
                q = np.frombuffer(q, np.float64)
                left, right = (d[0] for d in _distances(books, q[None]))
                at = np.flatnonzero((left[i] + right[j] <= reach) & (rows != query))
                score = np.sqrt(((v[at] - q) ** 2).sum(1))
                best = np.lexsort((ids[at], score))[:k]
                out.append(pd.DataFrame({"query": query, "query_id": name, "vec_id": ids[at][best], "score": score[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query": np.zeros(0, np.int64), "query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})

    return run


# ---- search -------------------------------------------------------------------------

def _parts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First part of each cell and the number of parts it is cut into; small cells share parts."""
    pieces = np.maximum(1, -(-counts // PART_ENTRIES))
    first, part, held = np.zeros(len(counts), np.int64), 0, 0
    for cell in np.flatnonzero(counts).tolist():
        if held and held + counts[cell] > PART_ENTRIES:
            part, held = part + 1, 0
        first[cell] = part
        held += int(counts[cell])
        if pieces[cell] > 1:
            part, held = part + int(pieces[cell]), 0
    return first, pieces


def nearest(vectors: DataFrame, is_query, k: int = 10, candidates: int = 2_000, share: float = 0.4, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found for each row where ``is_query`` (over ``vec_id``) holds.

    A query reranks the entries of the nearest cells that together hold ``candidates`` vectors, or ``share`` of all where that is
    more (nearness of random vectors is hard to index: 0.4 finds 19 of 20 neighbours among them).  Score is the Euclidean distance; ties go to the smaller id.  Vectors that are NULL, zero, of another length than
    most or not finite take no part.  Rows that repeat id and vector are one row; rows that share an id with different vectors are
    different rows, each a candidate and, where the id is a query's, a query with ranks of its own.  Queries find all others if
    there are fewer than ``k``.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors, id, vector).distinct().select(F.monotonically_increasing_id().alias("row"), "vec_id", "v"), "vectors")
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    books = fit(rows, total)
    entries = written(rows.mapInArrow(_indexed(books), "row long, vec_id long, v binary, cell long"), "cells")
    counts = np.zeros(len(books.left) * len(books.right), dtype=np.int64)
    for r in entries.groupBy("cell").count().collect():  # LARGEST_CODEBOOK squared rows at most
        counts[r.cell] = r["count"]
    first, pieces = _parts(counts)
    want = max(candidates, int(total * share), k) + 1
    asked = entries.where(is_query(F.col("vec_id"))).select("row", "vec_id", "v")
    blocks = -(-asked.count() // BLOCK_QUERIES) or 1
    probes = asked.mapInArrow(_probed(books, counts, first, pieces, want), "query long, query_id long, q binary, part long, reach double")
    probes = probes.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    place = spark.createDataFrame(pd.DataFrame({"cell": np.flatnonzero(counts), "first": first[counts > 0], "pieces": pieces[counts > 0]}))
    dealt = entries.join(place, "cell").withColumn("part", F.col("first") + F.pmod(F.xxhash64("row"), F.col("pieces"))).select("row", "vec_id", "v", "cell", "part")
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = dealt.groupBy("part", "block").cogroup(probes.groupBy("part", "block")).applyInPandas(_reranked(books, k), "query long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
