"""Words, shingles and their 64-bit hashes, computed over whole Arrow batches with numpy.

Everything works on the UTF-8 bytes of a batch at once; memory is bounded by ``SLICE`` bytes of text at a time, or by
the longest single document where that is longer.  Hashes are polynomials modulo 2**64 with a random value per byte,
finished by a bijective mixer: equal words always agree on every executor, and different words of one corpus collide
with a chance near 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE = 1 << 20

_U = np.uint64
_BYTE = np.random.default_rng(77).integers(0, 2**64, 256, dtype=np.uint64)
_STEP = 0x9E3779B97F4A7C15
_STEP_INVERSE = pow(_STEP, -1, 2**64)
_PLACES = np.random.default_rng(78).integers(0, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE), base, dtype=np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if n <= SLICE:
            _POWERS[base] = have
    return have


#: The ASCII white space that separates words where only white space does.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Every ASCII byte but letters and digits separates.
PUNCTUATION = np.array([not (chr(b).isalnum()) if b < 128 else False for b in range(256)])
#: Lower case of A-Z; other bytes stay.
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row + 1, bytes, offsets)`` of runs of rows of at most ``limit`` bytes, one row at least.

    NULL rows must have been filled; ``offsets`` are relative to ``bytes``.
    """
    if len(column) == 0:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        yield low, high, flat[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def fold_latin(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the two-byte Latin-1 capitals."""
    out = LOWER[data]
    capital = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1 if len(data) > 1 else []
    out[capital] += 32
    return out


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, start, end)`` of every maximal run of bytes that are no separators, in order."""
    inside = ~separators[data]
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    if len(data):
        before[0] = after[-1] = False
        before[edges] = False
        after[edges - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    return np.searchsorted(offsets, start, side="right") - 1, start, end


def hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes ``start:end``."""
    out = np.empty(len(start), dtype=np.uint64)
    low = 0
    while low < len(start):
        high = max(low + 1, int(np.searchsorted(end, start[low] + SLICE, side="right")))
        base, stop = start[low], end[high - 1]
        sums = np.zeros(stop - base + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[base:stop]] * _powers(_STEP, stop - base)[: stop - base], out=sums[1:])
        at = start[low:high] - base
        out[low:high] = (sums[end[low:high] - base] - sums[at]) * _powers(_STEP_INVERSE, stop - base)[at]
        low = high
    return mix(out)


def shingles(hashes: np.ndarray, rows: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, hash, first word)`` of each run of ``k`` words of one row.

    With ``short``, a row of fewer words, but one at least, gives its whole sequence as one shingle.
    """
    n = len(hashes)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    m = max(0, n - k + 1)
    total = np.zeros(m, dtype=np.uint64)
    for j in range(k):
        total += hashes[j : j + m] * _PLACES[j]
    whole = np.flatnonzero(rows[:m] == rows[k - 1 : k - 1 + m])
    row, value, at = rows[whole], mix(total[whole]), whole
    if short and k > 1:
        first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        count = np.diff(np.r_[first, n])
        few = count < k
        first, count = first[few], count[few]
        if len(first):
            part = np.zeros(len(first), dtype=np.uint64)
            for j in range(k - 1):
                has = count > j
                part[has] += hashes[first[has] + j] * _PLACES[j]
            part += count.astype(np.uint64) * _PLACES[-1]
            row, value, at = np.r_[row, rows[first]], np.r_[value, mix(part)], np.r_[at, first]
            order = np.argsort(row, kind="stable")
            row, value, at = row[order], value[order], at[order]
    return row, value, at


def distinct(rows: np.ndarray, values: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct ``values`` of each row, end to end, and the ``n_rows + 1`` bounds of the rows; ``rows`` ascend."""
    bounds = np.searchsorted(rows, np.arange(n_rows + 1))
    out = values.copy()
    for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        out[low:high].sort()
    keep = np.ones(len(out), dtype=bool)
    keep[1:] = (out[1:] != out[:-1]) | (rows[1:] != rows[:-1])
    counts = np.r_[0, np.cumsum(keep)]
    return out[keep], counts[bounds]
