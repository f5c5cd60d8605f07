"""Token ids as directly addressable codes: binary files with random access to any token.

An id is split into chunks of 8 or 16 bits.  Level 0 holds the lowest chunk of every id, level ``l`` the next chunk of
those ids that need one.  Each level has a bitmap that says which of its entries continue, and a rank directory with the
number of set bits before every 512th entry.  Entry ``i`` of a level continues at entry ``rank(i)`` of the next, so one id is
read from a few bytes of each level without decoding a block.

A file is ``MAGIC``, a header, the documents (id, NULL flag, first position) and the codes.  Documents stand in ascending
``doc_id`` order, NULL ids first, equal ids by text; files follow each other in the same order.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywork.llm.shared import new_folder, written

MAGIC = b"DACTOK01"
#: Bits of the chunks, lowest first; together at least the 32 of an id.
WIDTHS = (8, 8, 16)
#: A file ends with the document that brings it to this many ids.
FILE_TOKENS = 4_000_000
#: Words whose ids a worker remembers, about; beyond that it forgets those it met once.
REMEMBERED = 600_000

_BLOCK = 512
_POPCOUNT = np.array([bin(x).count("1") for x in range(256)], dtype=np.uint8)


# ---- codes --------------------------------------------------------------------------

def encode(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """The codes of an array of 32-bit ids."""
    if sum(widths) < 32 or any(w not in (8, 16) for w in widths):
        raise ValueError("chunks have 8 or 16 bits, 32 together at least")
    parts, rest = [], ids.astype(np.uint64)
    for width in widths:
        more = rest >> np.uint64(width)
        goes_on = more > 0
        bitmap = np.packbits(goes_on, bitorder="little")
        blocks = np.r_[0, np.cumsum(np.add.reduceat(goes_on, np.arange(0, len(rest), _BLOCK), dtype=np.uint32) if len(rest) else [])]
        chunk = (rest & np.uint64(2**width - 1)).astype(f"<u{width // 8}")
        parts.append(struct.pack("<BQ", width, len(rest)) + chunk.tobytes() + bitmap.tobytes() + blocks.astype("<u4").tobytes())
        rest = more[goes_on]
        if not len(rest):
            break
    return struct.pack("<B", len(parts)) + b"".join(parts)


class Codes:
    """Reads codes: ``codes[i]`` touches a few bytes, ``all()`` decodes every id."""

    def __init__(self, data: bytes | memoryview):
        self._levels = []
        at = 1
        for _ in range(data[0]):
            width, n = struct.unpack_from("<BQ", data, at)
            at += 9
            chunk = np.frombuffer(data, f"<u{width // 8}", n, at)
            at += n * width // 8
            bitmap = np.frombuffer(data, np.uint8, -(-n // 8), at)
            at += len(bitmap)
            blocks = np.frombuffer(data, "<u4", -(-n // _BLOCK) + 1, at)
            at += 4 * len(blocks)
            self._levels.append((width, chunk, bitmap, blocks))

    def __len__(self) -> int:
        return len(self._levels[0][1])

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        value = shift = 0
        for width, chunk, bitmap, blocks in self._levels:
            value |= int(chunk[i]) << shift
            shift += width
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            start = i // _BLOCK * _BLOCK
            whole = bitmap[start >> 3 : i >> 3]
            i = int(blocks[i // _BLOCK]) + int(_POPCOUNT[whole].sum()) + int(_POPCOUNT[bitmap[i >> 3] & ((1 << (i & 7)) - 1)])
        return value

    def all(self) -> np.ndarray:
        out = np.zeros(len(self), dtype=np.uint32)
        at, shift = None, 0
        for width, chunk, bitmap, _ in self._levels:
            values = chunk.astype(np.uint32) << np.uint32(shift)
            goes_on = np.flatnonzero(np.unpackbits(bitmap, bitorder="little")[: len(chunk)])
            if at is None:
                out, at = values, goes_on
            else:
                out[at] |= values
                at = at[goes_on]
            shift += width
        return out


def pack_file(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    starts = np.r_[0, np.cumsum(lengths)].astype("<i8")
    return b"".join((
        MAGIC, struct.pack("<Q", len(doc_ids)), np.array([x is None for x in doc_ids], dtype=np.uint8).tobytes(),
        np.array([x or 0 for x in doc_ids], dtype="<i8").tobytes(), starts.tobytes(), encode(ids),
    ))


def unpack_file(data: bytes) -> tuple[list[int | None], np.ndarray, Codes]:
    """Document ids, their ``n + 1`` first positions, and the codes of a file."""
    if data[: len(MAGIC)] != MAGIC:
        raise ValueError("not a token file")
    n, at = struct.unpack_from("<Q", data, len(MAGIC))[0], len(MAGIC) + 8
    missing = np.frombuffer(data, np.uint8, n, at)
    keys = np.frombuffer(data, "<i8", n, at + n)
    starts = np.frombuffer(data, "<i8", n + 1, at + 9 * n)
    return [None if m else k for k, m in zip(keys.tolist(), missing.tolist(), strict=True)], starts, Codes(memoryview(data)[at + 17 * n + 8 :])


# ---- tokenizer ----------------------------------------------------------------------

class Encoder:
    """Ids of whole texts under a tokenizer file, equal to the library's own call without special tokens.

    Where the tokenizer splits at white space and marks word ends, a text's ids are its words' ids end to end; those of words
    met before are remembered.  Texts that such a split could change (special tokens spelt out, control characters that only
    Python takes as white space) and other tokenizers are encoded whole by the library.
    """

    _SAFE = regex.compile(r"[\x20-\x7e¡-ÿ]+")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark already runs a worker a core
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self._tokenizer.to_str())
        self._special = [x["content"] for x in spec["added_tokens"]]
        suffix = spec["model"].get("end_of_word_suffix")
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = next((x for x in steps if x["type"] == "Split" and x["behavior"] == "Removed" and x["invert"]), None)
        kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
        self._by_word = bool(suffix and split and kinds == ["NFC", "Replace", "Lowercase"] and r"[^\s" in split["pattern"].get("Regex", ""))
        if self._by_word:
            self._piece = regex.compile(split["pattern"]["Regex"])
            self._ends = np.zeros(self._tokenizer.get_vocab_size(), dtype=bool)
            self._ends[[i for token, i in spec["model"]["vocab"].items() if token.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self._index: dict[str, int] = {}
        self._starts, self._ids, self._again = np.zeros(1, np.int64), np.zeros(0, np.uint32), np.zeros(0, bool)

    def _keep_frequent(self) -> None:
        """Forget the words that were met only once, or all if the others are too many."""
        words = [w for w, again in zip(self._index, self._again.tolist(), strict=True) if again]
        if len(words) > REMEMBERED // 2:
            self._forget()
            return
        lengths = np.diff(self._starts)
        self._ids = self._ids[np.repeat(self._again, lengths)]
        self._starts = np.r_[0, np.cumsum(lengths[self._again])]
        self._index = dict(zip(words, range(len(words)), strict=True))
        self._again = np.zeros(len(words), bool)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> None:
        """Remember the ids of words not met before."""
        plain, odd = [], []
        counts = []  # pieces of each plain word
        for w in words:
            if w.isascii() and w.isalpha():
                plain.append(w)
                counts.append(1)
            elif self._SAFE.fullmatch(w):
                plain.append(w)
                counts.append(len(self._piece.findall(w)))
            else:
                odd.append(w)
        found = self._whole([" ".join(plain[k : k + 1000]) for k in range(0, len(plain), 1000)])
        flat = np.concatenate([np.zeros(0, np.uint32), *(np.array(x, np.uint32) for x in found)])
        ends = np.flatnonzero(self._ends[flat]) + 1
        last = np.cumsum(counts, dtype=np.int64)
        if len(ends) != (last[-1] if len(last) else 0):
            plain, odd, flat = [], words, flat[:0]
            stops = np.zeros(0, np.int64)
        else:
            stops = np.r_[0, ends][last]
        other = self._whole(odd)
        lengths = np.r_[np.diff(np.r_[0, stops]), np.fromiter(map(len, other), np.int64, len(other))].astype(np.int64)
        base = len(self._index)
        self._index.update(zip(plain + odd, range(base, base + len(words)), strict=True))
        self._ids = np.r_[self._ids, flat, np.fromiter((i for x in other for i in x), np.uint32)]
        self._starts = np.r_[self._starts, self._starts[-1] + np.cumsum(lengths)]
        self._again = np.r_[self._again, np.zeros(len(words), bool)]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and their number for each text."""
        if not self._by_word:
            out = self._whole(texts)
            return np.fromiter((i for x in out for i in x), np.uint32), np.fromiter(map(len, out), np.int64, len(out))
        words: list[str] = []
        ends, whole = [], {}
        for k, text in enumerate(texts):
            if any(c in text for c in "\x1c\x1d\x1e\x1f") or "<" in text and any(s in text for s in self._special):
                whole[k] = text
            else:
                if text.isascii() or _latin(text):
                    text = text.lower()
                words += text.split()
            ends.append(len(words))
        if len(self._index) > REMEMBERED:
            self._keep_frequent()
        at = np.fromiter(map(self._index.get, words, repeat(-1)), np.int64, len(words))
        self._again[at[at >= 0]] = True
        if (unseen := np.flatnonzero(at < 0)).size:
            self._learn(list(dict.fromkeys(words[i] for i in unseen.tolist())))
            at[unseen] = [self._index[words[i]] for i in unseen.tolist()]
        lengths = self._starts[at + 1] - self._starts[at]
        stops = np.cumsum(lengths)
        flat = self._ids[np.repeat(self._starts[at] - (stops - lengths), lengths) + np.arange(stops[-1] if len(stops) else 0)]
        stops = np.r_[0, stops][ends] if ends else np.zeros(0, np.int64)
        if not whole:
            return flat, np.diff(np.r_[0, stops])
        parts, low = [], 0
        direct = dict(zip(whole, self._whole(list(whole.values())), strict=True))
        for k, high in enumerate(stops.tolist()):
            parts.append(np.array(direct[k], np.uint32) if k in direct else flat[low:high])
            low = high
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)


def _latin(text: str) -> bool:
    """Whether lower case of every letter is the one both Python and the tokenizer give."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# ---- Spark --------------------------------------------------------------------------

def _groups(batches: Iterator[pa.RecordBatch], chars: int = 1 << 21) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of consecutive rows, about ``chars`` characters at a time."""
    for batch in batches:
        keys, texts, held = [], [], 0
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            keys.append(key)
            texts.append(text)
            held += len(text)
            if held >= chars:
                yield keys, texts
                keys, texts, held = [], [], 0
        if keys:
            yield keys, texts


def _writer(folder: str, tokenizer: str, end_id: int, file_tokens: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = pafs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        encode_texts = encoder(tokenizer)
        seq, keys, lengths, ids = 0, [], [], []

        def flush() -> pa.RecordBatch:
            nonlocal seq, keys, lengths, ids
            flat, counts = np.concatenate(ids), np.concatenate(lengths)
            name = f"tokens-{task.partitionId():07d}-{seq:06d}-{task.taskAttemptId()}.dac"
            with store.open_output_stream(f"{base}/{name}") as out:
                out.write(pack_file(keys, counts, flat))
            row = [task.partitionId()], [seq], [name], [len(keys)], [len(flat)]
            seq, keys, lengths, ids = seq + 1, [], [], []
            return pa.RecordBatch.from_arrays([pa.array(row[0], pa.int32()), pa.array(row[1], pa.int32()), pa.array(row[2], pa.string()), pa.array(row[3], pa.int64()), pa.array(row[4], pa.int64())], ["part", "seq", "file", "n_docs", "n_tokens"])

        held = 0
        for some, texts in _groups(batches):
            flat, counts = encode_texts(texts)
            with_end = np.full(len(flat) + len(some), end_id, dtype=np.uint32)
            with_end[np.arange(len(flat)) + np.repeat(np.arange(len(some)), counts)] = flat
            stops, low = np.r_[0, np.cumsum(counts + 1)], 0
            while low < len(some):
                # Up to the document that fills the file.
                high = min(len(some), int(np.searchsorted(stops, stops[low] + file_tokens - held)))
                keys += some[low:high]
                lengths.append(counts[low:high] + 1)
                ids.append(with_end[stops[low] : stops[high]])
                held += int(stops[high] - stops[low])
                low = high
                if held >= file_tokens:
                    yield flush()
                    held = 0
        if keys:
            yield flush()

    return write


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, file_tokens: int = FILE_TOKENS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode the whole texts and write them as token files below ``folder``; returns the written manifest.

    Files are in ascending ``id`` order (NULL ids first; repeated ids by a hash of the text), with ``end_id`` after every
    document; a NULL or empty text is the end id alone.  The manifest has one row per file: ``part, seq, file, n_docs,
    n_tokens`` with the order ``(part, seq)``.  A retried task writes files of new names, and only those of the attempt that
    Spark committed are in the manifest.  Other columns take no part, whatever their names.
    """
    rows = docs.select(F.col(id).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    # Rows of one id can be dealt to several ranges; which of two equal rows comes first makes no difference.
    order = [F.col("k").asc_nulls_first(), F.crc32(F.col("t").cast("binary")), F.monotonically_increasing_id()]
    rows = rows.withColumns({"h": order[1], "salt": order[2]}).repartitionByRange(order[0], "h", "salt").sortWithinPartitions(order[0], "h", "salt")
    manifest = rows.select("k", "t").mapInArrow(_writer(folder, tokenizer, end_id, file_tokens), "part int, seq int, file string, n_docs long, n_tokens long")
    return written(manifest, "token-manifest")


def file_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``: ids of all files before each; the one global window holds a row per partition."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before: Column = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within: Column = F.coalesce(F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return manifest.join(parts.select("part", before.alias("before")), "part").withColumn("start", F.col("before") + within).drop("before")


def _reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1), strict=True):
            keys, starts, codes = unpack_file(content.as_buffer().to_pybytes())
            raw = codes.all().astype("<u4").tobytes()
            name = path.as_py().rsplit("/", 1)[-1]
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(starts[:-1], pa.int64()), pa.array(np.diff(starts), pa.int64()), pa.array(crc, pa.int64())],
                ["file", "doc_id", "at", "n_tokens", "ids_crc32"],
            )


def read_documents(folder: str, manifest: DataFrame) -> DataFrame:
    """Decode every file of the manifest: ``doc_id, start, n_tokens, ids_crc32`` of each document, ``file`` and place in it."""
    spark = manifest.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder).select("path", "content")
    found = files.mapInArrow(_reader, "file string, doc_id long, at long, n_tokens long, ids_crc32 long")
    return found.join(file_starts(manifest).select("file", F.col("start").alias("before")), "file").select(
        "doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", "file", "at",
    )


def token_report(docs: DataFrame, tokenizer: str, end_id: int = 1, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the documents and read the files back; an empty table writes no file and gives no row."""
    spark = docs.sparkSession
    folder = new_folder(spark, "tokens")
    manifest = write_tokens(docs, folder, tokenizer, end_id, id=id, text=text)
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long, file string, at long")
    return read_documents(folder, manifest)
