"""Hashed words and windows in numpy, and their exchange through Spark as packed columns.

Statistics of every word window of a corpus cost too much as one row per window. Here the documents are dealt into
batches of bounded size; a batch sends one packed row per hash range with its sorted distinct hashes and a number for
each; one Spark group per hash range sees every batch's numbers and answers each batch with one byte per hash. A hash
that a third of all documents hold is one entry per batch, so no group grows with a hot key's rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

BATCH_BYTES = 8 << 20
ENTRIES_PER_RANGE = 1_000_000
LEAST_GROUPS = 256
_BUCKET_BITS = 1 << 15  # Spark's bitmaps are pieces of this many bits

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that a changed word always changes the sum


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hash of each word."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def distinct(keys: np.ndarray) -> np.ndarray:
    """Ascending distinct keys."""
    keys = np.sort(keys)
    return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Rabin-Karp hash, modulo 2**64, of every ``n`` consecutive word hashes."""
    count = max(0, len(words) - n + 1)
    out = np.zeros(count, np.uint64)
    for j in range(n):
        out = out * _BASE + words[j : j + count]
    return mix(out)


def bitmap(hashes: DataFrame, size: int) -> np.ndarray:
    """The bits of the given hashes (column ``h``); ``size`` bits in all, whatever the corpus."""
    spots = hashes.select(F.pmod("h", F.lit(size)).alias("_spot"))
    rows = spots.select(F.expr(f"CAST(_spot DIV {_BUCKET_BITS} AS INT)").alias("_piece"), F.expr(f"_spot % {_BUCKET_BITS}").alias("_bit"))
    bits = np.zeros(size // 8, np.uint8)
    for at, part in rows.groupBy("_piece").agg(F.bitmap_construct_agg("_bit")).collect():
        bits[at * _BUCKET_BITS // 8 : (at + 1) * _BUCKET_BITS // 8] = np.frombuffer(part, np.uint8)[: size // 8]
    return bits


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of the hashes are set: true for every hash given, and by chance for others."""
    spot = (hashes % np.uint64(len(bits) * 8)).astype(np.int64)
    return (bits[spot >> 3] >> (spot & 7).astype(np.uint8) & 1).astype(bool)


def _planes(values: np.ndarray) -> bytes:
    width = values.dtype.itemsize
    return zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, width).T.tobytes())


def _unplanes(data: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(dtype).ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending 64-bit keys as differences, byte by byte, compressed."""
    return _planes(np.diff(keys.astype("<u8"), prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unplanes(data, "<u8"), dtype=np.uint64)


def pack_numbers(values: np.ndarray) -> tuple[bytes, bytes]:
    """64-bit integers as a sorted dictionary and the positions in it."""
    known, at = np.unique(values.astype("<i8"), return_inverse=True)
    kind = "<u1" if len(known) <= 256 else "<u2" if len(known) <= 65536 else "<u4"
    return pack_sorted(known.view("<u8")), kind[-1].encode() + _planes(at.astype(kind))


def unpack_numbers(known: bytes, at: bytes) -> np.ndarray:
    return unpack_sorted(known).view(np.int64)[_unplanes(at[1:], f"<u{at[:1].decode()}")]


def pack_lines(lines: list[bytes]) -> bytes:
    """At least one string without line ends, compressed; sorted ones share their beginnings."""
    return zstandard.ZstdCompressor(level=3).compress(b"\n".join(lines))


def unpack_lines(data: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(data).split(b"\n")


def ranges_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The hash range of each key; ascending with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)


PACKED = "batch long, hash_range long, keys binary, known binary, at binary"
REPLY = "batch long, hash_range long, reply binary"


def packed_rows(batch: int, keys: np.ndarray, numbers: np.ndarray, ranges: int) -> pa.Table:
    """One row per hash range that holds any of a batch's ascending distinct ``keys``."""
    held, starts = np.unique(ranges_of(keys, ranges), return_index=True)
    ends = [*starts[1:], len(keys)]
    columns: list[list] = [[], [], [], [], []]
    for r, a, b in zip(held.tolist(), starts, ends):
        for column, value in zip(columns, (batch, r, pack_sorted(keys[a:b]), *pack_numbers(numbers[a:b]))):
            column.append(value)
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["batch", "hash_range", "keys", "known", "at"])


def replies(packed: DataFrame, judge: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """One byte per packed hash, in the order of its batch and hash range.

    ``judge(group, numbers)`` gets the entries of a hash range sorted by hash, with ``group`` the index of each entry's
    hash, and returns a uint8 for each entry.
    """

    def answer(table: pa.Table) -> pa.Table:
        keys = [unpack_sorted(k) for k in table["keys"].to_pylist()]
        numbers = [unpack_numbers(*x) for x in zip(table["known"].to_pylist(), table["at"].to_pylist())]
        ends = np.cumsum([len(k) for k in keys])
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        sorted_keys = every[order]
        group = np.cumsum(np.r_[False, sorted_keys[1:] != sorted_keys[:-1]])
        out = np.empty(len(every), np.uint8)
        out[order] = judge(group, np.concatenate(numbers)[order])
        packed_out = [zstandard.ZstdCompressor(level=1).compress(x.tobytes()) for x in np.split(out, ends[:-1])]
        return pa.table([table["batch"], table["hash_range"], pa.array(packed_out, pa.binary())],
                        names=["batch", "hash_range", "reply"])

    return packed.groupBy("hash_range").applyInArrow(answer, REPLY)


def read_replies(table: pa.Table) -> np.ndarray:
    """The bytes of one batch's replies, in the order of its ascending keys."""
    rows = sorted(zip(table["hash_range"].to_pylist(), table["reply"].to_pylist()))
    parts = [zstandard.ZstdDecompressor().decompress(data) for _, data in rows]
    return np.frombuffer(b"".join(parts), np.uint8)


def dealt(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, int]:
    """``(batch, doc_id, text)`` with the text as UTF-8 bytes, and the number of hash ranges for its windows.

    A batch holds about ``BATCH_BYTES``; it depends on a row's id and text alone, so every evaluation deals alike.
    """
    row = documents.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    size = row.b or 0
    batches = max(1, min(LEAST_GROUPS, row.n // 8), size // BATCH_BYTES)
    ranges = max(1, min(LEAST_GROUPS, row.n // 8), size // 6 // ENTRIES_PER_RANGE)
    batch = F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(batches)).cast("long")
    return documents.select(
        batch.alias("batch"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"),
    ), int(ranges)


def texts_of(table: pa.Table) -> list[bytes]:
    return [t or b"" for t in table["text"].to_pylist()]


def empty_table(schema: pa.Schema) -> pa.Table:
    return schema.empty_table()
