"""Token ids in Simple-8b pages: written in document order, read back with vectorised decoding."""

from __future__ import annotations

import ctypes
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from skytally.llm.encoding import END_ID, PATH, REMEMBERED, encoder

# Fixed values of the code: values per word and bits per value of each selector (the upper four bits of a word).
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])

BLOCK = 512  # ids that share an offset
PAGE_IDS = 65_536  # a page ends with the document that reaches this
BYTES_AT_ONCE = 4 << 20  # of text that is encoded together, or one text
_MAGIC = b"S8P1"
_HEAD = struct.Struct("<4sIQII")

_PAYLOAD = np.uint64((1 << 60) - 1)
_ESCAPE = np.uint64(0xFFFFFFFFFFFFFFFF)  # selector 15, all payload bits set: the next word is the value itself
_PAGES = "shard int, page int, n_ids long, payload binary"
_DOCS = "shard int, page int, doc_id long, within long, n_tokens long, ids_crc32 long"


def _need_by_comparison(values: np.ndarray) -> np.ndarray:
    need = np.zeros(values.shape, np.uint8)
    for bits in np.unique(BITS[:-1]):
        need[values >= np.uint64(1) << np.uint64(bits)] = BITS[BITS > bits][0]
    need[values >= _PAYLOAD] = 255
    return need


_SMALL_NEED = _need_by_comparison(np.arange(1 << 16, dtype=np.uint64))


def _need(values: np.ndarray) -> np.ndarray:
    """The fewest payload bits per value of a selector that holds the value; 255 if none does."""
    if values.size and values.max() < len(_SMALL_NEED):
        return _SMALL_NEED[values.astype(np.uint16)]
    return _need_by_comparison(values)


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """``(words, offsets)``: Simple-8b words of unsigned 64-bit ``ids``, and where each block's words begin.

    Every word takes the most values that fit; all blocks advance together, one word at a time. Values of 2**60 - 1
    and above follow an escape word as they are.
    """
    n = len(ids)
    blocks = -(-n // block)
    most = int(COUNTS[0])
    lanes = np.zeros((blocks, block + most), np.uint64)  # the zeros behind a block fill its last word
    flat = np.zeros(blocks * block, np.uint64)
    flat[:n] = ids
    lanes[:, :block] = flat.reshape(blocks, block)
    need = _need(lanes)
    long_values = need == 255

    best = np.full((blocks, block), 15, np.uint8)
    widest, reach = need, 1  # the largest need among the next `reach` values
    for selector in range(14, -1, -1):
        count = int(COUNTS[selector])
        while reach < count:
            step = min(reach, count - reach)
            moved = np.zeros_like(widest)
            moved[:, :-step] = widest[:, step:]
            widest, reach = np.maximum(widest, moved), reach + step
        fits = widest[:, :block] <= BITS[selector]
        if not fits.any():
            break  # then more values of fewer bits fit nowhere either
        best[fits] = selector

    lengths = np.full(blocks, block)
    if blocks:
        lengths[-1] = n - (blocks - 1) * block
    step, selector_at = COUNTS[best].ravel(), best.ravel()
    spot = np.arange(blocks) * block
    end = spot + lengths
    picked: list[np.ndarray] = []
    while len(spot):
        picked.append(spot)
        spot = spot + step[spot]
        on = spot < end
        if not on.all():
            spot, end = spot[on], end[on]
    if not picked:
        return np.empty(0, np.uint64), np.empty(0, np.uint32)
    spot = np.sort(np.concatenate(picked))
    lane, at = np.divmod(spot, block)
    selectors = selector_at[spot]
    place = lane * lanes.shape[1] + at
    words = selectors.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(selectors):
        mine = np.flatnonzero(selectors == selector)
        if BITS[selector]:
            values = lanes.ravel()[place[mine, None] + np.arange(COUNTS[selector])]
            shifts = np.arange(COUNTS[selector], dtype=np.uint64) * np.uint64(BITS[selector])
            words[mine] |= np.bitwise_or.reduce(np.minimum(values, _PAYLOAD) << shifts, axis=1)
    escaped = long_values[lane, at] & (selectors == 15)
    per_block = np.bincount(lane, 1 + escaped, minlength=blocks).astype(np.int64)
    if escaped.any():
        where = np.flatnonzero(escaped)
        words = np.insert(words, where + 1, lanes[lane[where], at[where]])
    return words, (np.cumsum(per_block) - per_block).astype(np.uint32)


def decode_blocks(words: np.ndarray, offsets: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` ids of :func:`encode_blocks`. All words of one selector are unpacked together."""
    out = np.zeros(n, np.uint64)
    owner = np.zeros(len(words), np.int64)
    owner[offsets[1:]] = 1
    owner = np.cumsum(owner)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(words == _ESCAPE):  # rare; a raw word may look like an escape itself
        raw[i + 1 : i + 2] = not raw[i]
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = np.where(raw, 0, COUNTS[selectors])
    # the last word of a block may hold fewer values than its selector says, so positions start anew in each block
    before = np.cumsum(counts) - counts
    start = before - before[offsets][owner] + owner * block
    ends = np.minimum((owner + 1) * block, n)
    for selector in np.unique(selectors[~raw]):
        mine = np.flatnonzero((selectors == selector) & ~raw)
        lanes = np.arange(COUNTS[selector])
        at = start[mine, None] + lanes
        if BITS[selector]:
            mask = np.uint64((1 << int(BITS[selector])) - 1)
            values = (words[mine, None] >> (lanes.astype(np.uint64) * np.uint64(BITS[selector]))) & mask
            held = at < ends[mine, None]
            out[at[held]] = values[held]
    escapes = np.flatnonzero((words == _ESCAPE) & ~raw)
    out[start[escapes]] = words[escapes + 1]
    return out


def write_page(docs: list[tuple[int | None, np.ndarray]]) -> bytes:
    """A page: head, ids and lengths of its documents, block offsets, words; all little-endian."""
    ids = np.concatenate([x for _, x in docs]).astype(np.uint64)
    words, offsets = encode_blocks(ids)
    names = np.array([0 if d is None else d for d, _ in docs], "<i8")
    null = np.array([d is None for d, _ in docs], np.uint8)
    sizes = np.array([len(x) for _, x in docs], "<u8")
    head = _HEAD.pack(_MAGIC, len(docs), len(ids), len(offsets), len(words))
    return head + names.tobytes() + null.tobytes() + sizes.tobytes() + offsets.astype("<u4").tobytes() + words.astype(
        "<u8").tobytes()


def read_page(data: bytes) -> list[tuple[int | None, np.ndarray]]:
    """The documents of a page with their ids."""
    magic, n_docs, n_ids, n_blocks, n_words = _HEAD.unpack_from(data)
    if magic != _MAGIC:
        raise ValueError("not a Simple-8b page")
    at, parts = _HEAD.size, []
    for kind, count in (("<i8", n_docs), ("<u1", n_docs), ("<u8", n_docs), ("<u4", n_blocks), ("<u8", n_words)):
        parts.append(np.frombuffer(data, kind, count, at))
        at += parts[-1].nbytes
    names, null, sizes, offsets, words = parts
    ids = decode_blocks(words.astype(np.uint64), offsets.astype(np.int64), n_ids)
    ends = np.cumsum(sizes.astype(np.int64))
    return [(None if is_null else int(name), x)
            for name, is_null, x in zip(names, null, np.split(ids, ends[:-1]))]


def _runs(texts: pa.Array) -> Iterator[pa.Array]:
    """``texts`` in slices of about ``BYTES_AT_ONCE``."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)
    cuts = np.flatnonzero(np.diff((np.cumsum(sizes) - sizes) // BYTES_AT_ONCE)) + 1
    for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)]):
        yield texts.slice(begin, end - begin)


def _give_back() -> None:
    """Return memory that this worker freed, perhaps in an earlier stage, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def write_token_pages(
    documents: DataFrame, path: str, tokenizer: str = PATH, end_id: int = END_ID, remembered: int = REMEMBERED,
    keep: bool = True,
) -> None:
    """Encode whole texts and write them to ``path`` as pages in ascending document order.

    Documents are dealt by ranges of ``doc_id`` and the hash of the text, so that equal and null ids are spread too, and
    sorted within them. A row of the written Parquet table is one page
    (shard, page, n_ids, payload); Parquet only carries the pages, so any store that Spark writes to will do. A null
    text has no ids but the end id; null ids come last, equal ids in the order of the hashes of their texts, then of the
    texts. Columns other than ``doc_id`` and ``text`` are ignored; an empty table gives no pages.

    ``remembered`` bounds the pieces of text whose ids a worker keeps in memory; pieces beyond it are encoded again.
    Unless ``keep``, a worker lets go of them at the end of each task: it outlives the task, and so would they.
    """
    order = (F.col("doc_id").asc_nulls_last(), F.xxhash64("text").asc(), F.col("text").asc_nulls_first())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, page = TaskContext.get().partitionId(), 0
        end = np.uint32(end_id)
        docs: list[tuple[int | None, np.ndarray]] = []
        held = 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([page], pa.int32()), pa.array([held], pa.int64()),
                 pa.array([write_page(docs)], pa.binary())], names=["shard", "page", "n_ids", "payload"])

        for batch in batches:
            _give_back()
            names = iter(batch["doc_id"].to_pylist())
            for run in _runs(batch["text"]):
                texts = [t or "" for t in run.to_pylist()]
                for ids in encoder(tokenizer, remembered).encode(texts):
                    name = next(names)
                    docs.append((name, np.append(ids, end)))
                    held += len(docs[-1][1])
                    if held >= PAGE_IDS:
                        yield flush()
                        docs, held, page = [], 0, page + 1
        if docs:
            yield flush()
        if not keep:
            docs = texts = ids = run = batch = None
            encoder(tokenizer, remembered).forget()
            _give_back()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pages = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).mapInArrow(encode, _PAGES)
    pages.write.option("parquet.block.size", 16 << 20).parquet(path)


def read_token_pages(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded from the pages at ``path``.

    ``start`` counts the ids of all documents before it: those before it in its page, in the earlier pages of its
    shard, and in the earlier shards.
    """
    pages = spark.read.schema(_PAGES).parquet(path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, page, payload in zip(*(batch[c].to_pylist() for c in ("shard", "page", "payload"))):
                docs = read_page(payload)
                sizes = np.array([len(x) for _, x in docs], np.int64)
                crc = [zlib.crc32(x.astype("<u4").tobytes()) for _, x in docs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(docs), shard, np.int32)), pa.array(np.full(len(docs), page, np.int32)),
                     pa.array([d for d, _ in docs], pa.int64()), pa.array(np.cumsum(sizes) - sizes), pa.array(sizes),
                     pa.array(crc, pa.int64())],
                    names=["shard", "page", "doc_id", "within", "n_tokens", "ids_crc32"])

    sizes = pages.select("shard", "page", "n_ids")
    in_shard = Window.partitionBy("shard").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    of_shards = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(of_shards), F.lit(0)).alias("before_shard"))
    starts = sizes.withColumn("before_page", F.coalesce(F.sum("n_ids").over(in_shard), F.lit(0))).join(
        shards, "shard").select("shard", "page", (F.col("before_shard") + F.col("before_page")).alias("before"))
    docs = pages.select("shard", "page", "payload").mapInArrow(decode, _DOCS)
    return docs.join(starts, ["shard", "page"]).select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
