"""Removal of byte strings that an earlier document already holds, by the order of suffixes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from skytally.llm.packing import (
    PACKED, dealt, mix, pack_numbers, pack_sorted, packed_rows, ranges_of, read_replies, replies, texts_of,
    unpack_numbers, unpack_sorted,
)
from skytally.llm.suffixes import lengths_of, ragged, run_starts, window_classes

WINDOW = 50  # bytes
GRAM = 24  # bytes of an anchor; a window holds WINDOW - GRAM + 1 grams
RUN = 64  # most windows of a segment
# An anchor with more segments than this is cut into single windows, so that no set of suffixes outgrows a task.
SPREAD = 4096
BUCKET_BYTES = 24 << 20  # text per bucket of segments
LEAST_BUCKETS = 40

RESULT = ("doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
          "removed array<struct<start: int, end: int>>")
_BLOB = "batch long, bucket long, keys binary, sizes binary, known binary, at binary, data binary"
_ANSWER = "batch long, bucket long, earlier binary"

_LAST = np.iinfo(np.int64).max  # stands for a null id: later than every other
_STEP = 1 << 14  # bytes hashed at once, so that the arrays stay in the processor's cache
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15

_UNSHARED, _SHARED, _SPREAD = 0, 1, 2


def _gram_hashes(text: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` bytes, put together from those of 1, 2, 4, ... bytes."""
    part, width, out, done, left = _BYTE[text], 1, None, 0, n
    while True:
        if left & 1:
            if out is None:
                out, done = part, width
            else:
                count = len(text) - done - width + 1
                out = out[:count] * np.uint64(pow(_BASE, width, 2**64)) + part[done : done + count]
                done += width
        left >>= 1
        if not left:
            return out
        count = len(text) - 2 * width + 1
        part = part[:count] * np.uint64(pow(_BASE, width, 2**64)) + part[width : width + count]
        width *= 2


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of every ``n`` consecutive values."""
    width = 1
    while 2 * width <= n:
        values = np.minimum(values[:-width], values[width:])
        width *= 2
    return np.minimum(values[: len(values) - n + width], values[n - width :]) if n > width else values


def window_anchors(text: np.ndarray, window: int, gram: int) -> np.ndarray:
    """For every window, the least hash of the grams in it: equal windows have equal anchors."""
    count = max(0, len(text) - window + 1)
    out = np.empty(count, np.uint64)
    for a in range(0, count, _STEP):
        b = min(count, a + _STEP)
        out[a:b] = _least(_gram_hashes(text[a : b + window - 1], gram), window - gram + 1)
    return out


class _Windows:
    """The windows of one batch, its documents ordered by id, in segments of one anchor each."""

    def __init__(self, table: pa.Table, window: int, gram: int):
        ids = np.array([_LAST if i is None else i for i in table["doc_id"].to_pylist()], np.int64)
        order = np.argsort(ids, kind="stable")
        texts = texts_of(table)
        self.ids, self.window = ids[order], window
        self.sizes = np.array([len(texts[i]) for i in order], np.int64)
        self.data = b"".join([texts[i] for i in order])
        self.ends = np.cumsum(self.sizes)
        anchors = window_anchors(np.frombuffer(self.data, np.uint8), window, gram)
        # Runs of one anchor also end where a document does; windows that reach over its end are left out.
        changes = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
        begins = self.ends - self.sizes
        limits = np.maximum(self.ends - window + 1, begins)
        starts = np.unique(np.concatenate([changes, begins, limits]))
        starts = starts[starts < len(anchors)]
        lengths = lengths_of(starts, len(anchors))
        owner = np.searchsorted(self.ends, starts, side="right")
        inside = starts < limits[owner]
        starts, lengths, owner = starts[inside], lengths[inside], owner[inside]
        pieces = -(-lengths // RUN)
        piece = ragged(np.zeros(len(starts), np.int64), pieces)
        self.count = np.minimum(np.repeat(lengths, pieces) - piece * RUN, RUN)  # windows of each segment
        self.start = np.repeat(starts, pieces) + piece * RUN
        self.owner = np.repeat(owner, pieces)
        self.anchor = mix(anchors[self.start] + np.uint64(1))  # spread: the least hashes crowd at the low end
        self.keys, self.at, self.held = np.unique(self.anchor, return_inverse=True, return_counts=True)

    def sent(self, told: np.ndarray) -> _Sent:
        """The distinct segments of shared anchors; of widely shared ones, the distinct windows.

        ``told`` is the reply to each anchor. An anchor that only this batch holds is shared if two documents hold it.
        """
        low, high = np.full(len(self.keys), _LAST), np.full(len(self.keys), -1)
        np.minimum.at(low, self.at, self.owner)
        np.maximum.at(high, self.at, self.owner)
        state = np.where((told == _UNSHARED) & (low < high), _SHARED, told)[self.at]
        whole, spread = np.flatnonzero(state == _SHARED), np.flatnonzero(state == _SPREAD)
        start = np.concatenate([self.start[whole], ragged(self.start[spread], self.count[spread])])
        count = np.concatenate([self.count[whole], np.ones(len(start) - len(whole), np.int64)])
        owner = np.concatenate([self.owner[whole], np.repeat(self.owner[spread], self.count[spread])])
        found: dict[bytes, int] = {}
        data, more = self.data, self.window - 1
        number = np.fromiter(
            (found.setdefault(data[a : a + n + more], len(found)) for a, n in zip(start.tolist(), count.tolist())),
            np.int64, len(start))
        of = np.full(len(found), len(start))
        np.minimum.at(of, number, np.arange(len(start)))
        windows = list(found)
        keys = np.empty(len(found), np.uint64)
        split = of >= len(whole)
        keys[~split] = self.anchor[whole][of[~split]]
        keys[split] = np.fromiter(
            map(xxhash.xxh3_64_intdigest, (windows[i] for i in np.flatnonzero(split))), np.uint64, int(split.sum()))
        ids = np.full(len(found), _LAST)
        np.minimum.at(ids, number, self.ids[owner])
        return _Sent(start, count, owner, number, windows, keys, count[of], ids)


class _Sent:
    """What a batch sends of each distinct segment, sorted by key, and where its segments are."""

    def __init__(self, start, count, owner, number, data, keys, sizes, ids):
        order = np.lexsort((np.arange(len(keys)), keys))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.start, self.count, self.owner, self.number = start, count, owner, rank[number]
        self.data = [data[i] for i in order.tolist()]
        self.keys, self.sizes, self.ids = keys[order], sizes[order], ids[order]

    def blobs(self, batch: int, buckets: int) -> pa.Table:
        columns: list[list] = [[] for _ in range(7)]
        if len(self.keys):
            bucket = ranges_of(self.keys, buckets)
            starts = run_starts(bucket)
            pack = zstandard.ZstdCompressor(level=1).compress
            for a, n in zip(starts.tolist(), lengths_of(starts, len(bucket)).tolist()):
                b = a + n
                row = (batch, int(bucket[a]), pack_sorted(self.keys[a:b]), pack(self.sizes[a:b].astype(np.uint8).tobytes()),
                       *pack_numbers(self.ids[a:b]), pack(b"".join(self.data[a:b])))
                for column, value in zip(columns, row):
                    column.append(value)
        kinds = [pa.int64()] * 2 + [pa.binary()] * 5
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)],
                        names=["batch", "bucket", "keys", "sizes", "known", "at", "data"])


def _shared(group: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each batch's anchors: whether other batches hold them, and whether they have very many segments in all."""
    batches = np.bincount(group)
    total = np.bincount(group, counts)
    return np.where(total > SPREAD, _SPREAD, np.where(batches > 1, _SHARED, _UNSHARED)).astype(np.uint8)[group]


def _earliest(table: pa.Table, window: int) -> pa.Table:
    """A byte for each window sent: 1 if a document before the one it was sent for holds it too."""
    unpack = zstandard.ZstdDecompressor().decompress
    keys, sizes, ids, data, per_blob = [], [], [], [], []
    for row in table.select(["keys", "sizes", "known", "at", "data"]).to_pylist():
        counts = np.frombuffer(unpack(row["sizes"]), np.uint8).astype(np.int64)
        ends = np.cumsum(counts + window - 1)
        text = unpack(row["data"])
        keys.append(unpack_sorted(row["keys"]))
        sizes.append(counts)
        ids.append(unpack_numbers(row["known"], row["at"]))
        data += [text[b - n : b] for b, n in zip(ends.tolist(), (counts + window - 1).tolist())]
        per_blob.append(int(counts.sum()))
    key, size, doc = np.concatenate(keys), np.concatenate(sizes), np.concatenate(ids)
    # Segments that several batches sent are one from here on.
    known: dict[bytes, int] = {}
    number = np.fromiter((known.setdefault(x, len(known)) for x in data), np.int64, len(data))
    first = np.full(len(known), len(data))
    np.minimum.at(first, number, np.arange(len(data)))
    least = np.full(len(known), _LAST)
    np.minimum.at(least, number, doc)
    count = size[first]
    begins = np.cumsum(count) - count
    earliest = np.repeat(least, count)
    # Only anchors with several different segments have windows to look for.
    _, of_key, held = np.unique(key[first], return_inverse=True, return_counts=True)
    several = np.flatnonzero(held[of_key] > 1)
    several = several[np.argsort(of_key[several], kind="stable")]
    if len(several):
        strings = list(known)
        classes = window_classes([strings[i] for i in several.tolist()], of_key[several], window)
        at = ragged(begins[several], count[several])
        of_class = np.full(int(classes.max()) + 1, _LAST)
        np.minimum.at(of_class, classes, earliest[at])
        earliest[at] = of_class[classes]
    before = (earliest[ragged(begins[number], size)] < np.repeat(doc, size)).astype(np.uint8)
    pack = zstandard.ZstdCompressor(level=1).compress
    parts = np.split(before, np.cumsum(per_blob)[:-1])
    return pa.table([table["batch"], table["bucket"], pa.array([pack(x.tobytes()) for x in parts], pa.binary())],
                    names=["batch", "bucket", "earlier"])


def remove_repeated_bytes(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """Per row: its bytes, the maximal runs of bytes to remove, and the SHA-256 of what is kept.

    A byte of the text (UTF-8) goes when a string of ``window`` bytes over it also starts in a document with a smaller
    ``doc_id``; strings are judged on the input and never cross documents.

    1. The least hash of the ``gram``-byte strings in a window is its anchor; equal windows have equal anchors, and
       windows that follow each other mostly share one and form a segment. Batches of documents tell each other which
       anchors they hold (:mod:`skytally.llm.packing`); what no second document holds is done.
    2. Segments of shared anchors go to one Spark group per range of anchors, each distinct one once per batch. The
       suffixes of an anchor's segments are put in order by linear grouping (:mod:`skytally.llm.suffixes`): equal
       windows are neighbours there, so each window's earliest document is exact, not a matter of hashes.
    3. Every batch is told which of its windows are held before, and merges the bytes they cover into spans.

    An anchor with more than ``SPREAD`` segments is sent as single windows under their own hash instead, so that
    widely shared text and long repetitions are spread over all groups.

    Null text: no bytes. Text shorter than a window: nothing goes. A null id counts as larger than every id. Rows with
    equal ids never remove from each other, so repeated rows give repeated results. Columns other than ``doc_id`` and
    ``text`` are ignored. An empty table gives an empty table.
    """
    docs, ranges = dealt(documents)
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(min(LEAST_BUCKETS, ranges), -(-size // BUCKET_BYTES))

    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        w = _Windows(table, window, gram)
        return packed_rows(key[0].as_py(), w.keys, w.held, ranges)

    def send_segments(key: tuple[pa.Scalar, ...], table: pa.Table, reply: pa.Table) -> pa.Table:
        if not len(table):
            return _BLOB_NONE
        w = _Windows(table, window, gram)
        return w.sent(read_replies(reply)).blobs(key[0].as_py(), buckets)

    def remove(table: pa.Table, reply: pa.Table) -> pa.Table:
        w = _Windows(table, window, gram)
        of_bucket = pa.compute.is_valid(reply["bucket"])
        sent = w.sent(read_replies(reply.filter(pa.compute.invert(of_bucket))))
        told = reply.filter(of_bucket)
        rows = sorted(zip(told["bucket"].to_pylist(), told["earlier"].to_pylist()))
        unpack = zstandard.ZstdDecompressor().decompress
        earlier = np.frombuffer(b"".join([unpack(x) for _, x in rows]), np.uint8).astype(bool)
        begins = np.cumsum(sent.sizes) - sent.sizes
        gone = earlier[ragged(begins[sent.number], sent.count)]
        # A later document of the batch loses every window that it shares with the one the window was sent for.
        gone |= np.repeat(w.ids[sent.owner] > sent.ids[sent.number], sent.count)
        hit = ragged(sent.start, sent.count)[gone]
        steps = np.zeros(len(w.data) + 1, np.int64)
        np.add.at(steps, hit, 1)
        np.add.at(steps, hit + window, -1)
        covered = np.cumsum(steps)[:-1] > 0
        data = np.frombuffer(w.data, np.uint8)
        n_removed, n_spans, digests, removed = [], [], [], []
        for end, n in zip(w.ends.tolist(), w.sizes.tolist()):
            mask = covered[end - n : end]
            edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
            n_removed.append(int(mask.sum()))
            n_spans.append(len(edges) // 2)
            digests.append(hashlib.sha256(data[end - n : end][~mask]).hexdigest())
            removed.append([{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())])
        ids = pa.array([None if i == _LAST else i for i in w.ids.tolist()], pa.int64())
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table([ids, pa.array(w.sizes), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
                         pa.array(digests, pa.string()), pa.array(removed, kind)],
                        names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    by_batch = docs.groupBy("batch")
    shared = replies(by_batch.applyInArrow(send, PACKED), _shared)
    blobs = by_batch.cogroup(shared.groupBy("batch")).applyInArrow(send_segments, _BLOB)
    answers = blobs.groupBy("bucket").applyInArrow(lambda table: _earliest(table, window), _ANSWER)
    told = shared.unionByName(answers, allowMissingColumns=True)
    return by_batch.cogroup(told.groupBy("batch")).applyInArrow(remove, RESULT)


_BLOB_NONE = pa.table(
    [pa.array([], pa.int64())] * 2 + [pa.array([], pa.binary())] * 5,
    names=["batch", "bucket", "keys", "sizes", "known", "at", "data"])
