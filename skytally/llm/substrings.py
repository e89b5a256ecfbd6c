"""Removal of word windows that an earlier document already holds."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from skytally.llm.packing import (
    PACKED, dealt, packed_rows, read_replies, replies, texts_of, window_hashes, word_hashes,
)

WINDOW = 13

RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<struct<start: int, end: int>>"

_LAST = np.iinfo(np.int64).max  # stands for a null id: later than every other


class _Windows:
    """The windows of one batch, its documents ordered by id."""

    def __init__(self, table: pa.Table, n: int):
        ids = np.array([_LAST if i is None else i for i in table["doc_id"].to_pylist()], np.int64)
        order = np.argsort(ids, kind="stable")
        texts = texts_of(table)
        self.ids = ids[order]
        self.words = [texts[i].split() for i in order]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.ends = np.cumsum(sizes)
        every = np.concatenate([word_hashes(w) for w in self.words])
        owner = np.repeat(np.arange(len(sizes)), sizes)
        count = max(0, len(every) - n + 1)
        self.starts = np.flatnonzero(np.arange(count) + n <= self.ends[owner[:count]])
        self.doc = self.ids[owner[self.starts]]
        # documents are in id order, so the first occurrence of a hash is its smallest id
        self.keys, first, self.at = np.unique(
            window_hashes(every, n)[self.starts], return_index=True, return_inverse=True)
        self.smallest = self.doc[first]
        self.size = len(every)


def _earlier(group: np.ndarray, smallest: np.ndarray) -> np.ndarray:
    """1 where some other batch holds the window in a document with a smaller id."""
    least = np.full(group[-1] + 1, _LAST)
    np.minimum.at(least, group, smallest)
    return (least[group] < smallest).astype(np.uint8)


def _intervals(covered: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.r_[0, covered.view(np.int8), 0]))
    return [{"start": a, "end": b} for a, b in zip(edges[::2].tolist(), edges[1::2].tolist())]


def remove_repeated_windows(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: its words, the maximal intervals of words to remove, and the SHA-256 of what is kept.

    Words are the maximal runs without ASCII white space. A word goes when a window of ``window`` words over it also
    starts in a document with a smaller ``doc_id``; windows are judged on the input. Every window gets a Rabin-Karp
    hash (64 bits); Spark brings equal hashes together by hash range (see :mod:`skytally.llm.packing`), finds the
    smallest id of each, and answers the batch of documents it came from, which merges covered words into maximal
    intervals ``[start, end)``. Two different windows are taken for the same one when their 64-bit hashes agree.

    Null text: no words. Text shorter than a window: nothing goes. A null id counts as larger than every id. Rows with
    equal ids never remove from each other, so repeated rows give repeated results. Columns other than ``doc_id`` and
    ``text`` are ignored. An empty table gives an empty table.
    """
    docs, ranges = dealt(documents)

    def send(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        w = _Windows(table, window)
        return packed_rows(key[0].as_py(), w.keys, w.smallest, ranges)

    def remove(docs_table: pa.Table, reply: pa.Table) -> pa.Table:
        w = _Windows(docs_table, window)
        gone = (read_replies(reply).astype(bool)[w.at] | (w.doc > w.smallest[w.at])) if len(w.at) else w.at.astype(bool)
        steps = np.zeros(w.size + 1, np.int64)
        hit = w.starts[gone]
        np.add.at(steps, hit, 1)
        np.add.at(steps, hit + window, -1)
        covered = np.cumsum(steps)[:-1] > 0
        out: dict[str, list] = {"n_removed": [], "kept_sha256": [], "removed": []}
        for words, end in zip(w.words, w.ends.tolist()):
            mask = covered[end - len(words) : end]
            n = int(mask.sum())
            kept = words if not n else [word for word, m in zip(words, mask.tolist()) if not m]
            out["n_removed"].append(n)
            out["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            out["removed"].append(_intervals(mask) if n else [])
        ids = pa.array([None if i == _LAST else i for i in w.ids.tolist()], pa.int64())
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.table([ids, pa.array([len(x) for x in w.words], pa.int64()), pa.array(out["n_removed"], pa.int64()),
                         pa.array(out["kept_sha256"], pa.string()), pa.array(out["removed"], kind)],
                        names=["doc_id", "n_words", "n_removed", "kept_sha256", "removed"])

    answers = replies(docs.groupBy("batch").applyInArrow(send, PACKED), _earlier)
    return docs.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(remove, RESULT)
