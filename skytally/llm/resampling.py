"""Importance resampling towards a target text: hashed word features, gains, and a seeded draw without replacement."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skytally.plans.durable import durable
from skytally.plans.ranking import with_position

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024

_POLYNOMIAL = 0xEDB88320  # of CRC-32
_CHUNK_BYTES = 4 << 20  # text whose words are in memory at once
# A-Z become a-z; every other ASCII character that is no digit or small letter separates words.
_WORDS = bytes(b + 32 if 65 <= b < 91 else b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else 32 for b in range(256))

_SCORED = "doc_id long, n_features long, weight long, score long"


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & np.uint32(1), (table >> np.uint32(1)) ^ np.uint32(_POLYNOMIAL), table >> np.uint32(1))
    return table


_TABLE = _crc_table()


def crc32_of(words: pa.Array) -> np.ndarray:
    """The unsigned CRC-32 of each binary value.

    Values of one length are the rows of a matrix of bytes; the CRCs of all rows take in one column after the other and
    go back to the places of their values.
    """
    offsets = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, words.offset * 4)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    lengths = np.diff(offsets)
    out = np.empty(len(words), np.uint32)
    by_length = np.argsort(lengths, kind="stable")
    sizes, starts = np.unique(lengths[by_length], return_index=True)
    for size, rows in zip(sizes.tolist(), np.split(by_length, starts[1:])):
        matrix = data[offsets[:-1][rows, None] + np.arange(size)]
        crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
        for column in matrix.T:
            crc = _TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
        out[rows] = ~crc
    return out


def _chunks(texts: list[bytes | None]) -> Iterator[list[bytes]]:
    chunk: list[bytes] = []
    held = 0
    for text in texts:
        chunk.append(text or b"")
        held += len(chunk[-1])
        if held >= _CHUNK_BYTES:
            yield chunk
            chunk, held = [], 0
    if chunk:
        yield chunk


def feature_buckets(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """How many words each text has, and the bucket of every word in turn. Each distinct word is hashed once."""
    split = [text.translate(_WORDS).split() for text in texts]
    counts = np.fromiter(map(len, split), np.int64, len(split))
    words = pa.array([word for words in split for word in words], pa.binary()).dictionary_encode()
    of_word = (crc32_of(words.dictionary) % np.uint32(buckets)).astype(np.int64)
    return counts, of_word[words.indices.to_numpy()]


def bucket_counts(documents: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall in each bucket. A task adds its texts up; ``buckets`` rows come back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for texts in _chunks(batch["text"].to_pylist()):
                total += np.bincount(feature_buckets(texts, buckets)[1], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    texts = documents.select(F.col("text").cast("binary").alias("text"))
    total = np.zeros(buckets, np.int64)
    for bucket, n in texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = n
    return total


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the target's smoothed share of a bucket by the corpus's), in doubles."""
    s_all, t_all = float(corpus.sum() + len(corpus)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(corpus.tolist(), target.tolist())], np.int64)


def seeded_noise(doc_id: int | None, seed: int = SEED) -> int:
    """A thousand times a standard Gumbel variable, rounded down, that the id and the seed decide."""
    name = "null" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score_documents(documents: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_features, weight, score)`` of every row."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, weights = batch["doc_id"].to_pylist(), [], []
            for texts in _chunks(batch["text"].to_pylist()):
                n, found = feature_buckets(texts, len(gains))
                sums = np.concatenate(([0], np.cumsum(gains[found])))
                ends = np.cumsum(n)
                counts.append(n)
                weights.append(sums[ends] - sums[ends - n])
            none = [np.empty(0, np.int64)]
            weight = np.concatenate(weights or none)
            noise = np.fromiter((seeded_noise(i, seed) for i in ids), np.int64, len(ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(np.concatenate(counts or none)), pa.array(weight),
                 pa.array(weight + noise)], names=["doc_id", "n_features", "weight", "score"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(score, _SCORED)


def resample(
    documents: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)``: the draw of ``percent`` of the documents towards ``target``.

    Features are the words of the whole text (A-Z lower-cased; runs of ASCII letters, digits and all non-ASCII
    characters), in buckets by CRC-32 (:func:`crc32_of`). A bucket's gain is the logarithm of its share in the target by
    its share in ``documents``; a document's ``weight`` adds up the gains of its features. ``score`` adds Gumbel noise
    seeded by the id, so that the highest scores are a draw without replacement in proportion to exp(weight). Of the N
    documents with ``min_words`` words or more the floor(percent * N / 100) highest get their ``rank`` 1, 2, 3, ...; all
    others have a null rank.

    Only two histograms of ``buckets`` numbers come to the driver. Ranks come from ranges of scores
    (:func:`skytally.plans.ranking.with_position`), not from one task.

    Null text: no features, weight 0. A null id is hashed as ``null``. Ties go to the smaller id, nulls last; rows of
    equal id and score are interchangeable. Repeated rows count each. Columns other than ``doc_id`` and ``text``
    (``text`` of the target) are ignored. Empty documents give an empty table; an empty target is a flat histogram.
    """
    gains = bucket_gains(bucket_counts(documents, buckets), bucket_counts(target, buckets))
    scored = durable(score_documents(documents, gains, seed))
    eligible = scored.where(F.col("n_features") >= min_words)
    drawn = percent * eligible.count() // 100
    placed = with_position(eligible, F.desc("score"), F.asc_nulls_last("doc_id"), name="rank")
    rank = F.when(F.col("rank") < drawn, F.col("rank") + 1)
    rest = scored.where(F.col("n_features") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).unionByName(rest)


def resampling_sql(
    percent: int = PERCENT, min_words: int = MIN_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> str:
    """DuckDB SQL for :func:`resample` of ``documents`` towards ``benchmark``. CRC-32 goes byte by byte over a table."""
    words = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
     'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
    step = f"CASE WHEN c % 2 = 1 THEN xor(c // 2, {_POLYNOMIAL}::BIGINT) ELSE c // 2 END"
    table = "SELECT i AS b, i AS c FROM range(256) t(i)"
    for _ in range(8):
        table = f"SELECT b, {step} AS c FROM ({table})"
    return f"""WITH crc_table AS (SELECT list(c ORDER BY b) AS crcs FROM ({table})),
     split AS (SELECT doc_id, {words} AS words FROM documents),
     wanted AS (SELECT unnest({words}) AS word FROM benchmark),
     held AS (SELECT unnest(words) AS word FROM split),
     hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM held UNION SELECT word FROM wanted)),
     buckets AS (SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT,
       list_transform(range(length(h) // 2), lambda i: (strpos('0123456789ABCDEF', h[2 * i + 1]) - 1) * 16
        + strpos('0123456789ABCDEF', h[2 * i + 2]) - 1)),
       lambda c, b: xor(c // 256, crcs[(xor(c % 256, b) + 1)::INT])), 4294967295::BIGINT) % {buckets} AS bucket FROM hexed, crc_table),
     s AS (SELECT bucket, count(*) AS s FROM held JOIN buckets USING (word) GROUP BY bucket),
     t AS (SELECT bucket, count(*) AS t FROM wanted JOIN buckets USING (word) GROUP BY bucket),
     totals AS (SELECT (SELECT count(*) FROM held)::DOUBLE + {buckets} AS s_all, (SELECT count(*) FROM wanted)::DOUBLE + {buckets} AS t_all),
     gains AS (SELECT word, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * s_all / ((coalesce(s, 0) + 1)::DOUBLE * t_all)))::BIGINT AS gain
      FROM buckets LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), totals),
     weights AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM (SELECT doc_id, unnest(words) AS word FROM split) JOIN gains USING (word)
      GROUP BY doc_id),
     noise AS (SELECT doc_id, len(words) AS n_features, ('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT AS h FROM split),
     scored AS (SELECT doc_id, n_features::BIGINT AS n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM noise LEFT JOIN weights USING (doc_id)),
     ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n
      FROM scored WHERE n_features >= {min_words})
     SELECT doc_id, n_features, weight, score, CASE WHEN r <= {percent} * n // 100 THEN r END AS rank
     FROM scored LEFT JOIN ranked USING (doc_id)"""
