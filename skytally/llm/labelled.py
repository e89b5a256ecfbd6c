"""Labelled texts for the models that are trained here."""

from __future__ import annotations

import re

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

FOLDS = 5
MAX_LABELLED = 12_000

_WORD = re.compile(r"\w+")


def fold(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; rows of fold 0 are never learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % FOLDS


def agreed_labels(labels: DataFrame, label: Column) -> DataFrame:
    """``(doc_id, label)`` outside fold 0. Labels of one id that disagree, null labels and null ids are left out."""
    one = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(label).alias("label"), F.max(label).alias("_most")).where("label = _most").drop("_most")
    return one.where(fold() != 0)


def labelled_sample(documents: DataFrame, labels: DataFrame, label: Column, limit: int = MAX_LABELLED) -> list[tuple]:
    """(text, lang, label, fold) of at most ``limit`` labelled documents outside fold 0, in a seeded order.

    This bounded sample is all that comes to the driver. Labels of one id that disagree, and null labels, are left out.
    """
    names = documents.select("doc_id").join(agreed_labels(labels, label), "doc_id").distinct()
    chosen = names.withColumn("_order", F.xxhash64(F.lit("sample"), "doc_id")).orderBy("_order", "doc_id").limit(limit)
    texts = documents.select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id")  # at most `limit` ids
    rows = texts.groupBy("doc_id", "_order", "label").agg(F.min(F.struct("text", "lang")).alias("_t")).select(
        "_order", "doc_id", "_t.text", "_t.lang", "label", fold().alias("fold")).collect()
    return [(r.text or "", r.lang or "", r.label, r.fold) for r in sorted(rows, key=lambda r: (r._order, r.doc_id))]


def word_hashes(text: str, stem: int = 0) -> np.ndarray:
    """64-bit hashes of the lower-cased words, without punctuation; with ``stem``, a second column of their stems."""
    words = _WORD.findall(text.lower())
    found = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if not stem:
        return found
    return np.c_[found, np.fromiter(map(xxhash.xxh3_64_intdigest, [w[:stem] for w in words]), np.uint64, len(words))]
