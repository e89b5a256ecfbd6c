"""Quality rules: word, symbol and repetition counts, and divergence from the language's usual text."""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from skytally.plans.durable import durable

MIN_WORDS = 50  # of the base rules
COMMON_WORDS = 50
GUARD_CHARS = 2 * MIN_WORDS - 1  # shorter texts are not judged by character classes; 50 words have as many
GUARD_WORDS = MIN_WORDS  # nor these by common words
GUARD_REFERENCE = 10_000  # words that a language needs to have a reference
MAX_CHAR_DISTANCE = 0.28
MAX_WORD_DISTANCE = 0.4
# Few words stray further from the usual shares: below so many words the bound grows, by up to this part of it.
WIDER_BELOW, WIDER = 100, 0.1

_FLUSH = 200_000
_SYMBOLS = "#*$%&|<>"
_CLASSES = ("lower", "upper", "letter", "mark", "digit", "space", "punctuation", "symbol", "control")
_STATS = "lang string, word string, n long"
RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, char_distance double, word_distance double, kept boolean")


def _class_of(code: int) -> int:
    kind = unicodedata.category(chr(code))
    if kind in ("Ll", "Lu"):
        return 0 if kind == "Ll" else 1
    if code in (9, 10, 11, 12, 13, 32) or kind[0] == "Z":
        return 5
    return {"L": 2, "M": 3, "N": 4, "P": 6, "S": 7}.get(kind[0], 8)


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """Class of every code point, and whether it is white space between words (1) or a counted symbol (2)."""
    if not _TABLES:
        classes = np.fromiter(map(_class_of, range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
        marks = np.zeros(sys.maxunicode + 1, np.uint8)
        marks[[9, 10, 11, 12, 13, 32]] = 1
        marks[[ord(c) for c in _SYMBOLS]] = 2
        _TABLES.extend((classes, marks))
    return tuple(_TABLES)


_TABLES: list[np.ndarray] = []


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def char_classes(codes: np.ndarray) -> np.ndarray:
    return np.bincount(_tables()[0][codes], minlength=len(_CLASSES))


def _words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split()  # bytes split at ASCII white space only


def repeated_words(words: list[bytes], n: int = 3) -> int:
    """How many words lie in an ``n``-word window that the text holds twice or more."""
    if len(words) < n:
        return 0
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    window = ids[: len(ids) - n + 1]
    for j in range(1, n):  # exact: windows are numbered anew after each word, so the product stays small
        window = np.unique(window, return_inverse=True)[1] * len(known) + ids[j : len(ids) - n + 1 + j]
    _, at, counts = np.unique(window, return_inverse=True, return_counts=True)
    hit = np.flatnonzero(counts[at] > 1)
    steps = np.zeros(len(words) + 1, np.int64)
    np.add.at(steps, hit, 1)
    np.add.at(steps, hit + n, -1)
    return int((np.cumsum(steps) > 0).sum())


def duplicate_lines(text: str) -> int:
    seen, again = set(), 0
    for line in text.split("\n"):
        if line in seen:
            again += 1
        elif line.encode("utf-8", "surrogatepass").split():
            seen.add(line)
    return again


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    parts = [np.sum(x[x > 0] * np.log2(x[x > 0] / m[x > 0])) for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


def word_bound(bound: float, n_words: int) -> float:
    """The bound of the word distance for a text of ``n_words``."""
    return bound * (1 + WIDER * max(0, WIDER_BELOW - n_words) / WIDER_BELOW)


def references(documents: DataFrame, common: int = COMMON_WORDS, guard: int = GUARD_REFERENCE) -> dict:
    """``{lang: (class histogram, {common word: position}, word histogram)}`` over all documents.

    Tasks count before Spark sums, so a frequent word or language is a few rows per task. What comes to the driver is
    one histogram of ``common`` words for each language with at least ``guard`` words.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)
        classes: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(len(_CLASSES), np.int64))

        def flush() -> pa.RecordBatch:
            rows = [(lang, word, n) for lang, c in words.items() for word, n in c.items()]
            rows += [(lang, f" {_CLASSES[i]}", int(n)) for lang, c in classes.items() for i, n in enumerate(c)]
            words.clear()
            classes.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, k) for x, k in zip(zip(*rows) if rows else ((), (), ()),
                                                (pa.string(), pa.string(), pa.int64()))],
                names=["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                found = _words((text or "").lower())
                words[lang or ""].update(w.decode("utf-8", "surrogatepass") for w in found)
                words[lang or ""][" "] += len(found)
                classes[lang or ""] += char_classes(_codes(text or ""))
                if sum(map(len, words.values())) > _FLUSH:
                    yield flush()
        yield flush()

    counted = durable(documents.select("lang", "text").mapInArrow(count, _STATS).groupBy("lang", "word").agg(
        F.sum("n").alias("n")))
    totals = counted.where("word = ' '").select("lang", F.col("n").alias("total")).where(F.col("total") >= guard)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.col("n").desc(), "word"))
    top = counted.where("word NOT LIKE ' %'").withColumn("rank", rank).where(F.col("rank") <= common).drop("rank")
    rows = counted.where("word LIKE ' %'").unionByName(top).join(totals.select("lang"), "lang", "left_semi").collect()
    found: dict[str, dict[str, int]] = defaultdict(dict)
    for row in rows:
        found[row.lang][row.word] = row.n
    out = {}
    for lang, counts in found.items():
        names = sorted(w for w in counts if not w.startswith(" "))
        shares = np.array([counts[w] for w in names], float)
        classes = np.array([counts.get(f" {c}", 0) for c in _CLASSES], float)
        out[lang] = classes, {w: i for i, w in enumerate(names)}, np.r_[shares, counts[" "] - shares.sum()]
    return out


def quality_rules(
    documents: DataFrame,
    max_char_distance: float = MAX_CHAR_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
    guard_chars: int = GUARD_CHARS,
    guard_words: int = GUARD_WORDS,
) -> DataFrame:
    """Counts of each whole text, whether the base rules fail, its divergences, and whether it is kept.

    The base rules ask for 50 words, and for half of the words at most in three-word windows that occur twice or more.
    A document is then compared with all documents of its ``lang``: the histogram of its character classes, if it has
    ``guard_chars`` characters, and that of the language's 50 most common words (and all others), if it has
    ``guard_words`` words, by Jensen-Shannon distance. It is kept if the base rules hold and neither distance exceeds
    its bound; that of the words grows below 100 words, by a twentieth at 50. By default every text of 50 words is
    judged by both. A distance that is not judged is null. Null languages are one language; a language of fewer than
    10,000 words has no reference and judges nothing.

    Null or empty text: all counts 0, base_failed, not kept. Rows are judged one by one, so repeated rows and equal or
    null ids change nothing. Other columns are ignored. An empty table gives an empty table.
    """
    known = references(documents)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(9)]
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                text = text or ""
                codes, words = _codes(text), _words(text)
                marks = np.bincount(_tables()[1][codes], minlength=3)
                repeats = repeated_words(words)
                failed = len(words) < MIN_WORDS or 100 * repeats > 50 * len(words)
                of_chars = of_words = None
                if reference := known.get(lang or ""):
                    classes, names, shares = reference
                    if len(codes) >= guard_chars:
                        of_chars = distance(char_classes(codes), classes)
                    if len(words) >= guard_words:
                        at = [names.get(w.decode("utf-8", "surrogatepass"), len(names)) for w in _words(text.lower())]
                        of_words = distance(np.bincount(at, minlength=len(names) + 1), shares)
                kept = not failed and (of_chars or 0) <= max_char_distance and (
                    (of_words or 0) <= word_bound(max_word_distance, len(words)))
                for column, value in zip(out, (
                        len(words), int(marks[0] + marks[2]), int(marks[2]), duplicate_lines(text), repeats, failed,
                        of_chars, of_words, kept)):
                    column.append(value)
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            names = [c.split()[0] for c in RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, k) for c, k in zip(out, kinds))], names=names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").mapInArrow(judge, RESULT)
