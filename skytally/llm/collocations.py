"""Collocations: frequent phrases by language whose parts would rarely meet by themselves."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from skytally.llm.packing import (
    bitmap, in_bitmap, mix, pack_lines, pack_numbers, pack_sorted, unpack_lines, unpack_numbers, unpack_sorted,
)
from skytally.llm.suffixes import lengths_of, run_starts
from skytally.plans.durable import durable
from skytally.plans.ranking import top_k_per_group

MAX_WORDS = 4
MIN_COUNT = 30
TOP = 2000
SCALE = 2_000_000
COVERED_PERCENT = 80

FILTER_BITS = 1 << 26  # of the bitmap of frequent phrases, 8 MB; a power of two

PREFIXES = 64  # subtrees below the root, by first word
BURST = 1 << 14  # phrases that a hash container holds before it bursts
SPILL = 1 << 20  # phrases in memory before the largest subtree is spilled
_CHUNK_BYTES = 4 << 20  # text whose words are in memory at once
_CHUNK_WORDS = 1 << 20
_ID_BITS = 21  # of a word id, three of which fit in 64 bits; ids start anew when they run out

_FOLD = bytes(b + 32 if 65 <= b < 91 else 10 if b in b".,;:!?\x0b\x0c\r" else 32 if b == 9 else b for b in range(256))
_BREAK = b"\n"

_PAIR_SHIFT = 24  # pairs are told apart by 40 bits of their hash, to find those that may be frequent
_SLICE_BYTES = 4 << 30  # text per slice of a prefix partition

_PHRASE_SLICES = 4  # slices of phrases for one of hashes

_RUNS = "lang string, prefix long, slice long, phrases binary, known binary, at binary"
_RUN_SCHEMA = pa.schema([("lang", pa.string()), ("prefix", pa.int64()), ("slice", pa.int64()), ("phrases", pa.binary()),
                         ("known", pa.binary()), ("at", pa.binary())])
_PACKED_RUNS = "lang string, prefix long, slice long, keys binary, known binary, at binary"
_PACKED_SCHEMA = pa.schema([("lang", pa.string()), ("prefix", pa.int64()), ("slice", pa.int64()), ("keys", pa.binary()),
                            ("known", pa.binary()), ("at", pa.binary())])


class _Container(dict):
    """A hash container: packed remaining word ids to counts."""


class _Node:
    """A burst container: one container for each next word id."""

    def __init__(self, held: dict[int, int], depth: int):
        self.shift, self.depth = _ID_BITS * depth, depth
        self.children: dict[int, _Container | _Node] = {}
        for key, n in held.items():
            self.add(key, n)

    def add(self, key: int, n: int) -> int:
        """Count ``n`` more of a phrase; returns how many phrases are new."""
        first, rest = key >> self.shift, key & ((1 << self.shift) - 1)
        child = self.children.get(first)
        if child is None:
            child = self.children[first] = _Container()
        if isinstance(child, _Node):
            return child.add(rest, n)
        before = child.get(rest)
        child[rest] = n if before is None else before + n
        if len(child) > BURST and self.depth > 1:
            self.children[first] = _Node(child, self.depth - 1)
        return before is None

    def items(self) -> Iterator[tuple[int, int]]:
        for first, child in self.children.items():
            high = first << self.shift
            for rest, n in child.items():
                yield high | rest, n


class PhraseTrie:
    """Counts of phrases of ``words`` word ids: a shallow trie over the leading ids with hash containers below.

    The root has ``PREFIXES`` subtrees by the hash of the first word, each a hash container until it bursts into one for each first
    word, and so on. When more than ``SPILL`` phrases are held, the largest subtree leaves as a run.
    """

    def __init__(self, words: int):
        self.words = words
        self.subtrees: list[_Container | _Node] = [_Container() for _ in range(PREFIXES)]
        self.sizes = [0] * PREFIXES

    def add(self, keys: list[int], counts: list[int], prefixes: list[int]) -> None:
        """``prefixes`` has the subtree of each word id."""
        top = _ID_BITS * (self.words - 1)
        for key, n in zip(keys, counts):
            p = prefixes[key >> top]
            tree = self.subtrees[p]
            if isinstance(tree, _Node):
                self.sizes[p] += tree.add(key, n)
                continue
            before = tree.get(key)
            tree[key] = n if before is None else before + n
            if before is None:
                self.sizes[p] += 1
                if self.sizes[p] > BURST and self.words > 1:
                    self.subtrees[p] = _Node(tree, self.words - 1)

    def largest(self) -> int:
        return max(range(PREFIXES), key=self.sizes.__getitem__)

    def take(self, p: int) -> dict[int, int]:
        tree, self.subtrees[p], self.sizes[p] = self.subtrees[p], _Container(), 0
        return dict(tree.items())

    def __len__(self) -> int:
        return sum(self.sizes)


class _Counter:
    """The phrases of one language in one task, by number of words, and the runs they leave as."""

    def __init__(self, lang: str, words: tuple[int, ...], slices: int, hashed: bool):
        """Runs are packed in so many slices: hashes of pairs if ``hashed``, else phrases."""
        self.lang, self.slices, self.hashed = lang, slices, hashed
        self.seed = xxhash.xxh64_intdigest(lang.encode(), 42)
        self.tries = {w: PhraseTrie(w) for w in words}
        self.forget()

    def forget(self) -> None:
        self.ids: dict[bytes, int] = {}
        self.names: list[bytes] = []
        self.hashes: list[int] = []
        self.prefixes: list[int] = []

    def run(self, w: int, p: int) -> pa.RecordBatch:
        """Take a subtree out, as a run sorted by phrase or by hash."""
        held = self.tries[w].take(p)
        if self.hashed:
            return self._packed_run(p, held)
        mask, shifts = (1 << _ID_BITS) - 1, [_ID_BITS * i for i in range(w - 1, -1, -1)]
        names = self.names
        rows = sorted((b" ".join([names[key >> s & mask] for s in shifts]), n) for key, n in held.items())
        if self.slices == 1:
            return self._phrase_run(p, {0: rows})
        slices: dict[int, list[tuple[bytes, int]]] = {}
        for row in rows:
            slices.setdefault(xxhash.xxh3_64_intdigest(row[0]) % self.slices, []).append(row)
        return self._phrase_run(p, slices)

    def _phrase_run(self, p: int, slices: dict[int, list[tuple[bytes, int]]]) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], [], []]
        for at, rows in slices.items():
            counts = pack_numbers(np.array([n for _, n in rows], np.int64))
            for column, value in zip(columns, (self.lang, p, at, pack_lines([x for x, _ in rows]), *counts)):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _RUN_SCHEMA)], schema=_RUN_SCHEMA)

    def _packed_run(self, p: int, held: dict[int, int]) -> pa.RecordBatch:
        pairs = np.fromiter(held, np.int64, len(held))
        counts = np.fromiter(held.values(), np.int64, len(held))
        hashes = np.array(self.hashes, np.uint64)
        keys = pair_keys(hashes[pairs >> _ID_BITS], hashes[pairs & ((1 << _ID_BITS) - 1)])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        slices = (keys * np.uint64(self.slices)) >> np.uint64(64 - _PAIR_SHIFT)
        starts = run_starts(slices)
        columns: list[list] = [[], [], [], [], [], []]
        for a, n in zip(starts.tolist(), lengths_of(starts, len(keys)).tolist()):
            row = (self.lang, p, int(slices[a]), pack_sorted(keys[a : a + n]), *pack_numbers(counts[a : a + n]))
            for column, value in zip(columns, row):
                column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PACKED_SCHEMA)], schema=_PACKED_SCHEMA)

    def flush(self) -> Iterator[pa.RecordBatch]:
        for w, trie in self.tries.items():
            for p in range(PREFIXES):
                if trie.sizes[p]:
                    yield self.run(w, p)

    def known(self, words: list[bytes]) -> np.ndarray:
        """Ids of the words; the caller has flushed before they run out."""
        ids, out = self.ids, []
        for word in words:
            i = ids.get(word)
            if i is None:
                i = ids[word] = len(self.names)
                self.names.append(word)
                h = xxhash.xxh64_intdigest(word, self.seed)
                self.hashes.append(h)
                self.prefixes.append(h % PREFIXES)
            out.append(i)
        return np.array(out, np.int64)

    def count(self, texts: list[bytes], bits: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
        """Count the phrases of the texts, a bounded number of words at a time; yields runs that had to leave."""
        tokens = [t for t in b"\n".join(texts).translate(_FOLD).replace(_BREAK, b" \n ").split(b" ") if t]
        for a in range(0, len(tokens), _CHUNK_WORDS):
            some = pa.array(tokens[a : a + _CHUNK_WORDS + max(self.tries) - 1], pa.binary()).dictionary_encode()
            words, at = some.dictionary.to_pylist(), some.indices.to_numpy()
            if len(self.names) + len(words) > 1 << _ID_BITS:
                yield from self.flush()
                self.forget()
            good = np.array([word != _BREAK for word in words])
            if 1 in self.tries:  # all words of the language go under the empty phrase
                total = int(good[at[:_CHUNK_WORDS]].sum())
                yield self._phrase_run(PREFIXES, {0: [(b"", total)]})
            of_word = self.known(words)
            hashes = np.array(self.hashes, np.uint64)[of_word] if bits else None
            if bits:
                good &= in_bitmap(bits[0], hashes)
            ok = good[at]
            paired = ok
            if len(bits) > 1:
                paired = np.zeros(len(at), bool)
                begins = np.flatnonzero(ok[:-1] & ok[1:])
                paired[begins] = in_bitmap(bits[1], pair_keys(hashes[at[begins]], hashes[at[begins + 1]]))
            ids = of_word[at]
            for w, trie in self.tries.items():
                trie.add(*_phrases(w, ids, ok, paired), self.prefixes)
            while sum(map(len, self.tries.values())) > SPILL:
                w = max(self.tries, key=lambda w: len(self.tries[w]))
                yield self.run(w, self.tries[w].largest())


def _phrases(w: int, ids: np.ndarray, ok: np.ndarray, paired: np.ndarray) -> tuple[list[int], list[int]]:
    """Packed ids and counts of the distinct ``w``-word phrases whose words are ``ok`` and whose pairs are ``paired``.

    A phrase is no more frequent than any of its parts.
    """
    count = min(len(ids) - w + 1, _CHUNK_WORDS)
    if count <= 0:
        return [], []
    start = np.ones(count, bool)
    for j in range(w):
        start &= ok[j : j + count]
    for j in range(w - 1):
        start &= paired[j : j + count]
    begins = np.flatnonzero(start)
    packed = np.zeros(len(begins), np.int64)
    for j in range(max(0, w - 3), w):
        packed = packed << _ID_BITS | ids[begins + j]
    if w <= 3:
        keys, n = np.unique(packed, return_counts=True)
        return keys.tolist(), n.tolist()
    lead = ids[begins]  # the fourth id no longer fits in 64 bits
    order = np.lexsort((packed, lead))
    lead, packed = lead[order], packed[order]
    new = run_starts(lead, packed)
    shift = 3 * _ID_BITS
    return ([a << shift | b for a, b in zip(lead[new].tolist(), packed[new].tolist())],
            lengths_of(new, len(lead)).tolist())


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """40 bits for each pair of words, from the hashes of the words."""
    return mix(first * np.uint64(0x9E3779B97F4A7C15) + second) >> np.uint64(_PAIR_SHIFT)


def _frequent_keys(runs: DataFrame, min_count: int) -> DataFrame:
    """Merge the sorted runs of each prefix partition; the keys whose counts add up to ``min_count``."""

    def merge(table: pa.Table) -> pa.Table:
        keys = np.concatenate([unpack_sorted(x) for x in table["keys"].to_pylist()])
        counts = np.concatenate([unpack_numbers(*x) for x in zip(table["known"].to_pylist(), table["at"].to_pylist())])
        order = np.argsort(keys, kind="stable")  # merges what is sorted in parts
        keys, counts = keys[order], counts[order]
        starts = run_starts(keys)
        frequent = np.add.reduceat(counts, starts) >= min_count
        return pa.table([pa.array(keys[starts[frequent]].astype(np.int64))], names=["h"])

    return runs.groupBy("lang", "prefix", "slice").applyInArrow(merge, "h long")


def _runs(documents: DataFrame, words: tuple[int, ...], slices: int, hashed: bool, *bits: np.ndarray) -> DataFrame:
    """The packed runs of all tasks: phrases of so many words, or hashes of pairs."""
    shared = documents.sparkSession.sparkContext.broadcast(bits)  # bitmaps of fixed size

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, _Counter] = {}
        for batch in batches:
            waiting: dict[str, list[bytes]] = {}
            held: dict[str, int] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
                waiting.setdefault(lang, []).append(text)
                held[lang] = held.get(lang, 0) + len(text)
                if held[lang] >= _CHUNK_BYTES:
                    counter = counters.setdefault(lang, _Counter(lang, words, slices, hashed))
                    yield from counter.count(waiting.pop(lang), shared.value)
                    del held[lang]
            for lang, texts in waiting.items():
                counter = counters.setdefault(lang, _Counter(lang, words, slices, hashed))
                yield from counter.count(texts, shared.value)
            # Languages share the memory of a task.
            while sum(sum(map(len, c.tries.values())) for c in counters.values()) > SPILL:
                most = max(counters, key=lambda lang: sum(map(len, counters[lang].tries.values())))
                yield from counters.pop(most).flush()
        for counter in counters.values():
            yield from counter.flush()

    texts = documents.select(
        F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(count, _PACKED_RUNS if hashed else _RUNS)


def _counted(documents: DataFrame, words: tuple[int, ...], slices: int, min_count: int, *bits: np.ndarray) -> DataFrame:
    """``(lang, phrase, n)`` of the phrases of so many words that are frequent (and the empty phrase, with words = 1)."""

    def merge(table: pa.Table) -> pa.Table:
        phrases = pa.chunked_array([pa.array(unpack_lines(x), pa.binary()) for x in table["phrases"].to_pylist()])
        counts = pa.chunked_array([unpack_numbers(*x) for x in zip(table["known"].to_pylist(), table["at"].to_pylist())])
        summed = pa.table([phrases, counts], names=["phrase", "n"]).group_by("phrase").aggregate([("n", "sum")])
        kept = summed.filter(pc.or_(pc.greater_equal(summed["n_sum"], min_count), pc.equal(summed["phrase"], b"")))
        return pa.table([pa.array([table["lang"][0].as_py()] * len(kept), pa.string()), kept["phrase"], kept["n_sum"]],
                        names=["lang", "phrase", "n"])

    runs = _runs(documents, words, slices, False, *bits)
    merged = runs.groupBy("lang", "prefix", "slice").applyInArrow(merge, "lang string, phrase binary, n long")
    return durable(merged.select("lang", F.col("phrase").cast("string").alias("phrase"), "n"))


def collocations(
    documents: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
    covered_percent: int = COVERED_PERCENT, filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` collocations of every language.

    Texts (A-Z lower-cased) are split at ``.,;:!?`` and line ends into pieces, those at spaces and tabs into words. A
    candidate is a phrase of 2 to ``max_words`` (at most 4) words with a = f(phrase) >= ``min_count``. Cut after its
    first k words, with l and r the frequencies of both parts, it scores floor(2000000 a / (l + r)); its lowest cut
    counts, ties to the smallest k. Candidates inside a longer one that makes up ``covered_percent`` of them are dropped.

    1. Every task counts phrases in a burst trie over word ids (:class:`PhraseTrie`); what leaves memory does so by whole
       subtrees, as sorted runs. Words are counted first. Then pairs of frequent words: their runs are packed hashes,
       merged per prefix partition, and tell which pairs may be frequent. Then pairs and longer phrases whose pairs may
       all be frequent, as no phrase is more frequent than its parts. Runs of phrases are packed too, sorted and
       compressed, and merged per prefix partition and slice. The tasks are told what is frequent by bitmaps of ``filter_bits`` bits; false positives are counted and found out.
    2. Cuts, parts and longer phrases are joins of the frequent phrases among themselves; scores are decimals.

    Null text: empty. Null lang: ``und``, one language with rows that say so. Repeated rows count each. Ties of score: larger
    a, then the phrase in byte order. Other columns are ignored. An empty table gives an empty table.
    """
    if not 2 <= max_words <= 4:
        raise ValueError("phrases of 2 to 4 words")
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slices = 1 + _PHRASE_SLICES * size // _SLICE_BYTES
    words = _counted(documents, (1,), slices, min_count)
    totals = words.where("phrase = ''").select("lang", F.col("n").alias("_total"))
    words = words.where("phrase <> ''")
    word_bits = bitmap(words.select(F.xxhash64("lang", "phrase").alias("h")), filter_bits)
    runs = _runs(documents, (2,), 1 + size // _SLICE_BYTES, True, word_bits)
    pair_bits = bitmap(_frequent_keys(runs, min_count), filter_bits)
    grams = words.unionByName(_counted(documents, tuple(range(2, max_words + 1)), slices, min_count, word_bits, pair_bits))

    split = F.split("phrase", " ")
    sized = grams.select("lang", "phrase", F.col("n").alias("a"), F.size(split).alias("_words"), split.alias("_w"))
    candidates = sized.where("_words > 1")
    part = lambda begin, length: F.array_join(F.slice("_w", begin, length), " ")
    cuts = candidates.select(
        "lang", "phrase", "a", "_words", "_w", F.explode(F.sequence(F.lit(1), F.col("_words") - 1)).alias("_k"))
    cuts = cuts.select("lang", "phrase", "a", "_k", part(F.lit(1), F.col("_k")).alias("_left"),
                       part(F.col("_k") + 1, F.col("_words") - F.col("_k")).alias("_right"))
    of = lambda name, n: grams.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    cut = cuts.join(of("_left", "l"), ["lang", "_left"]).join(of("_right", "r"), ["lang", "_right"])
    exact = F.expr(f"(CAST(a AS DECIMAL(20)) * {SCALE}) DIV (CAST(l AS DECIMAL(20)) + r)")
    lowest = cut.withColumn("score", exact).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "_k", "l", "r")).alias("_cut"))

    inner = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("_words") - 1),
        lambda m: F.transform(F.sequence(F.lit(1), F.col("_words") - m + 1), lambda i: part(i, m))))
    covers = candidates.where("_words > 2").select("lang", F.col("a").alias("_longer"), F.explode(inner).alias("phrase"))
    covers = covers.groupBy("lang", "phrase").agg(F.max("_longer").alias("_longer"))
    covered = F.expr(f"CAST(_longer AS DECIMAL(20)) * 100 >= CAST(a AS DECIMAL(20)) * {covered_percent}")
    kept = lowest.join(covers, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    scored = kept.select("lang", "phrase", "a", F.col("_cut.l").alias("l"), F.col("_cut.r").alias("r"),
                         F.col("_cut.score").alias("score"))
    best = top_k_per_group(scored, ["lang"], top, F.desc("score"), F.desc("a"), F.asc("phrase"))
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("_total").alias("n"), "score")


def collocations_sql() -> str:
    """DuckDB SQL for :func:`collocations` of ``documents`` with its usual parameters."""
    delimiters = r"[.,;:!?\x0A-\x0D]"
    sizes = range(1, MAX_WORDS + 1)
    grams = " UNION ALL ".join(
        f"SELECT lang, {m} AS m, unnest(list_transform(range(1, len(w) - {m} + 2), lambda i: array_to_string(w[i:i + {m - 1}], ' ')))"
        f" AS phrase FROM pieces WHERE len(w) >= {m}" for m in sizes)
    return f"""WITH pieces AS (
      SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM (
       SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '{delimiters}')) AS piece FROM documents)),
     totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
     f AS (SELECT lang, m, phrase, count(*) AS a FROM ({grams}) GROUP BY lang, m, phrase HAVING count(*) >= {MIN_COUNT}),
     c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
     cuts AS (SELECT lang, phrase, a, m, w, unnest(range(1, m)) AS k FROM c),
     scored AS (SELECT cuts.lang, cuts.phrase, cuts.a, k, x.a AS l, y.a AS r,
       ({SCALE}::HUGEINT * cuts.a // (x.a + y.a))::BIGINT AS score
      FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.w[1:k], ' ')
      JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.w[k + 1:cuts.m], ' ')
      QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1),
     inner_ AS (SELECT lang, a, w, s, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM c)),
     longer AS (SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS most FROM inner_ GROUP BY ALL),
     kept AS (SELECT scored.* FROM scored LEFT JOIN longer USING (lang, phrase)
      WHERE most IS NULL OR 100 * most < {COVERED_PERCENT} * a)
     SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
     FROM kept JOIN totals USING (lang) QUALIFY rank <= {TOP}"""
