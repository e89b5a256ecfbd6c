"""Exact Jaccard join of word-shingle sets, by partitioned signatures, down to connected groups."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from skytally.llm.packing import (
    PACKED, dealt, distinct, mix, packed_rows, read_replies, replies, texts_of, window_hashes, word_hashes,
)
from skytally.operators.graph import connected_components
from skytally.plans.durable import durable

_UPPER = bytes(range(65, 91))
_LOWER = _UPPER.lower()
_FOLD = bytes.maketrans(_UPPER, _LOWER)

# Up to this many differences a size band is cut into few segments that may each differ by one deletion.
DELETION_LIMIT = 3

_SETS = "doc_id long, n_shingles long, set_key binary"
_FACTS = ("size", "sketch", "packed_text")  # of a document, on one of its rows
_KEPT = "doc_id long, signature long, size long, sketch array<long>, packed_text binary"


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """Ascending distinct 64-bit hashes of the ``n``-word shingles; of the whole sequence if it is shorter."""
    words = word_hashes(text.translate(_FOLD).split())
    if not len(words):
        return words
    return distinct(window_hashes(words, min(n, len(words))) ^ np.uint64(0 if len(words) >= n else len(words)))


class Bands:
    """Size bands of sets, and the segments into which a band's universe is cut.

    Two sets with Jaccard ``num/den`` or more lie in one band or in neighbouring ones, and the smaller one's band k
    bounds their symmetric difference by H(k). A set is signed in its own band and in the one below.
    """

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.lows = [1]
        self._cuts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _low(self, k: int) -> int:
        while len(self.lows) <= k:
            self.lows.append(self.lows[-1] * self.den // self.num + 1)
        return self.lows[k]

    def differences(self, k: int) -> int:
        """H(k): the most elements in which a set of band k and a linked set of its size or more can differ."""
        return (self._low(k + 1) - 1) * (self.den - self.num) // self.num

    def of(self, size: int) -> list[int]:
        while self.lows[-1] <= size:
            self._low(len(self.lows))
        own = bisect_right(self.lows, size) - 1
        return [k for k in (own - 1, own) if k >= 0 and self.differences(k)]

    def segments(self, k: int) -> int:
        """How many segments band k has.

        With H differences at most, cutting into H + 1 + E segments leaves E + 1 of them equal, so that each set may
        leave out its E costliest signatures. E = H keeps the rarer half. Bands of few differences take half as many
        segments as differences, one of which then differs by one element at most.
        """
        h = self.differences(k)
        return h // 2 + 1 if h <= DELETION_LIMIT else 2 * h + 1

    def cuts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the segments of band k begin among all 64-bit hashes (but the first), and a salt for each segment."""
        if k not in self._cuts:
            m = self.segments(k)
            begins = np.array([i * 2**64 // m for i in range(1, m)], np.uint64)
            self._cuts[k] = begins, mix(np.uint64(k << 32) + np.arange(m, dtype=np.uint64))
        return self._cuts[k]


def _spread(shingles: np.ndarray) -> np.ndarray:
    return mix(shingles ^ np.uint64(0x5851F42D4C957F2D))


def sketch(shingles: np.ndarray) -> list[int]:
    """How many shingles fall in each of 1,024 cells, as odd or even, in 16 numbers.

    An element in which two sets differ changes one cell, so the sketches differ in at most as many bits as the sets
    in elements.
    """
    odd = np.bincount((_spread(shingles) >> np.uint64(54)).astype(np.int64), minlength=1024) & 1
    return np.packbits(odd.astype(bool)).view(np.int64).tolist()


def signatures(shingles: np.ndarray, bands: Bands) -> list[tuple[int, np.ndarray]]:
    """For each band that a set is signed in: how many signatures it has to keep, and all of them."""
    spread = _spread(shingles)
    sums = np.r_[np.uint64(0), np.cumsum(spread, dtype=np.uint64)]
    found = []
    for k in bands.of(len(shingles)):
        begins, salt = bands.cuts(k)
        edges = np.r_[0, np.searchsorted(shingles, begins), len(shingles)]
        content = np.diff(sums[edges])
        exact = mix(content + salt)
        h = bands.differences(k)
        if h <= DELETION_LIMIT:
            at = np.repeat(np.arange(len(salt)), np.diff(edges))
            found.append((len(shingles) + len(salt), distinct(np.r_[exact, mix(content[at] - spread + salt[at])])))
        else:
            found.append((h + 1, exact))
    return found


def _cost(group: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many sets hold a signature, as a byte: exact below 128, then in eighths of a power of two."""
    total = np.bincount(group, counts).astype(np.int64)
    coarse = 128 + np.floor(8 * np.log2(np.maximum(total, 128) / 128)).astype(np.int64)
    return np.minimum(np.where(total < 128, total, coarse), 255).astype(np.uint8)[group]


def _sets(documents: DataFrame, n: int) -> DataFrame:
    """``(doc_id, n_shingles, set_key)`` of every document; the key is a 128-bit hash of the set."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys = [], []
            for text in texts_of(batch):
                found = shingle_set(text, n)
                sizes.append(len(found))
                keys.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary())],
                names=["doc_id", "n_shingles", "set_key"])

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(read, _SETS)


def _kept_signatures(documents: DataFrame, chosen: DataFrame, n: int, bands: Bands) -> DataFrame:
    """Signatures that a set shares with another one and that are among its cheapest; one row each.

    ``chosen`` has the (doc_id, set_key) of one document for each distinct set. The first row of a document carries
    its text, compressed, for the exact comparison.
    """
    docs, ranges = dealt(documents)
    # The keys travel with the row's batch, which only its text decides.
    keyed = durable(docs.select("batch", "doc_id").distinct().join(chosen, "doc_id")).select(
        F.col("batch").alias("batch"), F.col("doc_id").alias("doc_id"), "set_key")

    def of_batch(table: pa.Table, wanted: pa.Table) -> list[tuple]:
        found = []
        left = set(zip(wanted["doc_id"].to_pylist(), wanted["set_key"].to_pylist()))
        for doc_id, text in zip(table["doc_id"].to_pylist(), texts_of(table)):
            shingles = shingle_set(text, n) if left else ()
            if len(shingles) and (key := (doc_id, xxhash.xxh3_128_digest(shingles.tobytes()))) in left:
                left.discard(key)
                found.append((doc_id, text, shingles, signatures(shingles, bands)))
        return found

    def every(found: list) -> np.ndarray:
        parts = [s for *_, of_bands in found for _, s in of_bands]
        return np.concatenate(parts) if parts else np.empty(0, np.uint64)

    def send(key: tuple[pa.Scalar, ...], table: pa.Table, wanted: pa.Table) -> pa.Table:
        signed = np.sort(every(of_batch(table, wanted)))
        first = np.flatnonzero(np.r_[True, signed[1:] != signed[:-1]]) if len(signed) else np.empty(0, np.int64)
        keys, counts = signed[first], np.diff(np.r_[first, len(signed)])
        return packed_rows(key[0].as_py(), keys, counts, ranges)

    def keep(table: pa.Table, told: pa.Table) -> pa.Table:
        wanted = told.filter(pa.compute.is_valid(told["set_key"]))
        found = of_batch(table, wanted)
        keys = distinct(every(found))
        costs = read_replies(told.filter(pa.compute.is_valid(told["reply"])))
        ids, kept, sizes, sketches, packed = [], [], [], [], []
        for doc_id, text, shingles, of_bands in found:
            mine = []
            for need, signed in of_bands:
                cost = costs[np.searchsorted(keys, signed)]
                cheapest = np.lexsort((signed, cost))[:need]
                mine.append(signed[cheapest[cost[cheapest] > 1]])
            mine = np.concatenate(mine) if mine else np.empty(0, np.uint64)
            if len(mine):
                ids += [doc_id] * len(mine)
                kept += mine.view(np.int64).tolist()
                sizes += [len(shingles)] + [None] * (len(mine) - 1)
                sketches += [sketch(shingles)] + [None] * (len(mine) - 1)
                packed += [zstandard.ZstdCompressor(level=1).compress(text)] + [None] * (len(mine) - 1)
        return pa.table(
            [pa.array(ids, pa.int64()), pa.array(kept, pa.int64()), pa.array(sizes, pa.int64()),
             pa.array(sketches, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
            names=["doc_id", "signature", "size", "sketch", "packed_text"])

    by_batch = docs.groupBy("batch")
    sent = by_batch.cogroup(keyed.groupBy("batch")).applyInArrow(send, PACKED)
    told = replies(sent, _cost).withColumn("doc_id", F.lit(None).cast("long")).withColumn(
        "set_key", F.lit(None).cast("binary")
    ).unionByName(keyed, allowMissingColumns=True)
    return by_batch.cogroup(told.groupBy("batch")).applyInArrow(keep, _KEPT)


def _may_link(num: int, den: int) -> Column:
    """Whether sizes and sketches leave room for the similarity; true for every linked pair."""
    differ = reduce(Column.__add__, [F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i]))
                                     for i in range(16)])
    near = F.greatest("size_a", "size_b") * num <= F.least("size_a", "size_b") * den
    return near & (differ * (den + num) <= (F.col("size_a") + F.col("size_b")) * (den - num))


def _linked(pairs: DataFrame, texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The ``(a, b)`` of ``pairs`` whose sets reach the similarity exactly."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        last, left = None, np.empty(0, np.uint64)
        for batch in batches:
            out: list[bool] = []
            for text_a, text_b in zip(batch["packed_text_a"].to_pylist(), batch["packed_text_b"].to_pylist()):
                if text_a != last:
                    last, left = text_a, shingle_set(unpack(text_a), n)
                right = shingle_set(unpack(text_b), n)
                common = len(np.intersect1d(left, right, assume_unique=True))
                out.append(den * common >= num * (len(left) + len(right) - common))
            yield batch.select(["a", "b"]).filter(pa.array(out, pa.bool_()))

    sides = [texts.select(F.col("doc_id").alias(s), *(F.col(c).alias(f"{c}_{s}") for c in _FACTS)) for s in "ab"]
    return (
        pairs.join(sides[1], "b").join(sides[0], "a").where(_may_link(num, den))
        .select("a", "b", "packed_text_a", "packed_text_b").mapInArrow(compare, "a long, b long"))


def _groups(nodes: DataFrame, links: DataFrame) -> DataFrame:
    return connected_components(nodes, links.select(F.col("a").alias("src"), F.col("b").alias("dst")))


def _candidates(shared: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """The ``(a, b)`` of all sets that share a signature and may be linked.

    Signatures held by the same sets give the same pairs, so one of them is joined: sets are told apart by their
    number, ends and three sums of hashes.
    """
    told = [F.count(F.lit(1)).alias("_n"), F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b")]
    told += [F.sum(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(i)), 32)).alias(f"_h{i}") for i in range(3)]
    holders = shared.groupBy("signature").agg(*told).where("_a < _b")
    once = holders.groupBy("_n", "_a", "_b", "_h0", "_h1", "_h2").agg(F.min("signature").alias("signature"))
    held = durable(shared.join(once.select("signature"), "signature").join(texts.drop("packed_text"), "doc_id"))
    sides = [held.select("signature", F.col("doc_id").alias(s), *(
        F.col(c).alias(f"{c}_{s}") for c in ("size", "sketch"))) for s in "ab"]
    return sides[0].join(sides[1], "signature").where("a < b").where(_may_link(num, den)).select("a", "b").distinct()


def _connected(shared: DataFrame, texts: DataFrame, nodes: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """``(id, component)`` of the nodes, by as many links as connect them."""
    pivots = durable(shared.groupBy("signature").agg(
        F.min("doc_id").alias("a"), F.max("doc_id").alias("_last")).where("a < _last").drop("_last"))
    tested = durable(shared.join(pivots, "signature").select("a", F.col("doc_id").alias("b")).where("a < b").distinct())
    links = durable(_linked(tested, texts, n, num, den))
    groups = durable(_groups(nodes, links))

    placed = durable(shared.join(groups.withColumnRenamed("id", "doc_id"), "doc_id"))
    open_signatures = durable(placed.groupBy("signature").agg(
        F.min("component").alias("_x"), F.max("component").alias("_y")).where("_x < _y").select("signature"))
    left = durable(placed.join(open_signatures, "signature").join(texts.drop("packed_text"), "doc_id"))
    sides = [left.select("signature", F.col("doc_id").alias(s), *(
        F.col(c).alias(f"{c}_{s}") for c in ("component", "size", "sketch"))) for s in "ab"]
    rest = (
        sides[0].join(sides[1], "signature").where("a < b AND component_a <> component_b").where(_may_link(num, den))
        .select("a", "b").distinct().join(tested, ["a", "b"], "left_anti"))
    more = durable(_linked(durable(rest), texts, n, num, den))
    return groups if more.isEmpty() else _groups(nodes, links.unionByName(more))


def jaccard_groups(
    documents: DataFrame, n: int = 5, num: int = 4, den: int = 5, count_links: bool = True) -> DataFrame:
    """``(doc_id, n_shingles, component_id, n_links)``: groups connected by ``|A and B| * den >= num * |A or B|``.

    A set holds the distinct ``n``-word shingles of a whole text (A-Z lower-cased, words without ASCII white space);
    shorter texts are one shingle, texts without a word have none and link with nothing. ``component_id`` is the
    smallest id in the group; ``n_links`` counts all other distinct sets that the document's set is linked with. Sets of
    one id are one node. Without ``count_links`` the column is left out and only the links that connect the groups are
    looked for.

    1. Documents with equal sets are one set from here on.
    2. Each size band cuts the universe of hashes into segments; the hash of a set's part in a segment is a signature
       (:class:`Bands`). Pigeonhole: of 2 H + 1 segments, at most H differ. Small bands index one-deletion
       neighbourhoods instead.
    3. Signatures are counted over the corpus and each set keeps its H + 1 rarest (one common order, so that the rarest
       equal segment of a linked pair is kept by both). Frequent passages, empty segments and the unchanged parts of
       large groups of copies are thereby left out without losing a link.
    4. All sets that share a kept signature are compared with each other; of signatures that the same sets keep one
       does. Sketches of 1,024 bits, whose distance never exceeds that of the sets, turn most of these pairs away inside
       the join; the others are compared exactly, on their texts. Without ``count_links`` they are first compared with
       the smallest of them, and then only those of different groups with each other.

    Null ids: the row keeps its shingle count, has no component and links with nothing. Rows with one id are one node.
    Other columns are ignored; an empty table gives an empty table.
    """
    bands = Bands(num, den)
    sets = durable(_sets(documents, n))
    first = durable(
        sets.where("doc_id IS NOT NULL AND set_key IS NOT NULL").groupBy("set_key").agg(F.min("doc_id").alias("rep")))
    chosen = first.select(F.col("rep").alias("doc_id"), "set_key")
    kept = durable(_kept_signatures(documents.where("doc_id IS NOT NULL"), chosen, n, bands))
    texts = kept.where("packed_text IS NOT NULL").select("doc_id", *_FACTS)
    shared = kept.select("doc_id", "signature")

    nodes = durable(shared.select(F.col("doc_id").alias("id")).distinct())
    if count_links:
        every = durable(_linked(durable(_candidates(shared, texts, num, den)), texts, n, num, den).distinct())
        merged = _groups(nodes, every)
    else:
        every, merged = None, _connected(shared, texts, nodes, n, num, den)

    of_set = first.join(merged.withColumnRenamed("id", "rep"), "rep", "left")
    if every is not None:
        of_set = of_set.join(every.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(
            F.count(F.lit(1)).alias("n_links")), "rep", "left")
    of_set = durable(of_set.withColumn("_c", F.coalesce("component", "rep")).drop("rep", "component"))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_c", "doc_id")).alias("component_id")
    counted = [F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")] if count_links else []
    return sets.join(of_set, "set_key", "left").select("doc_id", "n_shingles", component, *counted)


def one_of_each_group(documents: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One row of each group of ``documents``, with all columns: the one of the smallest id.

    Rows that share an id or have none are told apart by their text: they get a number of their own by a 64-bit hash of
    id and text, above all ids of other rows. So different texts of one id stay apart, equal rows are one, and copies
    without an id go where a row with an id is in their group. Texts without a word are groups of their own.
    """
    node = "one_of_each_group.node"  # no column of the caller's
    unclear = durable(documents.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").select("doc_id"))
    own = F.col("doc_id").cast("long")
    if unclear.isEmpty():
        named = documents.withColumn(node, own)
    else:
        told = F.lit(1 << 62).bitwiseOR(F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)))
        flag = unclear.select(F.col("doc_id").alias("_id"), F.lit(True).alias("_unclear"))
        rows = documents.select(F.struct(*documents.columns).alias("input"))
        rows = rows.join(flag, F.col("input.doc_id").eqNullSafe(F.col("_id")), "left")
        rows = durable(rows.select(*[F.col("input")[c].alias(c) for c in documents.columns], F.col("_unclear").alias(node)))
        named = rows.withColumn(node, F.when(F.col(f"`{node}`"), told).otherwise(own))
    groups = jaccard_groups(named.select(F.col(f"`{node}`").alias("doc_id"), "text"), n, num, den, count_links=False)
    first = durable(groups.where("component_id = doc_id").select(F.col("doc_id").alias(node)).distinct())
    return named.join(first, [node], "left_semi").dropDuplicates([node]).select(*documents.columns)
