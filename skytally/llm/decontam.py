"""Benchmark windows inside documents, by a prefix-filtered join on rare shingles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from skytally.plans.durable import durable

# Fixed value: what separates words, once A-Z are lower-cased.
_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 3

# Tables of benchmark shingles or windows above this size are joined by shuffle instead of being sent to every task.
BROADCAST_BYTES = 32 << 20


def words(text: str = "text") -> Column:
    """Lower-cased words of a text; none for null."""
    lower = F.translate(F.coalesce(text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, _NO_WORD, -1), "")


def _shingles(of: Column, n: int) -> Column:
    """64-bit hashes of the ``n``-word shingles of a word array."""
    starts = F.sequence(F.lit(0), F.size(of) - n)
    made = F.transform(starts, lambda i: F.xxhash64(*(F.get(of, i + j) for j in range(n))))
    return F.when(F.size(of) >= n, made).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """``(window_id, item_id, words, length)``: the distinct windows of every item.

    An item of fewer words than ``window``, but not none, is one window.
    """
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), words().alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    cut = items.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words"))
    return cut.distinct().select(
        F.sha2(F.array_join("words", " "), 256).alias("window_id"), "item_id", "words", F.size("words").alias("length"))


def _bounded(table: DataFrame, row_bytes: int) -> DataFrame:
    """Broadcast ``table`` if its measured size allows that."""
    return F.broadcast(table) if table.count() * row_bytes <= BROADCAST_BYTES else table


def contaminated_words(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
) -> DataFrame:
    """``(doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated, hit_spans)`` of each document.

    A document word is hit if it lies in an occurrence of a benchmark window. Built-in functions only:

    1. The benchmark's shingles (``shingle`` words; a shorter window is one shingle) are counted over all documents in
       the same pass that finds their occurrences.
    2. Each window orders its shingles by rarity. To contain the window a document has to contain all of them, so a
       prefix of one shingle, the rarest, is necessary: only its occurrences are joined with the window.
    3. Length and position bound the place: an occurrence at word p of a shingle at offset o asks for words p - o to
       p - o + length, which the document must have.
    4. The words there are compared with the window's.

    Null or word-free text: no words, no hits. Items without words have no window. Null item ids are windows that hit,
    but no item. Documents with equal ids are told apart by their text, rows that repeat get equal rows, and a null id
    is an id. Other columns are ignored. An empty table gives an empty table; an empty benchmark hits nothing.
    """
    windows = durable(benchmark_windows(benchmark, window, shingle))
    texts = durable(windows.select("window_id", "words", "length").distinct())
    # offset of each shingle in its window
    sizes = [r.n for r in texts.select(F.least("length", F.lit(shingle)).alias("n")).distinct().collect()]
    offsets = [
        texts.where(F.least("length", F.lit(shingle)) == n).select(
            "window_id", "words", "length", F.posexplode(_shingles(F.col("words"), n)).alias("offset", "shingle"),
        ).withColumn("shingle", F.xxhash64(F.lit(n), "shingle"))
        for n in sizes]
    rows = documents.select("doc_id", words().alias("w")).withColumn("n_words", F.size("w"))
    key = F.xxhash64("w").alias("text_key")
    if not sizes:
        return _result(rows.select("doc_id", key, "n_words"), None)
    offsets = durable(reduce(DataFrame.unionByName, offsets))
    wanted = durable(offsets.select("shingle").distinct())
    small = wanted.count() * 64 <= BROADCAST_BYTES

    def around(found: DataFrame) -> DataFrame:
        """The words around an occurrence, as far as any window over it can reach."""
        reach = F.slice("w", F.greatest(F.col("at") - window + 2, F.lit(1)), 2 * window)
        return found.select(
            "doc_id", "text_key", "n_words", "shingle", "at",
            F.greatest(F.col("at") - window + 1, F.lit(0)).alias("from"), reach.alias("around"))

    found = []
    for n in sizes:
        at = rows.select(
            "doc_id", key, "n_words", "w", F.posexplode(_shingles(F.col("w"), n)).alias("at", "shingle"),
        ).withColumn("shingle", F.xxhash64(F.lit(n), "shingle"))
        # a shuffled shingle leaves its text's words behind
        found.append(around(at.join(F.broadcast(wanted), "shingle")) if small else at.drop("w").join(wanted, "shingle"))
    found = durable(reduce(DataFrame.unionByName, found))
    if not small:
        texts_of = rows.select(F.col("doc_id").alias("_d"), key.alias("_t"), "w").dropDuplicates(["_d", "_t"])
        found = durable(around(found.join(
            texts_of, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")))))

    frequency = found.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"))
    rarest = Window.partitionBy("window_id").orderBy("n", "shingle", "offset")
    prefix = durable(
        offsets.join(frequency, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(0)))
        .withColumn("rank", F.row_number().over(rarest)).where("rank = 1")
        .select("window_id", "words", "length", "offset", "shingle"))
    start = F.col("at") - F.col("offset")
    hits = durable(
        found.join(_bounded(prefix, 64 * window), "shingle")
        .where((start >= 0) & (start + F.col("length") <= F.col("n_words")))
        .where(F.slice("around", start - F.col("from") + 1, F.col("length")) == F.col("words"))
        .select("doc_id", "text_key", "window_id", start.alias("start"), (start + F.col("length")).alias("end"))
        .distinct())
    items = windows.select("window_id", "item_id").where("item_id IS NOT NULL")
    of_items = hits.select("doc_id", "text_key", "window_id").distinct().join(
        _bounded(items, 128), "window_id").select("doc_id", "text_key", "item_id").distinct()
    by_items = of_items.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    by_spans = hits.groupBy("doc_id", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))  # of one text
    hit = by_spans.join(by_items.withColumnsRenamed({"doc_id": "_d", "text_key": "_t"}),
                        F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")), "left")
    hit = hit.select("doc_id", "text_key", "spans", "items")
    return _result(rows.select("doc_id", key, "n_words"), durable(hit))


def _result(rows: DataFrame, hit: DataFrame | None) -> DataFrame:
    span = "array<struct<start: int, end: int>>"
    if hit is None:
        rows = rows.withColumn("spans", F.lit(None).cast(span)).withColumn("items", F.lit(None).cast("array<string>"))
    else:
        hit = hit.withColumnsRenamed({"doc_id": "_d", "text_key": "_t"})
        rows = rows.join(hit, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_t")), "left")
    # spans are ordered by start: each adds what lies beyond the last end
    covered = F.aggregate(
        F.coalesce("spans", F.array().cast(span)), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda s, x: F.struct(
            F.greatest(s["end"], x["end"]).alias("end"),
            (s["n"] + F.greatest(x["end"] - F.greatest(s["end"], x["start"]), F.lit(0))).alias("n")),
        lambda s: s["n"])
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        "doc_id", "text_key", F.col("n_words").cast("long").alias("n_words"), covered.cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (covered > 0).alias("contaminated"), F.coalesce("spans", F.array().cast(span)).alias("hit_spans"))


def clean_documents(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
) -> DataFrame:
    """The rows of ``documents``, with all their columns, that hold no benchmark window.

    Whether a row goes depends on its text alone, so the words' hash tells the rows to drop.
    """
    rated = contaminated_words(documents, benchmark, window, shingle)
    key = "clean_documents.text_key"  # no column of the caller's
    bad = _bounded(durable(rated.where("contaminated").select(F.col("text_key").alias(key)).distinct()), 64)
    rows = documents.withColumn(key, F.xxhash64(words()))
    return rows.join(bad, key, "left_anti").select(*documents.columns)


def decontamination_sql(window: int = WINDOW) -> str:
    """DuckDB SQL for the rows of :func:`contaminated_words` over ``documents`` and ``benchmark``, by plain windows."""
    of_text = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
               r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
    WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {of_text} AS w FROM benchmark),
    cut AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - {window - 1}, 1) + 1)) AS i FROM items WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item_id, array_to_string(list_slice(w, i, i + {window - 1}), ' ') AS words,
     least(len(w), {window}) AS n FROM cut),
    docs AS (SELECT doc_id, {of_text} AS w FROM documents),
    starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows)),
    places AS (SELECT doc_id, i, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS words FROM starts),
    hits AS (SELECT DISTINCT doc_id, i, places.n, item_id FROM places JOIN windows USING (words)),
    covered AS (SELECT doc_id, count(DISTINCT place) AS n_hit
     FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
    found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids
     FROM hits GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
     sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""
