"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skytally.plans.durable import durable

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
CELLS = 4096

# A table of sources above this size is joined by shuffle instead of being sent to every task.
PLAN_BYTES = 8 << 20


def word_count(text: str = "text") -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cell(doc_id: str = "doc_id", seed: str = SEED) -> Column:
    """The seeded cell, 0 to 4095, that decides about a document's fractional repetition."""
    name = F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("/"), F.lit(seed))
    return F.conv(F.substring(F.md5(name), 1, 3), 16, 10).cast("int")


def water_fill(sources: DataFrame, weights: Sequence[float], share: float, epochs: int) -> DataFrame:
    """``(source, source_size, target)`` for ``(source, source_size)``.

    The sources in order of code points, null last, take ``weights`` in turn and share ``share`` times all sizes by
    weight, but none more than ``epochs`` times its own size; the excess is shared again among the others. With the
    sources ordered by size over weight, those before the water level are full, and the level follows from what they
    leave. A window over one row per source does it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    filled = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    after = filled.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    every = Window.partitionBy()
    level = (
        (F.sum("source_size").over(every) * F.lit(share) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / F.sum("weight").over(after))
    return (
        sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs)
        .withColumn("level", level)
        .withColumn("water", F.max(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))).over(every))
        .select("source", "source_size", F.least(
            F.col("cap").cast("double"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap").cast("double")),
        ).alias("target")))


def source_plan(sized: DataFrame, weights: Sequence[float], share: float, epochs: int) -> DataFrame:
    """For each source: target, whole repetitions, and the cell at which the fractional one ends.

    ``sized`` has source, size and cell. Sizes are summed per source and cell before anything is ordered, so a source
    is at most 4,096 rows here.
    """
    by_cell = durable(sized.groupBy("source", "cell").agg(F.sum("size").alias("cell_size")))
    targets = water_fill(by_cell.groupBy("source").agg(F.sum("cell_size").alias("source_size")), weights, share, epochs)
    targets = durable(targets.withColumn("whole", F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)).withColumn(
        "rest", F.floor(F.col("target") - F.col("whole") * F.col("source_size") + F.lit(0.5)).cast("long")))
    running = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        by_cell.withColumn("below", F.coalesce(F.sum("cell_size").over(running), F.lit(0)))
        .withColumnRenamed("source", "_source"))
    at_end = ends.join(targets.select("source", "rest"), F.col("_source").eqNullSafe(F.col("source"))).where(
        "below <= rest AND rest < below + cell_size").select("_source", "cell", "cell_size", "below")
    return targets.join(at_end, F.col("source").eqNullSafe(F.col("_source")), "left").select(
        "source", "source_size", "target", "whole",
        F.coalesce("cell", F.lit(CELLS)).alias("end_cell"),
        F.coalesce(F.col("rest") - F.col("below"), F.lit(0)).alias("end_part"),
        F.coalesce("cell_size", F.lit(1)).alias("end_size"))


def with_plan(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Join each row with its source's plan and add ``taken``: the words that the mix takes of it."""
    plan = durable(plan).withColumnRenamed("source", "_source")
    row = plan.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("_source")).alias("b")).first()
    if row.n * 64 + (row.b or 0) <= PLAN_BYTES:
        plan = F.broadcast(plan)
    part = F.expr("size * end_part div end_size")
    extra = F.when(F.col("cell") < F.col("end_cell"), F.col("size")).when(
        F.col("cell") == F.col("end_cell"), part).otherwise(0)
    return sized.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "taken", (F.col("whole") * F.col("size") + extra).cast("long"))


def mix_sources(
    documents: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, epochs: int = 2, seed: str = SEED,
) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``: how many words the mix takes of each document.

    Targets are those of :func:`water_fill`. A document is repeated whole as often as the target holds its source's
    size; of the rest, documents whose seeded cell lies before the source's end cell take one more whole repetition,
    and those in the end cell the fraction of one that is still missing. So a source's words come within one word per
    document of 1/4096 of it to the target, and no document exceeds ``epochs`` repetitions.

    Null text or text without words: size 0, taken 0. A null source is a source of its own and the last in order.
    Rows with equal ids share a cell and are decided alike; null ids share one. Other columns are ignored. An empty
    table gives an empty table.
    """
    sized = durable(documents.select(
        "doc_id", "source", word_count().alias("size"), cell(seed=seed).alias("cell")))
    return with_plan(sized, source_plan(sized, weights, share, epochs)).select(
        "doc_id", "size", "source_size", "target", "taken")


def mixed_documents(
    documents: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, epochs: int = 2, seed: str = SEED,
) -> DataFrame:
    """The rows of the mix, with the columns of ``documents``: whole repetitions, and the first words of a last part
    joined by spaces.

    ``n_chars``, where there is one, follows the text. Documents of which nothing is taken have no row.
    """
    columns = documents.columns
    sized = documents.select(
        F.struct(*columns).alias("input"), "source", word_count().alias("size"), cell(seed=seed).alias("cell"))
    taken = with_plan(sized, source_plan(sized.select("source", "size", "cell"), weights, share, epochs))
    copies = F.expr("CASE WHEN size = 0 THEN 0L ELSE taken div size END")
    part = F.expr("CASE WHEN size = 0 THEN 0L ELSE taken % size END")
    rows = taken.select("input", copies.alias("copies"), part.alias("part")).select("input", "part", F.explode(
        F.concat(F.array_repeat(F.lit(True), F.col("copies").cast("int")),
                 F.array_repeat(F.lit(False), F.when(F.col("part") > 0, 1).otherwise(0)))).alias("whole"))
    words = F.regexp_extract_all("input.text", F.lit(WORD), F.lit(0))
    begin = F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), " ")
    rows = rows.select("input", "whole", F.when(F.col("whole"), F.col("input.text")).otherwise(begin).alias("text"))
    follows = {
        "text": F.col("text"),
        "n_chars": F.when(F.col("whole"), F.col("input.n_chars") if "n_chars" in columns else None).otherwise(
            F.length("text").cast("long"))}
    return rows.select(*[follows.get(c, F.col("input")[c]).alias(c) for c in columns])



def mixing_sql(documents: str = "documents", seed: str = SEED) -> str:
    """DuckDB SQL of :func:`mix_sources` with its default parameters."""
    return rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '/{seed}'), 1, 3) AS INTEGER) AS cell
  FROM {documents}),
by_cell AS (SELECT source, cell, CAST(sum(size) AS BIGINT) AS cell_size FROM sized GROUP BY source, cell),
sources AS (
  SELECT source, CAST(sum(cell_size) AS BIGINT) AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM by_cell GROUP BY source),
filled AS (
  SELECT *, source_size * 2 AS cap,
         (CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 - coalesce(CAST(sum(source_size * 2) OVER (
            ORDER BY source_size * 2 / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
            AS DOUBLE), 0))
         / sum(weight) OVER (
            ORDER BY source_size * 2 / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         AS level FROM sources),
level AS (SELECT max(level) AS water FROM filled WHERE cap > level * weight),
targets AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), coalesce(water * weight, CAST(cap AS DOUBLE))) AS target
  FROM filled, level),
parted AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets),
rests AS (SELECT *, CAST(floor(target - whole * source_size + 0.5) AS BIGINT) AS rest FROM parted),
running AS (
  SELECT *, CAST(coalesce(sum(cell_size) OVER (
    PARTITION BY source ORDER BY cell ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS below
  FROM by_cell)
SELECT d.doc_id, d.size, r.source_size, r.target,
       CAST(r.whole * d.size + CASE WHEN e.cell IS NULL OR d.cell < e.cell THEN d.size
                                    WHEN d.cell = e.cell THEN d.size * (r.rest - e.below) // e.cell_size
                                    ELSE 0 END AS BIGINT) AS taken
FROM sized d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source
LEFT JOIN running e ON e.source IS NOT DISTINCT FROM r.source AND e.below <= r.rest AND r.rest < e.below + e.cell_size
"""
