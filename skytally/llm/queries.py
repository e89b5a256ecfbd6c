"""One query per operator with its production parameters, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skytally.llm.byte_dedup import remove_repeated_bytes
from skytally.llm.collocations import collocations, collocations_sql
from skytally.llm.decontam import contaminated_words, decontamination_sql
from skytally.llm.mixing import mix_sources, mixing_sql
from skytally.llm.near import jaccard_groups
from skytally.llm.quality import score_quality, train_quality
from skytally.llm.resampling import resample, resampling_sql
from skytally.llm.rules import quality_rules
from skytally.llm.secrets import scan_secrets, secrets_sql
from skytally.llm.substrings import remove_repeated_windows
from skytally.llm.token_counts import count_tokens, recount_edited
from skytally.llm.token_files import read_token_pages, write_token_pages
from skytally.llm.toxicity import score_toxicity, train_toxicity
from skytally.plans.durable import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def grade() -> Column:
    """Graded rating of a labelled document: 0 poor, 1 good but toxic, 2 good."""
    return F.col("quality") * (2 - F.col("toxic"))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_toxicity(docs, train_toxicity(docs, table(spark, folder, "labels")))


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents")).drop("secrets")


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "token_pages")
    write_token_pages(table(spark, folder, "documents"), path)
    return read_token_pages(spark, path)


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score_quality(docs, train_quality(docs, table(spark, folder, "labels"), grade()))


def op5_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_groups(table(spark, folder, "documents"), n=4, num=85, den=100, count_links=False)


def document_edits() -> Column:
    """Three edits of each text, made from the text itself: a replacement, an insertion, and a cut at the end."""
    length = F.length("text").cast("long")
    place = F.pmod(F.xxhash64("doc_id"), F.greatest(length, F.lit(1)))
    other = F.pmod(F.xxhash64("doc_id", F.lit("from")), F.greatest(length, F.lit(1)))
    copied = F.substring("text", (other + 1).cast("int"), F.lit(40))

    def change(start: Column, end: Column, text: Column) -> Column:
        return F.struct(start.alias("start"), end.alias("end"), text.alias("text"))

    return F.array(
        change(place, place + 17, copied),
        change(other, other, F.concat(F.lit(" "), F.reverse(copied))),
        change(F.greatest(length - 25, F.lit(0)), length + 40, F.lit("")))


def op6_edited_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = count_tokens(table(spark, folder, "documents").select("doc_id", "text"))
    counted = counted.withColumns({"n_tokens_before": F.col("n_tokens"), "edits": document_edits()})
    return recount_edited(counted).select("doc_id", "n_tokens_before", "n_tokens", "n_reencoded")


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return remove_repeated_windows(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return contaminated_words(docs, items).drop("text_key", "hit_spans")


def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix_sources(table(spark, folder, "documents"))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(table(spark, folder, "documents"))


def op11_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, folder, "documents")).drop("removed")


def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_toxicity, op2_secret_scan, op3_token_files, op4_quality_classifier, op5_ngram_jaccard_join,
    op6_edited_token_counts, op7_substring_dedup, op8_benchmark_decontamination, op9_mix_sources, op10_quality_rules,
    op11_suffix_array_dedup, op12_importance_resampling, op13_phrase_collocations)}

ORACLES: dict[str, str] = {
    "op2_secret_scan": secrets_sql(),
    "op8_benchmark_decontamination": decontamination_sql(),
    "op9_mix_sources": mixing_sql(),
    "op12_importance_resampling": resampling_sql(),
    "op13_phrase_collocations": collocations_sql(),
}
