"""Word counts and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skytally.functions.text import COMMON_WORDS, SENTENCE_DELIMITERS, delimiter_class, format_top_words
from skytally.functions.text import tokenize_sentence
from skytally.plans.joins import fits_broadcast
from skytally.plans.ranking import top_k


def words_of(lines: DataFrame, tokens: Column) -> DataFrame:
    return lines.select(F.explode(tokens).alias("word"))


def _words_between(lines: DataFrame, text: Column, pattern: str) -> DataFrame:
    """Non-empty words. Empty ones are dropped as rows: a filter inside the array would leave generated code."""
    return words_of(lines, F.split(text, pattern)).where(F.col("word") != "")


def title_words(lines: DataFrame, delimiters: str) -> DataFrame:
    """Lower-case words of the column ``value``, split by delimiter characters; other white space stays in them."""
    return _words_between(lines, F.lower("value"), delimiter_class(delimiters))


def sentence_words(lines: DataFrame, keep_empty: bool = False) -> DataFrame:
    if keep_empty:
        return words_of(lines, tokenize_sentence(F.col("value"), keep_empty))
    return _words_between(lines, F.col("value"), SENTENCE_DELIMITERS)


def normalized_words(words: DataFrame) -> DataFrame:
    """Lower-case words without the common ones."""
    lowered = words.select(F.lower("word").alias("word"))
    return lowered.where(~F.col("word").isin(*COMMON_WORDS))


def word_count(words: DataFrame) -> DataFrame:
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def count_without(words: DataFrame, stop_words: DataFrame) -> DataFrame:
    """Word counts without the stop words: those that, trimmed, equal a line of the list as it stands.

    A short list is broadcast and drops words before they are counted. A long one is joined to the counts, where
    every word is one row, so that a frequent word never meets in one task.
    """
    stops = stop_words.select(F.col("word").alias("stop")).distinct()
    stopped = F.trim("word") == F.col("stop")
    if fits_broadcast(stops):
        return word_count(words.join(F.broadcast(stops), stopped, "left_anti"))
    return word_count(words).join(stops, stopped, "left_anti")


def top_words(counts: DataFrame, n: int = 10) -> DataFrame:
    """The n largest counts; equal counts by the later word."""
    return top_k(counts, n, F.desc("n"), F.desc("word"))


def count_statistics(top: DataFrame, exact: bool = False) -> DataFrame:
    """Rows (name, value) for Mean, Sum, Min, Max and Var of the column ``n``.

    By default mean and variance are whole numbers: the mean is truncated, and the variance is taken around the
    truncated mean and truncated too. ``exact`` gives the real population values.
    """
    count = F.count(F.lit(1))
    total, low, high = F.sum("n"), F.min("n"), F.max("n")
    if exact:
        stats = top.agg(total.alias("sum"), low.alias("min"), high.alias("max"),
                        F.round(F.avg("n"), 6).alias("mean"), F.round(F.var_pop("n"), 6).alias("var"))
        kind = "DOUBLE"
    else:
        # sum((n - m)^2) = sum(n^2) - 2 m sum(n) + count m^2, exact in whole numbers
        sums = top.agg(count.alias("c"), total.alias("sum"), F.sum(F.col("n").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")).alias("sq"),
                       low.alias("min"), high.alias("max"))
        stats = sums.withColumn("mean", F.expr("sum div c")).withColumn(
            "var", F.expr("(sq - CAST(mean AS DECIMAL(19,0)) * CAST(2 * sum - c * mean AS DECIMAL(19,0))) div c"))
        kind = "BIGINT"
    pairs = ", ".join(f"'{name.title()}', CAST({name} AS {kind})" for name in ("mean", "sum", "min", "max", "var"))
    return stats.select(F.expr(f"stack(5, {pairs})").alias("name", "value"))


def top_words_report(counts: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent words as one line; equal counts in word order."""
    top = top_k(counts, n, F.desc("n"), F.asc("word"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("_order"), "word", "n")))
    return top.agg(format_top_words(ordered).alias("top_n"))
