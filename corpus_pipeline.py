"""From raw documents to a token file: grade, deduplicate, decontaminate, mix, encode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skytally.llm.decontam import clean_documents
from skytally.llm.mixing import mixed_documents
from skytally.llm.near import one_of_each_group
from skytally.llm.quality import select_quality, train_quality
from skytally.llm.queries import grade
from skytally.llm.token_files import read_token_pages, write_token_pages
from skytally.plans.durable import scratch_path


# Pieces of text whose ids a worker of the token stage keeps: fewer than in a session that only encodes, since the
# memory of an executor that ran the other stages is already in use.
REMEMBERED = 100_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that are more likely poor than not, by the ordinal model."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return select_quality(docs, train_quality(docs, labels, grade()))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of each group linked by five-word shingles at Jaccard 0.8 or more."""
    return one_of_each_group(docs, n=5, num=4, den=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark window."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and sample the documents to the sources' target weights."""
    return mixed_documents(docs)


def token_file(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Write the mix as a token file, and return what it holds of each document."""
    path = scratch_path(spark, "token_pages")
    write_token_pages(docs, path, remembered=REMEMBERED, keep=False)
    return read_token_pages(spark, path)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", token_file),
]

# Trained weights, hashed features and a tokenizer are beyond SQL; the tests hold the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written as Parquet and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            path = scratch_path(spark, f"stage_{number}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
