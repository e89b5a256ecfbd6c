"""The pipeline's stages on the small tables, each against what it was given."""

import __spark_entry__ as contract
import corpus_pipeline
from skytally.llm import encoding
from skytally.llm.decontam import clean_documents
from skytally.llm.mixing import mix_sources, mixed_documents
from skytally.llm.near import one_of_each_group
from skytally.llm.token_files import read_token_pages, write_token_pages
from skytally.plans.durable import scratch_path
from tests.conftest import TABLES
from tests.llm.test_operators import plain_contamination, plain_groups


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    given = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        given.append(docs)
        out = stage(spark, docs, TABLES)
        out.write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        assert number == 4 or docs.columns == given[0].columns
    rows = [(r.doc_id, r.text) for r in given[1].collect()]
    assert 0 < len(rows) < given[0].count()
    groups = plain_groups(rows, 5, 4, 5)
    left = [(r.doc_id, r.text) for r in given[2].collect()]
    assert sorted(d for d, _ in left) == sorted(set(groups.values()))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
    clean = [k[0] for k in plain_contamination(left, items) if not k[5]]
    assert sorted(r.doc_id for r in given[3].collect()) == sorted(clean)
    taken = {r.doc_id: (r.taken, r.size) for r in mix_sources(given[3]).collect()}
    copies = sum(-(-t // s) if s else 0 for t, s in taken.values())
    assert given[4].count() == copies == docs.count()
    assert contract.queries()["pipeline"](spark, TABLES).count() == copies


def test_stages_keep_clashing_columns_and_odd_ids(spark):
    """Columns that the stages use names of come back with their values; ids that repeat or lack lose no text."""
    names = "size cell target whole source_size end_cell text_key node part input copies batch count".split()
    text = lambda word, n=80: " ".join(f"{word}{i}" for i in range(n))
    given = [(1, text("a")), (1, text("b")), (1, text("a")), (2, text("c")), (None, text("c")), (None, text("d")),
             (None, text("d")), (3, text("bench")), (None, None), (4, ""), (5, text("e") + " x"), (6, text("e"))]
    rows = [(d, t, "s", len(t or ""), *[f"{name}{i}" for name in names]) for i, (d, t) in enumerate(given)]
    schema = "doc_id long, text string, source string, n_chars long, " + ", ".join(f"{name} string" for name in names)
    docs = spark.createDataFrame(rows, schema).repartition(3)
    known = {tuple(r) for r in rows}

    kept = one_of_each_group(docs).collect()
    assert {tuple(r) for r in kept} <= known
    assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted(
        [(1, text("a")), (1, text("b")), (2, text("c")), (0, text("d")), (3, text("bench")), (0, ""), (4, ""), (5, text("e") + " x")])

    items = spark.createDataFrame([(1, text("bench", 12))], "item_id long, text string")
    clean = clean_documents(docs, items).collect()
    assert {tuple(r) for r in clean} == {r for r in known if r[0] != 3} and len(clean) == len(rows) - 1

    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    by_rest = {r[4:]: r for r in rows}
    for r in mixed.collect():
        was = by_rest[tuple(r)[4:]]
        assert (r.doc_id, r.source) == (was[0], was[2]) and was[1].startswith(r.text) and r.n_chars == len(r.text)


def test_null_ids_make_several_shards(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # which joins what is small
    docs = spark.range(4000).selectExpr("CAST(NULL AS LONG) AS doc_id", "concat('text ', id) AS text")
    path = scratch_path(spark, "null_ids")
    try:
        write_token_pages(docs, path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spark.read.parquet(path).select("shard").distinct().count() > 1
    found = read_token_pages(spark, path).orderBy("start").collect()
    assert len(found) == 4000 and found[0].start == 0
    assert all(a.start + a.n_tokens == b.start for a, b in zip(found, found[1:]))


def test_workers_of_the_token_stage_forget(spark):
    """A worker outlives its tasks: without ``keep`` no piece of text stays in it when a task ends."""
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('word', id, ' and, more') AS text").repartition(2)
    held = lambda rem: spark.range(0, 64, 1, 16).mapInArrow(lambda batches: _count_held(batches, rem), "n long").agg({"n": "max"}).first()[0]
    path = scratch_path(spark, "forgets")
    write_token_pages(docs, path, remembered=54_321, keep=False)
    assert read_token_pages(spark, path).count() == 400 and held(54_321) == 0
    write_token_pages(docs, scratch_path(spark, "keeps"), remembered=54_322)
    assert held(54_322) > 0


def _count_held(batches, remembered):
    import pyarrow as pa

    for _ in batches:
        cached = encoding.encoder.cache_info().currsize and encoding.encoder(encoding.PATH, remembered)
        pieces = [len(x) for m in (cached.of_chunk, cached.of_pre_token) for x in (m.young, m.old)] if cached else [0]
        yield pa.RecordBatch.from_arrays([pa.array([sum(pieces)])], names=["n"])
