"""The toxicity model learns from every labelled document outside fold 0, in shards."""

import zlib

import numpy as np
from pyspark.sql import Window, functions as F

from skytally.llm import toxicity as tx
from skytally.llm.labelled import fold


def test_learns_from_all_labels(spark):
    """Of 12,800 labelled documents only the last 600 in the order of the former sample of 12,000 are toxic."""
    ids = spark.range(16_000).select(F.col("id").alias("doc_id"), fold("id").alias("_fold"))
    place = F.row_number().over(Window.partitionBy(F.col("_fold") == 0).orderBy(
        F.xxhash64(F.lit("sample"), "doc_id").desc(), F.desc("doc_id")))
    late = ids.select("doc_id", ((place <= 600) & (F.col("_fold") != 0)).cast("int").alias("toxic"))
    docs = late.select("doc_id", F.concat_ws(" ", F.lit("plain text"), F.concat(F.lit("w"), F.col("doc_id") % 97),
                                             F.when(F.col("toxic") == 1, "lateword")).alias("text"), F.lit("en").alias("lang"))
    model = tx.train_toxicity(docs.repartition(4), late)
    assert model.scores(["plain text w3 lateword"])[0] > 0.5 > model.scores(["plain text w3"])[0]
    assert "en" in model.thresholds and "" in model.thresholds


def test_shards_hold_every_agreed_label(spark, monkeypatch):
    monkeypatch.setattr(tx, "SHARD_DOCS", 20)
    rows = [(i, f"word{i} and {'x ' * (i % 5)}", ["en", None][i % 2]) for i in range(200)] + [(7, "again", "en"), (None, "t", "en"), (8, None, "fr")]
    names = [(i, i % 3 % 2) for i in range(0, 200, 2)] + [(7, 1), (7, 1), (9, 0), (9, 1), (11, None), (None, 1), (5000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    shards = tx.labelled_shards(docs, spark.createDataFrame(names, "doc_id long, toxic int")).collect()
    label = {d: t for d, t in names if d not in (None, 9, 11)}
    told = lambda d: zlib.crc32(str(d).encode()) % 5
    expected = sorted((x or "", label[d], told(d), tx._cells(t or "").tolist()) for d, t, x in rows if d in label and told(d))
    found = []
    for s in shards:
        at = 0
        cells = np.frombuffer(s.cells, "<u2").reshape(-1, 2).astype(int) + [0, tx.CELLS]
        for k, f, x, n in zip(s.labels, s.folds, s.langs, np.frombuffer(s.sizes, "<u4")):
            found.append((x, k, f, cells[at : at + n].tolist()))
            at += n
    assert len(shards) > 2 and sorted(found) == expected


def test_rows_of_a_training_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(tx, "SHARD_DOCS", 40)
    docs = spark.createDataFrame([(i, f"{'scum' if i % 4 == 0 else 'fine'} w{i % 9} day", "en") for i in range(300)],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(300)], "doc_id long, toxic int")
    first, again = (tx.train_toxicity(docs.repartition(k), labels.repartition(k)) for k in (2, 5))
    texts = ["scum w1 day", "fine w1 day", ""]
    assert first.scores(texts).tolist() == again.scores(texts).tolist() and first.thresholds == again.thresholds
    assert first.scores(texts)[0] > 0.5 > first.scores(texts)[1]
    none = tx.train_toxicity(docs.limit(0), labels.limit(0))
    assert none.scores(["a"]).tolist() == [0.5] and none.thresholds == {}
    training = tx.Training(first)
    training.set_rows(training.rows() + 1)
    assert (training.rows()[1 : 2 * tx.CELLS] - first.embedding[1:]).max() == 0 and training.step == 1
