"""Tables stored by key, and questions that run from files."""

from pathlib import Path

from pyspark.sql import functions as F

from skytally.catalog.inputs import Tables, airport_list
from skytally.catalog.queries import QUERIES
from skytally.sinks import tables as sink
from tests.conftest import TABLES, rows


def stored(spark, path):
    table = spark.range(2000).select(F.format_string("%02d", F.col("id") % 20).alias("origin"), "id")
    sink.write_serving_table(table.repartition(8), str(path), ["origin"])
    return table


def test_a_key_is_one_file(spark, tmp_path):
    stored(spark, tmp_path / "t")
    files = [len(list(folder.glob("*.parquet"))) for folder in (tmp_path / "t").glob("origin=*")]
    assert files == [1] * 20


def test_keys_keep_their_type_and_other_folders_are_not_read(spark, tmp_path):
    table = stored(spark, tmp_path / "t")
    keys = spark.createDataFrame([("03",), ("17",), ("17",), ("none",), (None,)], "origin STRING")
    found = sink.read_serving_keys(spark, str(tmp_path / "t"), keys, table.schema)
    assert rows(found.select("origin", "id")) == rows(table.where("origin IN ('03', '17')"))
    for gone in range(20):  # a folder that is read would now fail
        if gone not in (3, 17):
            for file in (tmp_path / "t" / f"origin={gone:02d}").glob("*.parquet"):
                Path(file).write_bytes(b"unreadable")
    assert sink.read_serving_keys(spark, str(tmp_path / "t"), keys, table.schema).count() == 200


def test_no_keys_and_an_empty_table(spark, tmp_path):
    table = stored(spark, tmp_path / "t")
    none = spark.createDataFrame([], "origin STRING")
    assert sink.read_serving_keys(spark, str(tmp_path / "t"), none, table.schema).count() == 0
    sink.write_serving_table(table.limit(0), str(tmp_path / "empty"), ["origin"])
    assert sink.read_serving_keys(spark, str(tmp_path / "empty"), none, table.schema).count() == 0


def test_the_listed_airports_are_the_only_ones_read(spark):
    found = QUERIES["serving_read_topfromx"](spark, TABLES)
    listed = {row.origin for row in airport_list(Tables(spark, TABLES)).collect()}
    assert {row.origin for row in found.collect()} <= listed


def test_a_forest_grown_on_one_fold_tells_the_other(spark):
    """Labels say whether x1 passes 25; the parts predicted are none of those learned from."""
    predicted = QUERIES["random_forest_files"](spark, TABLES)
    right = predicted.agg(F.avg((F.col("prediction") == F.col("label")).cast("int")), F.count(F.lit(1))).first()
    assert right[0] >= 0.9 and right[1] == Tables(spark, TABLES).part.where("p_partkey % 2 = 0").count()
    assert predicted.where("label <> CAST(x1 > 25 AS DOUBLE)").count() == 0
