"""Upserts into stored tables and scans of stored wide tables, down to the files."""

import os

import pytest

from skytally.plans.inspect import plan_text
from skytally.sinks.stored import KeyedTable, cell_table, read_wide_table, write_wide_table
from skytally.sinks.tables import latest_by_key
from skytally.sources.wide import scan_column, scan_range
from tests.conftest import rows

SCHEMA = "k INT, v STRING, seq BIGINT"


def table_at(spark, path, buckets=8):
    return KeyedTable(spark, str(path), spark.createDataFrame([], SCHEMA).schema, ["k"], ["seq"], buckets)


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_the_last_write_stays(spark, tmp_path):
    table = table_at(spark, tmp_path)
    assert rows(table.read()) == [] and table.put(spark.createDataFrame([], SCHEMA)) == 0
    first = spark.createDataFrame([(i % 50, f"a{i}", i) for i in range(100)] + [(None, "n", 1)], SCHEMA)
    second = spark.createDataFrame([(7, "later", 900), (8, "earlier", 1), (1000, "new", 5), (7, "mid", 500)], SCHEMA)
    assert table.put(first) == 1
    before = files(f"{tmp_path}/data")
    assert table_at(spark, tmp_path).put(second) == 2
    assert rows(table.read()) == rows(latest_by_key(first.unionByName(second), ["k"], "seq"))
    assert rows(table.read(1)) == rows(latest_by_key(first, ["k"], "seq"))
    wanted = spark.createDataFrame([(7,), (1000,), (1001,), (7,)], "k INT")
    assert rows(table.get(wanted)) == [(1000, "new", 5), (7, "later", 900)]
    # Only the buckets of the keys 7, 8 and 1000 were written again.
    assert before <= files(f"{tmp_path}/data")
    version, layout = table.layout()
    assert version == 2 and set(layout) == set(range(8)) and 1 <= sum(v == 2 for v in layout.values()) <= 3
    assert len(files(f"{tmp_path}/data")) == len(before) + sum(v == 2 for v in layout.values())


def test_a_put_that_fails_before_its_commit_is_not_seen(spark, tmp_path, monkeypatch):
    table = table_at(spark, tmp_path)
    table.put(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], SCHEMA))

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(table, "_commit", fail)
        with pytest.raises(OSError):
            table.put(spark.createDataFrame([(1, "x", 2)], SCHEMA))
    assert rows(table_at(spark, tmp_path).read()) == [(1, "a", 1), (2, "b", 1)]
    assert table.put(spark.createDataFrame([(2, "y", 2)], SCHEMA)) == 2
    assert rows(table.read()) == [(1, "a", 1), (2, "y", 2)]


def test_one_exchange_after_the_rows_are_read(spark, tmp_path):
    table = table_at(spark, tmp_path)
    table.put(spark.createDataFrame([(i, "a", 1) for i in range(30)], SCHEMA))
    both = table.read().withColumn("stored_bucket", table._bucket()).repartition(4, "stored_bucket")
    merged = latest_by_key(both, ["stored_bucket", "k"], "seq")
    assert plan_text(merged, "simple").count("Exchange") == 1


def test_cells_put_twice(spark, tmp_path):
    table = cell_table(spark, str(tmp_path), 4)
    cell = "row_key STRING, family STRING, qualifier STRING, value STRING, seq BIGINT"
    table.put(spark.createDataFrame([("r1", "f", "a", "1", 1), ("r1", "f", "b", "1", 1)], cell))
    table.put(spark.createDataFrame([("r1", "f", "a", "2", 2), ("r2", "g", "a", None, 1)], cell))
    assert rows(table.read().drop("seq")) == [("r1", "f", "a", "2"), ("r1", "f", "b", "1"), ("r2", "g", "a", None)]


def scanned_rows(df):
    """What the scan of ``df`` handed on, before any filter."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_scans_read_few_row_groups(spark, tmp_path):
    cells = spark.range(20_000).selectExpr(
        "format_string('row%05d', id DIV 2) AS row_key", "concat('f', id % 2) AS family", "'q' AS qualifier",
        "CAST(id AS STRING) AS value", "id AS seq")
    write_wide_table(cells, str(tmp_path), files=40)
    table = read_wide_table(spark, str(tmp_path))
    assert table.count() == 20_000
    found = scan_range(table, "row00100", "row00120")
    assert "PushedFilters: [IsNotNull(row_key), GreaterThanOrEqual(row_key,row00100), LessThan(row_key,row00120)]" in plan_text(found)
    assert rows(found) == rows(scan_range(cells, "row00100", "row00120").drop("seq")) and found.count() == 40
    assert scanned_rows(found) <= 4 * 500  # of 40 files of 500 rows, two a family
    point = scan_range(table, "row00777", "row00777")
    assert point.count() == 2 and scanned_rows(point) <= 4 * 500
    column = scan_column(table, "f1", "q")
    assert "PartitionFilters: [isnotnull(family" in plan_text(column)
    assert column.count() == 10_000 and scanned_rows(column) == 10_000
