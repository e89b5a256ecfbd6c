import os
import time

import pytest
from pyspark.sql import functions as F

from skytally.catalog import inputs, queries
from skytally.operators import flights as fl, membership, sensors, trips, words
from skytally.sources.streams import stream_source
from skytally.streaming import jobs, runner
from tests.conftest import TABLES, rows


@pytest.fixture
def tables(spark):
    return inputs.Tables(spark, TABLES)


def files_of(df, path, parts=3):
    df.repartition(parts).write.parquet(path)
    assert len([f for f in os.listdir(path) if f.endswith(".parquet")]) == parts


def one_file_per_batch(spark, df, path):
    return stream_source(spark, "parquet", path, df.schema, max_files_per_trigger=1)


def test_flight_jobs_equal_their_batch_twins(spark, tables, tmp_path):
    batch = inputs.flights(tables)
    files_of(batch, f"{tmp_path}/flights")
    stream = lambda: one_file_per_batch(spark, batch, f"{tmp_path}/flights")
    origins, pairs, requests = inputs.airport_list(tables), inputs.pair_list(tables), inputs.trip_requests(tables)
    assert rows(jobs.stream_top_airports(stream()).select("airport", "popularity")) == rows(fl.top_airports(batch))
    assert rows(jobs.stream_on_time_weekday(stream())) == rows(fl.rank_weekdays(batch))
    assert rows(jobs.stream_top_airlines_from(stream(), origins)) == rows(
        fl.top_airlines_from(fl.on_time_by_origin_airline(batch, origins)))
    assert rows(jobs.stream_top_airlines_between(stream(), pairs)) == rows(
        fl.top_airlines_between(fl.on_time_by_pair_airline(batch, pairs)))
    assert rows(jobs.stream_mean_delay(stream(), pairs)) == rows(fl.mean_delay(batch, pairs))
    expected = rows(trips.find_trips(batch, requests))
    assert expected and rows(jobs.stream_best_trips(stream(), requests)) == expected


def test_text_and_event_jobs_equal_their_batch_twins(spark, tables, tmp_path):
    lines = inputs.document_lines(tables.documents)
    files_of(lines, f"{tmp_path}/lines")
    stream = lambda: one_file_per_batch(spark, lines, f"{tmp_path}/lines")
    spoken = words.sentence_words(lines)
    normal = words.word_count(words.normalized_words(spoken))
    assert rows(jobs.stream_word_count(stream())) == rows(words.word_count(spoken))
    assert rows(jobs.stream_word_count_normalized(stream())) == rows(normal)
    top = normal.orderBy(F.desc("n"), "word").limit(10)
    assert rows(jobs.stream_top_words(stream())) == rows(top)

    messages = inputs.sensor_lines(tables.events)
    files_of(messages, f"{tmp_path}/messages")
    alarms = jobs.stream_sensor_alarms(one_file_per_batch(spark, messages, f"{tmp_path}/messages"))
    assert rows(alarms) == rows(sensors.alarms(sensors.parse_messages(messages)))

    beats = inputs.heartbeats(tables.events)
    files_of(beats, f"{tmp_path}/beats")
    status = jobs.stream_heartbeat_status(one_file_per_batch(spark, beats, f"{tmp_path}/beats"), 500_000)
    assert rows(status) == rows(membership.heartbeat_status(membership.last_advance(beats), 500_000))


def test_restart_continues_from_the_checkpoint(spark, tmp_path):
    schema = "value STRING"
    source, root = f"{tmp_path}/in", f"{tmp_path}/root"
    run = lambda: rows(jobs.stream_word_count(stream_source(spark, "parquet", source, spark.createDataFrame([], schema).schema), root))
    top = lambda: rows(jobs.stream_top_words(
        stream_source(spark, "parquet", source, spark.createDataFrame([], schema).schema), 2, f"{root}-top"), "kept")
    spark.createDataFrame([("cow moon",), ("cow",)], schema).coalesce(1).write.parquet(source)
    assert run() == [("cow", 2), ("moon", 1)]
    assert top() == [("cow", 2), ("moon", 1)]
    assert run() == [("cow", 2), ("moon", 1)]  # nothing new
    spark.createDataFrame([("moon moon hen",)], schema).coalesce(1).write.mode("append").parquet(source)
    assert run() == [("cow", 2), ("hen", 1), ("moon", 3)]
    assert top() == [("moon", 3), ("cow", 2)]


def test_a_repeated_batch_is_stored_once(spark, tmp_path):
    batch = spark.createDataFrame([("a", 1)], "k STRING, n BIGINT")
    table = runner.RunningTable(f"{tmp_path}/t", ["k"], batch.schema)
    for _ in range(2):
        table.write_batch(batch, 0)
    table.write_batch(spark.createDataFrame([("a", 5), ("b", 2)], batch.schema), 1)
    assert rows(table.current(spark)) == [("a", 5), ("b", 2)]
    assert table.changes(spark).count() == 3


def test_idle_query_is_stopped_and_records_are_counted(spark, tmp_path):
    source = f"{tmp_path}/in"
    spark.range(7).selectExpr("CAST(id AS STRING) AS value").write.parquet(source)
    stream = runner.counted(stream_source(spark, "parquet", source, spark.read.parquet(source).schema))
    table = runner.RunningTable(f"{tmp_path}/t", [], stream.schema)
    query = runner.start(stream, table.write_batch, f"{tmp_path}/cp", "append", interval="200 milliseconds")
    runner.stop_when_idle(query, wait_seconds=2, idle_waits=2)
    assert not query.isActive and query.exception() is None
    records = [p.observedMetrics["input"].records for p in query.recentProgress if p.numInputRows]
    assert records == [7] and table.changes(spark).count() == 7


def test_busy_query_is_not_stopped(spark, tmp_path):
    source = f"{tmp_path}/in"
    spark.range(3).selectExpr("CAST(id AS STRING) AS value").write.parquet(source)
    stream = stream_source(spark, "parquet", source, spark.read.parquet(source).schema)
    written = []

    def slow(batch, batch_id):
        time.sleep(4)
        written.append(batch.count())

    query = runner.start(stream, slow, f"{tmp_path}/cp", "append", interval="200 milliseconds")
    runner.stop_when_idle(query, wait_seconds=0.5, idle_waits=2)
    assert written == [3] and not query.isActive and query.exception() is None


def test_state_is_kept_in_rocksdb(spark):
    runner.use_rocksdb_state(spark)
    assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_text_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("The cow\njumps over the cow\n")
    found = jobs.stream_top_words(stream_source(spark, "text", f"{tmp_path}/in"), 1)
    assert rows(found) == [("cow", 2)]


def test_a_stream_without_input_gives_an_empty_result(spark, tmp_path):
    (tmp_path / "in").mkdir()
    stream = lambda: stream_source(spark, "text", f"{tmp_path}/in")
    assert rows(jobs.stream_word_count(stream())) == []
    assert rows(jobs.stream_top_words(stream())) == []


def test_registered_streams_are_registered_with_sql():
    from skytally.catalog.oracles import ORACLES
    assert {n for n in queries.QUERIES if n.startswith("stream_")} <= set(ORACLES)


RUN = "k STRING, n BIGINT"


def compacted(spark, tmp_path, name="t"):
    return runner.CompactedTable(f"{tmp_path}/{name}", ["k"], spark.createDataFrame([], RUN).schema)


def put(spark, table, batch_id, **rows_):
    table.write_batch(spark.createDataFrame(list(rows_.items()), RUN), batch_id)


def test_current_rows_lie_in_few_folders(spark, tmp_path):
    table, expected = compacted(spark, tmp_path), {}
    assert rows(table.current(spark)) == []
    for batch in range(11):
        changed = {f"k{batch % 4}": batch, f"own{batch}": -batch}
        put(spark, table, batch, **changed)
        expected |= changed
        read = {os.path.dirname(path) for path in table.current(spark).inputFiles()}
        assert len(read) == len(table.runs(spark)) == (batch + 1).bit_count()
        if batch == 5:
            opened, then = table.current(spark), sorted(expected.items())
    assert dict(rows(table.current(spark))) == expected
    assert table.runs(spark) == [(0, 7, 8), (8, 9, 2), (10, 10, 1)]
    assert rows(opened) == then  # a reader keeps the runs that it began with
    assert table.changes(spark).count() == 22


def test_a_compacted_batch_counts_once(spark, tmp_path, monkeypatch):
    table = compacted(spark, tmp_path)
    put(spark, table, 0, a=1)
    with monkeypatch.context() as patch:
        patch.setattr(runner.CompactedTable, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            put(spark, table, 1, a=2, b=2)
    assert rows(table.current(spark)) == [("a", 1)]  # merged, but in no manifest
    put(spark, table, 1, a=3, b=3)
    put(spark, table, 1, a=3, b=3)  # comes again after a restart
    assert rows(table.current(spark)) == [("a", 3), ("b", 3)] and table.runs(spark) == [(0, 1, 2)]
    with pytest.raises(ValueError):
        put(spark, table, 0, a=9)
