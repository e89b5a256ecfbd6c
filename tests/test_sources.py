import datetime
import os

from pyspark.sql import functions as F

from skytally.plans.inspect import plan_text
from skytally.schemas import CLEAN_COLUMNS, RATINGS
from skytally.sinks import tables as sink
from skytally.sources import flights, params, streams, text, wide
from tests.conftest import rows


def write(path, content):
    path.write_text(content)
    return str(path)


def test_flight_reader_takes_short_blank_and_bad_rows(spark, tmp_path):
    path = write(tmp_path / "f.csv", "\n".join([
        "BDL,PHL,20374,XE,0,1,4,2006-07-03,1,1700,1724,1530,XE12",
        "",
        " BDL , PHL ,20374,XE,NA,,x,2006-07-04",
        "BDL,PHL,20374,XE,0.00,1.00,0,2006-07-05,3,2200,2215",
        "BDL,PHL,20374,XE,0,1,2.5,not a date,3,2200,99999999999,1,F",
    ]))
    found = {r.flight_date: r for r in flights.read_flights(spark, path).collect()}
    assert len(found) == 4
    first = found[datetime.date(2006, 7, 3)]
    assert (first.origin, first.arr_delay_minutes, first.arr_time, first.flight_id) == ("BDL", 4, 1724, "XE12")
    short = found[datetime.date(2006, 7, 4)]
    assert (short.origin, short.dest, short.arr_delayed, short.dep_delayed) == ("BDL", "PHL", None, None)
    assert (short.arr_delay_minutes, short.dep_time, short.flight_id) == (None, None, None)
    eleven = found[datetime.date(2006, 7, 5)]
    assert (eleven.arr_delayed, eleven.dep_delayed, eleven.arr_time, eleven.dep_time) == (0, 1, 2215, None)
    assert (found[None].arr_delay_minutes, found[None].arr_time) == (None, None)


def test_manifest_unites_files_and_skips_blank_lines(spark, tmp_path):
    one = write(tmp_path / "1.csv", "A,B\n")
    two = write(tmp_path / "2.csv", "C,D\nE,F\n")
    manifest = write(tmp_path / "manifest.txt", f"{one}\n\n  {two}  \n")
    assert flights.read_manifest(spark, manifest) == [one, two]
    assert flights.read_flights_from_manifest(spark, manifest).count() == 3


def test_on_time_files_are_projected_to_the_clean_columns(spark, tmp_path):
    header = ("Year,Origin,Dest,AirlineID,Carrier,ArrDel15,DepDel15,ArrDelayMinutes,FlightDate,DayOfWeek,CRSDepTime,"
              "ArrTime,DepTime,FlightNum,TailNum")
    path = write(tmp_path / "raw.csv", header + "\n2006,BDL,PHL,20374,XE,1,,12.00,2006-07-03,1,700,815,655,77,N1\n")
    [row] = flights.type_flights(flights.read_on_time_files(spark, path)).collect()
    assert (row.airline_code, row.arr_delayed, row.dep_delayed, row.arr_delay_minutes) == ("XE", 1, None, 12)
    assert (row.dep_time, row.flight_id) == (655, "77")


def test_on_time_files_of_two_header_orders(spark, tmp_path):
    names = ["Year", *CLEAN_COLUMNS]
    turned = ["Dest", "Origin", *(n for n in names if n not in ("Dest", "Origin"))]
    paths = [write(tmp_path / f"{i} raw.csv", ",".join(h) + "\n" + ",".join(f"{n}{i}" for n in h) + "\n")
             for i, h in enumerate((names, turned, names))]
    write(tmp_path / "none.csv", "")
    expected = sorted(tuple(f"{n}{i}" for n in CLEAN_COLUMNS) for i in range(3))
    assert rows(flights.read_on_time_files(spark, paths)) == expected
    assert rows(flights.read_on_time_files(spark, str(tmp_path))) == expected
    assert flights.read_on_time_files(spark, str(tmp_path / "none.csv")).columns == list(CLEAN_COLUMNS.values())


def test_last_rows_follow_file_names_not_sizes(spark, tmp_path):
    write(tmp_path / "1.txt", "a early:\nb 1\nb 2\n\n")
    write(tmp_path / "2.txt", "a late\n" + "c x\n" * 5000 + "c y\n")
    for _ in range(2):
        assert rows(sink.load_last_rows(spark, str(tmp_path), ["k", "v"])) == [("a", "late"), ("b", "2"), ("c", "y")]
    write(tmp_path / "0.txt", "a first\n" * 20000)
    assert rows(sink.load_last_rows(spark, str(tmp_path), ["k", "v"])) == [("a", "late"), ("b", "2"), ("c", "y")]


def test_parameter_files(spark, lines, tmp_path):
    assert rows(params.parse_key_list(lines("ATL", " ORD ", "", "ATL"))) == [("ATL",), ("ORD",)]
    assert rows(params.parse_pair_list(lines("BDL   PHL", " BHM BWI ", "ONE"))) == [("BDL", "PHL"), ("BHM", "BWI")]
    requests = params.parse_trip_requests(lines(
        "BDL PHL ATL 2006-07-03", "BDL  PHL ATL  2006-07-03", "BDL PHL", "", "A B C someday", "X Y Z 2006-12-31"))
    assert rows(requests) == [
        ("BDL", "PHL", "ATL", datetime.date(2006, 7, 3)), ("X", "Y", "Z", datetime.date(2006, 12, 31))]
    path = write(tmp_path / "list.txt", "ATL\nORD\n")
    assert params.read_key_list(spark, path).count() == 2


def test_adjacency_lines(lines):
    found = text.parse_adjacency(lines("2: 3 747213 3", "4 5", "9:", "", "7 "))
    assert rows(found.select("src", "dst", "position")) == sorted(
        [(2, 3, 0), (2, 747213, 1), (2, 3, 2), (4, 5, 0), (9, None, None), (7, None, None)], key=repr)


def test_double_colon_keeps_commas(spark, tmp_path):
    path = write(tmp_path / "movies.dat", "1::Toy Story (1995), again::Animation|Comedy\n2::Heat::Action\n")
    assert rows(text.read_movies(spark, path)) == [
        (1, "Toy Story (1995), again", "Animation|Comedy"), (2, "Heat", "Action")]
    ratings = write(tmp_path / "ratings.dat", "1::1193::5::978300760\n")
    assert text.read_ratings(spark, ratings).schema == RATINGS
    assert rows(text.read_ratings(spark, ratings)) == [(1, 1193, 5, 978300760)]


def test_learning_tables(spark, tmp_path):
    cars = write(tmp_path / "cars.csv", '"Model, one",21,6\n"Model two",22.8,4\n')
    assert rows(text.read_titled_points(spark, cars, 2)) == [("Model two", 22.8, 4.0), ("Model, one", 21.0, 6.0)]
    points = write(tmp_path / "points.csv", "6,148,1\n")
    assert rows(text.read_labeled_points(spark, points, 2)) == [(6.0, 148.0, 1.0)]


def test_whitespace_table(spark, lines, tmp_path):
    columns = sink.read_column_list(spark, write(tmp_path / "c.txt", "date1\norigin1\n\ndestination1\n arrTime1\nflightId1\n"))
    assert columns == ["date1", "origin1", "destination1", "arrTime1", "flightId1"]
    table = sink.parse_whitespace_rows(lines("2008-12-01 DCU ATL: 1201 0112", "", "  2008-10-11 UCD  LTA: 1011 "), columns)
    assert rows(table) == [
        ("2008-10-11", "UCD", "LTA", "1011", None), ("2008-12-01", "DCU", "ATL", "1201", "0112")]


def test_wide_rows(spark):
    cells = spark.createDataFrame([
        ("row1", "personal", "hero", "superman", 1), ("row1", "professional", "xp", "90", 2),
        ("row1", "professional", "xp", "100", 3), ("row2", "personal", "hero", "batman", 4),
        ("row3", "personal", "hero", "wolverine", 5), ("row3", "professional", "xp", "75", 6),
    ], "row_key STRING, family STRING, qualifier STRING, value STRING, seq BIGINT")
    latest = sink.put_cells(cells)
    assert rows(wide.scan_column(latest, "personal", "hero").select("row_key", "value")) == [
        ("row1", "superman"), ("row2", "batman"), ("row3", "wolverine")]
    assert rows(wide.scan_column(latest, "professional").select("row_key", "value")) == [("row1", "100"), ("row3", "75")]
    keys = lambda start, stop: rows(wide.scan_range(latest, start, stop).select("row_key").distinct())
    assert keys("row1", "row3") == [("row1",), ("row2",)]
    assert keys("row2", "row2") == [("row2",)]
    assert keys("row4", "row4") == []
    table = sink.family_rows(cells, {"personal": ["hero"], "professional": ["name", "xp"]})
    assert rows(table.selectExpr("row_key", "personal.hero", "professional.name", "professional.xp")) == [
        ("row1", "superman", None, "100"), ("row2", "batman", None, None), ("row3", "wolverine", None, "75")]


def test_sinks(spark, lines, tmp_path):
    df = spark.createDataFrame([("A", 2), ("B", 1)], "k STRING, n BIGINT")
    for _ in range(2):  # the second write replaces the first
        sink.write_tsv(df, f"{tmp_path}/tsv", single_file=True)
    assert rows(sink.read_tsv(spark, f"{tmp_path}/tsv", "k STRING, n BIGINT")) == [("A", 2), ("B", 1)]
    sink.publish(lines("one", "", " ", "two"), f"{tmp_path}/topic")
    assert rows(spark.read.text(f"{tmp_path}/topic")) == [(" ",), ("one",), ("two",)]
    sink.write_serving_table(df, f"{tmp_path}/table", ["k"])
    assert rows(sink.read_serving_table(spark, f"{tmp_path}/table").select("k", "n")) == [("A", 2), ("B", 1)]
    sink.write_results(df, f"{tmp_path}/json", "json")
    assert rows(spark.read.json(f"{tmp_path}/json").select("k", "n")) == [("A", 2), ("B", 1)]


def test_upsert_keeps_the_last_write(spark):
    schema = "k STRING, seq INT, v STRING"
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], schema)
    new = spark.createDataFrame([("b", 3, "z"), ("c", 4, None), ("b", 5, "w")], schema)
    assert rows(sink.upsert(old, new, ["k"], "seq")) == [("a", 1, "x"), ("b", 5, "w"), ("c", 4, None)]


def test_stream_options():
    assert streams.kafka_options("host:6667", "flights", max_records_per_trigger=3_000_000, min_partitions=8) == {
        "kafka.bootstrap.servers": "host:6667", "subscribe": "flights", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "maxOffsetsPerTrigger": "3000000", "minPartitions": "8"}
    other = streams.kafka_options("h:1", "t", from_start=False, group="g")
    assert (other["startingOffsets"], other["kafka.group.id"]) == ("latest", "g")
    assert streams.file_options(1, "*.csv") == {"maxFilesPerTrigger": "1", "pathGlobFilter": "*.csv"}


def test_headers_of_any_number_of_files_are_found_by_one_job(spark, tmp_path):
    header, turned = ",".join(CLEAN_COLUMNS), ",".join(reversed(CLEAN_COLUMNS))
    for i in range(30):
        lines = [f"row {i}.{n}" for n in range(20_000 if i == 4 else i % 3)]
        write(tmp_path / f"{i}%20 a.csv", "\n".join(["", " ", turned if i % 5 == 0 else header, *lines]) + "\n")
    write(tmp_path / "blank.csv", "\n  \n")
    tracker, context, jobs = spark.sparkContext.statusTracker(), spark.sparkContext, []
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for number, files in enumerate((sorted(map(str, tmp_path.iterdir()))[:2], str(tmp_path))):
        context.setJobGroup(f"headers{number}", "headers")
        groups = flights.files_by_header(spark, files)
        context.setLocalProperty("spark.jobGroup.id", None)
        jobs.append(len(tracker.getJobIdsForGroup(f"headers{number}")))
    assert jobs == [1, 1]
    assert sorted(len(g) for g in groups) == [6, 24]
    names = {os.path.basename(path) for path in min(groups, key=len)}
    assert names == {f"{i}%20 a.csv" for i in range(0, 30, 5)}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == kept


def test_a_request_line_is_cut_once(spark, lines):
    requests = params.parse_trip_requests(lines("a b c 2020-01-01", " a  b c\t2020-01-01 x", "a b c", "c b a never", "a b c 2020-1-1", ""))
    assert plan_text(requests, "simple").count("split(") == 1
    assert [tuple(map(str, r)) for r in requests.collect()] == [("a", "b", "c", "2020-01-01")]


def test_micro_batches_have_a_file_for_every_core(spark, tmp_path):
    from skytally.catalog import queries
    from skytally.catalog.inputs import Tables

    batches = queries._in_batches(Tables(spark, "/root/testdata/sf0.001"), spark.range(4000), 3)
    sizes = []
    query = batches.writeStream.foreachBatch(lambda df, _: sizes.append((df.count(), df.select(F.input_file_name()).distinct().count()))).option(
        "checkpointLocation", str(tmp_path)).trigger(availableNow=True).start()
    query.awaitTermination()
    assert [n for _, n in sizes] == 3 * [spark.sparkContext.defaultParallelism] and sum(n for n, _ in sizes) == 4000
