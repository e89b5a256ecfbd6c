"""Verdicts on flight lines, counted while they are read; records of micro-batches and idle stops by events."""

import os

from pyspark.sql import Observation

from skytally.plans.inspect import plan_text
from skytally.schemas import FLIGHT_COLUMNS, FLIGHT_INT_COLUMNS
from skytally.sources import judged
from skytally.sources.streams import stream_source
from skytally.streaming.progress import run_logged, run_until_idle
from tests.conftest import rows


def line(**changed):
    fields = {c: "7" if c in FLIGHT_INT_COLUMNS else "2008-01-02" if c == "flight_date" else "x" for c in FLIGHT_COLUMNS}
    return ", ".join((fields | changed).values())


def test_every_fault_is_counted_in_the_pass_that_reads(spark, tmp_path):
    number = next(iter(FLIGHT_INT_COLUMNS))
    first = [line(), line(**{number: "NA"}), "", "   ", "a, b", line(**{number: "seven"}), line(flight_date="2008-13-40")]
    second = [line(), ",".join(line().split(",")[:-1]), line(**{number: ""})]
    for name, found in (("a.csv", first), ("b.csv", second)):
        (tmp_path / name).write_text("\n".join(found) + "\n")
    table = judged.read_judged_flights(spark, str(tmp_path))
    counts = Observation()
    seen = judged.observed(table, counts)
    good = rows(judged.good_flights(seen))
    assert counts.get == {"good": 4, "blank": 2, "short": 2, "unreadable": 2} and len(good) == 4
    by_file = {(os.path.basename(f), v): n for f, v, n in rows(judged.verdict_counts(table))}
    assert by_file == {("a.csv", "good"): 2, ("a.csv", "blank"): 2, ("a.csv", "short"): 1, ("a.csv", "unreadable"): 2,
                       ("b.csv", "good"): 2, ("b.csv", "short"): 1}
    bad = {(v, x.strip()) for _, v, x in rows(judged.rejects(table))}
    assert ("short", "a, b") in bad and ("blank", "") in bad and len(bad) == 5


def test_batches_are_logged_and_a_restart_lists_only_new_ones(spark, tmp_path):
    source = f"{tmp_path}/in"
    spark.range(7).coalesce(1).write.parquet(source)
    stream = lambda: stream_source(spark, "parquet", source, spark.range(0).schema, max_files_per_trigger=1)
    seen = []
    run = lambda: rows(run_logged(stream(), lambda batch, n: seen.append(batch.count()), f"{tmp_path}/cp", "append"))
    assert run() == [(0, 7)]
    spark.range(3).coalesce(1).write.mode("append").parquet(source)
    spark.range(5).coalesce(1).write.mode("append").parquet(source)
    assert sorted(n for _, n in run()) == [3, 5] and run() == []
    assert sorted(seen) == [3, 5, 7]


def test_an_idle_query_is_stopped_by_events(spark, tmp_path):
    source = f"{tmp_path}/in"
    spark.range(4).coalesce(1).write.parquet(source)
    written = []
    found = run_until_idle(
        stream_source(spark, "parquet", source, spark.range(0).schema), lambda batch, n: written.append(batch.count()),
        f"{tmp_path}/cp", "append", interval="200 milliseconds", quiet_seconds=1, idle_events=2, timeout=60)
    assert rows(found) == [(0, 4)] and sum(written) == 4
    assert not spark.streams.active


def test_plain_lines_are_judged_like_parsed_ones(spark, lines):
    """Lines without quotes and control characters are cut at commas; the others go through the CSV parser."""
    good = "LAX, JFK, AA, AA, 1, NA, 4.00, 2015-02-29, 7, 930, +12, -3, f-1".replace("02-29", "02-28")
    cases = {
        good: "good", good.replace("LAX", '"LAX"'): "good", good.replace("LAX", "\tLAX"): "good", good + ",": "short",
        good.replace(" 930", " 93x"): "unreadable", good.replace(" 930", " 99999999999"): "unreadable",
        good.replace("02-28", "02-31"): "unreadable", good.replace("2015-02-28", "never"): "unreadable",
        good.replace("2015-02-28", ""): "good", "LAX, JFK": "short", "   ": "blank", "": "blank", '"LAX, JFK"': "short"}
    judged_lines = judged.judge_lines(lines(*cases))
    found = {r.value: r for r in judged_lines.collect()}
    assert {v: r.verdict for v, r in found.items()} == cases
    quoted, plain = found[good.replace("LAX", '"LAX"')], found[good]
    assert quoted[1:] == plain[1:] and plain.origin == "LAX" and plain.arr_delay_minutes == 4 and plain.dep_time == -3
    plan = plan_text(judged_lines.select("verdict"))
    assert "trim(origin" not in plan  # a verdict takes no typed columns
