"""Running a stream to the end of its input, and the tables that running results go to."""

from __future__ import annotations

import functools
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from skytally.plans.durable import scratch_path
from skytally.plans.ranking import top_k

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STATE = "org.apache.spark.sql.execution.streaming.state."

_RUNS = StructType().add("first_batch", LongType()).add("last_batch", LongType()).add("batches", LongType())

BatchSink = Callable[[DataFrame, int], None]


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep keyed state in RocksDB unless the session names a provider other than the default."""
    if spark.conf.get(_PROVIDER) == _STATE + "HDFSBackedStateStoreProvider":
        spark.conf.set(_PROVIDER, _STATE + "RocksDBStateStoreProvider")


def counted(stream: DataFrame, name: str = "input") -> DataFrame:
    """Count the records of each micro-batch; see ``observedMetrics`` in the query's progress."""
    return stream.observe(name, F.count(F.lit(1)).alias("records"))


def start(
    stream: DataFrame, sink: BatchSink, checkpoint: str, mode: str = "update", interval: str | None = None
) -> StreamingQuery:
    """Start a query that hands each micro-batch to ``sink``.

    Without an ``interval`` it takes everything available now, in batches of the source's rate cap, and ends.
    The checkpoint folder holds offsets and state; a query restarted on it continues where it was.
    """
    use_rocksdb_state(stream.sparkSession)
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def run_available(stream: DataFrame, sink: BatchSink, checkpoint: str, mode: str = "update") -> StreamingQuery:
    """Run over all input that is there, then return."""
    query = start(stream, sink, checkpoint, mode)
    query.awaitTermination()
    return query


def stop_when_idle(query: StreamingQuery, wait_seconds: float = 40.0, idle_waits: int = 2) -> None:
    """End a continuous query once ``idle_waits`` waits in a row have brought no new records.

    A wait at whose end a batch is running or input is waiting does not count, however long the batch takes. Nor does
    one before the query has looked for input.
    """
    idle, seen = 0, None
    while idle < idle_waits and query.isActive:
        time.sleep(wait_seconds)
        status, last = query.status, query.lastProgress
        newest = max((p.batchId for p in query.recentProgress if p.numInputRows > 0), default=-1)
        busy = status["isTriggerActive"] or status["isDataAvailable"] or last is None
        idle = 0 if busy or newest != seen else idle + 1
        seen = newest
    query.stop()


def show_batches(n: int = 10) -> BatchSink:
    """A sink that prints the first rows of each micro-batch."""
    def show(batch: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        batch.show(n, truncate=False)
    return show


class RunningTable:
    """Changed rows of a running aggregation, one folder per micro-batch.

    A batch that is run again after a failure replaces its own folder, so each change is stored once. The current
    row of a key is the one of its highest batch.
    """

    def __init__(self, path: str, keys: list[str], schema: StructType):
        self.path, self.keys, self.schema = path, keys, schema

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def read_batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.path}/batch_id={batch_id}")

    def changes(self, spark: SparkSession) -> DataFrame:
        schema = StructType(list(self.schema.fields)).add("batch_id", LongType())
        try:
            return spark.read.schema(schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)  # no batch yet

    def current(self, spark: SparkSession) -> DataFrame:
        values = [name for name in self.schema.names if name not in self.keys]
        newest = F.max_by(F.struct(*values), "batch_id").alias("_now")
        current = self.changes(spark).groupBy(*self.keys).agg(newest)
        return current.select(*self.keys, *[F.col(f"_now.{name}").alias(name) for name in values])


class CompactedTable(RunningTable):
    """A running table whose current rows lie in few folders: after n batches, one for each binary digit 1 of n.

    A batch is merged with the runs of no more batches before it, in one pass, into a new run beside them, as a binary
    counter carries; so a row is written again at most once for each doubling of n. The manifest that lists the runs
    comes last. It is one file, which appears at once, and nothing it lists is changed later: readers keep what they
    have begun to read, a batch that fails before its manifest is in none, and one that comes again after it changes
    nothing. One writer at a time.
    """

    def _of_batch(self, batch_id: int) -> str:
        return f"{self.path}_manifests/batch_id={batch_id}"

    def _folder(self, first: int, last: int) -> str:
        return f"{self.path}/batch_id={last}" if first == last else f"{self.path}_runs/{first}-{last}"

    def runs(self, spark: SparkSession) -> list[tuple[int, int, int]]:
        """``(first, last, batches)`` of the live runs. Manifests are listed, and only the newest is read."""
        try:
            files = spark.read.schema(_RUNS).parquet(f"{self.path}_manifests").inputFiles()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []  # no batch yet
        newest = max((int(file.rsplit("/batch_id=", 1)[1].split("/")[0]) for file in files), default=None)
        if newest is None:
            return []
        return sorted(tuple(run) for run in spark.read.schema(_RUNS).parquet(self._of_batch(newest)).collect())

    def _newest(self, spark: SparkSession, runs: list[tuple[int, int, int]]) -> DataFrame:
        """The row of each key in the last run that has it."""
        read = [spark.read.schema(self.schema).parquet(self._folder(first, last)).withColumn("_run", F.lit(last))
                for first, last, _ in runs]
        values = [name for name in self.schema.names if name not in self.keys]
        newest = functools.reduce(DataFrame.unionByName, read).groupBy(*self.keys).agg(
            F.max_by(F.struct(*values), "_run").alias("_now"))
        return newest.select(*[F.col(n if n in self.keys else f"_now.{n}").alias(n) for n in self.schema.names])

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        runs = self.runs(spark)
        if runs and batch_id <= runs[-1][1]:
            if batch_id < runs[-1][1]:
                raise ValueError(f"batch {batch_id} after batch {runs[-1][1]}: the table is of another run of the query")
            return
        super().write_batch(batch, batch_id)
        merged = [(batch_id, batch_id, 1)]
        while runs and runs[-1][2] <= sum(batches for *_, batches in merged):
            merged.insert(0, runs.pop())
        run = (merged[0][0], batch_id, sum(batches for *_, batches in merged))
        if len(merged) > 1:
            self._newest(spark, merged).write.mode("overwrite").parquet(self._folder(*run[:2]))
        self._commit(spark, batch_id, [*runs, run])

    def _commit(self, spark: SparkSession, batch_id: int, runs: list[tuple[int, int, int]]) -> None:
        spark.createDataFrame(runs, _RUNS).coalesce(1).write.mode("overwrite").parquet(self._of_batch(batch_id))

    def current(self, spark: SparkSession) -> DataFrame:
        runs = self.runs(spark)
        return self._newest(spark, runs) if runs else spark.createDataFrame([], self.schema)


class TopReport(RunningTable):
    """The n largest running counts after every micro-batch.

    Counts only grow, so a key outside the last report can enter the next one only if it changed: the last report and
    the changed keys together decide, and neither the state nor the key set is read again.
    """

    def __init__(self, path: str, key: str, count: str, schema: StructType, n: int, *order: Column):
        super().__init__(path, [key], schema)
        self.count, self.n, self.order = count, n, order

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.select(*self.schema.names)
        if batch_id > 0:
            rows = rows.unionByName(self.read_batch(batch.sparkSession, batch_id - 1))
        newest = rows.groupBy(*self.keys).agg(F.max(self.count).alias(self.count))
        super().write_batch(top_k(newest, self.n, *self.order).select(*self.schema.names), batch_id)

    def last(self, spark: SparkSession) -> DataFrame:
        """The report of the newest batch."""
        changes = self.changes(spark)
        newest = changes.agg(F.max("batch_id")).scalar()
        return changes.where(F.col("batch_id") == newest).select(*self.schema.names)


def run_to_table(stream: DataFrame, keys: list[str], root: str | None = None) -> CompactedTable:
    """Run an aggregated stream over all available input into a :class:`CompactedTable` below ``root``."""
    root = root or scratch_path(stream.sparkSession, "stream")
    table = CompactedTable(f"{root}/table", keys, stream.schema)
    run_available(stream, table.write_batch, f"{root}/checkpoint")
    return table


def run_to_report(
    stream: DataFrame, key: str, count: str, n: int, *order: Column, root: str | None = None
) -> TopReport:
    """Run a stream of growing counts over all available input into a :class:`TopReport` below ``root``."""
    root = root or scratch_path(stream.sparkSession, "stream")
    report = TopReport(f"{root}/report", key, count, stream.select(key, count).schema, n, *order)
    run_available(stream, report.write_batch, f"{root}/checkpoint")
    return report


def run_append(stream: DataFrame, root: str | None = None) -> RunningTable:
    """Append a stateless stream, e.g. alarms, to a table below ``root``."""
    root = root or scratch_path(stream.sparkSession, "stream")
    table = RunningTable(f"{root}/table", [], stream.schema)
    run_available(stream, table.write_batch, f"{root}/checkpoint", "append")
    return table
