"""Tables that live in files: upserts that rewrite only the buckets they touch, and wide tables for range scans."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from skytally.plans.durable import durable
from skytally.sinks.tables import latest_by_key, put_cells

_BUCKET, _VERSION = "stored_bucket", "stored_version"


class KeyedTable:
    """One row per key, in hash buckets of Parquet files that are copied on write.

    ``put`` writes new files for the buckets that its rows fall in, and then a new version: a list of where each bucket
    is. The list is one file that appears at once, so readers see all of a put or nothing of it; what a put that failed
    before left behind is in no list, and its number is used again. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], sequence: list[str],
                 buckets: int = 64):
        """The later row of a key by ``sequence`` stays. ``buckets`` has to be the same at every opening."""
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.sequence, self.buckets = keys, sequence, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(_BUCKET)

    def versions(self) -> DataFrame:
        """``(version, bucket, data_version)``: for each version and bucket, the version whose files hold it."""
        schema = "bucket INT, data_version INT, version INT"
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/versions")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def layout(self, version: int | None = None) -> tuple[int, dict[int, int]]:
        """The number of a version, by default the newest (0: nothing yet), and where its buckets are."""
        known = self.versions()
        if version is None:
            version = known.agg(F.max("version")).first()[0] or 0
        return version, {r.bucket: r.data_version for r in known.where(F.col("version") == version).collect()}

    def _read(self, layout: dict[int, int]) -> DataFrame:
        folders = [f"{self.path}/data/{_VERSION}={v}/{_BUCKET}={b}" for b, v in sorted(layout.items())]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data").parquet(*folders)
        return rows.select(*self.schema.names)

    def read(self, version: int | None = None) -> DataFrame:
        """The whole table, as of a version."""
        return self._read(self.layout(version)[1])

    def get(self, wanted: DataFrame) -> DataFrame:
        """The rows of the wanted keys, from their buckets only."""
        wanted = durable(wanted.select(*self.keys).distinct())
        layout = self.layout()[1]
        hit = {r[0] for r in wanted.select(self._bucket()).distinct().collect()}
        return self._read({b: v for b, v in layout.items() if b in hit}).join(wanted, self.keys, "left_semi")

    def put(self, rows: DataFrame) -> int:
        """Put rows at their keys; returns the number of the version that has them."""
        version, layout = self.layout()
        incoming = durable(latest_by_key(rows.select(*self.schema.names), self.keys, *self.sequence))
        hit = [r[0] for r in incoming.select(self._bucket()).distinct().collect()]
        if not hit:
            return version
        held = self._read({b: v for b, v in layout.items() if b in hit})
        # One exchange: rows grouped within their bucket are where their bucket is written.
        both = held.unionByName(incoming).withColumn(_BUCKET, self._bucket()).repartition(len(hit), _BUCKET)
        merged = latest_by_key(both, [_BUCKET, *self.keys], *self.sequence)
        merged.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.path}/data/{_VERSION}={version + 1}")
        self._commit(version + 1, layout | {b: version + 1 for b in hit})
        return version + 1

    def _commit(self, version: int, layout: dict[int, int]) -> None:
        listed = self.spark.createDataFrame(sorted(layout.items()), "bucket INT, data_version INT")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/version={version}")


def cell_table(spark: SparkSession, path: str, buckets: int = 64) -> KeyedTable:
    """A wide table that takes puts: the cell put last of each (row, family, qualifier)."""
    schema = StructType().add("row_key", "string").add("family", "string").add("qualifier", "string")
    schema = schema.add("value", "string").add("seq", "long")
    return KeyedTable(spark, path, schema, ["row_key", "family", "qualifier"], ["seq"], buckets)


def write_wide_table(cells: DataFrame, path: str, files: int, row_group_bytes: int = 16 << 20) -> None:
    """Write the current cells for scans: a folder per family, and in it files and row groups sorted by row key.

    A scan of a family reads its folder; a scan of a range of row keys reads the row groups whose smallest and largest
    keys reach into it. ``files`` is the number of ranges into which all cells are cut, families one after the other.
    """
    current = put_cells(cells).select("row_key", "family", "qualifier", "value")
    placed = current.repartitionByRange(files, "family", "row_key").sortWithinPartitions("family", "row_key", "qualifier")
    placed.write.mode("overwrite").option("parquet.block.size", row_group_bytes).partitionBy("family").parquet(path)


def read_wide_table(spark: SparkSession, path: str) -> DataFrame:
    """The cells of a wide table; filters on family and row key decide what is read."""
    schema = "row_key STRING, qualifier STRING, value STRING, family STRING"
    return spark.read.schema(schema).parquet(path).select("row_key", "family", "qualifier", "value")
