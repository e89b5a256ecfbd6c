"""Where intermediate results live.

Everything that has to outlive an executor goes to the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # read when a write begins


def checkpoint_root(spark: SparkSession) -> str:
    """The session's shared checkpoint folder.

    Only a local session without the setting gets a folder of its own; a cluster has to name one, since a
    machine-local folder would be lost with its machine.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="skytally-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root or context.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used yet."""
    return f"{checkpoint_root(spark).rstrip('/')}/skytally/{uuid.uuid4().hex}/{label}"


def stored(df: DataFrame, free: bool = False) -> DataFrame:
    """Like :func:`durable`, as Parquet: large tables of few bytes a row take a fraction of a checkpoint's space.

    With ``free``, what this write exchanged is removed from the executors' disks as soon as it is done, not when the
    driver's garbage collector finds that nobody refers to it any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stored")
    before = spark.conf.get(FREE, None)
    try:
        if free:
            spark.conf.set(FREE, "true")
        df.write.parquet(path)
    finally:
        if free and before is None:
            spark.conf.unset(FREE)
        elif free:
            spark.conf.set(FREE, before)
    return spark.read.schema(df.schema).parquet(path)
