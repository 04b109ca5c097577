"""Where intermediate tables go: the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. A temporary one is made only on a local master that names none, as in tests:
    on a cluster the driver's own disk is no place that executors see."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is None:
        if named is None and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="geoloom-checkpoint-"))
        current = context.getCheckpointDir()
    return named or current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write df to the checkpoint folder and go on from there, so that lost executors lose no work."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """df written as a table in the checkpoint folder and read again, as rounds of a loop need it.

    Unlike after a checkpoint the planner then knows the table's real size. A checkpoint keeps the estimate of its plan, and
    joins multiply estimates: over a dozen rounds their digits alone outgrow the driver.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
