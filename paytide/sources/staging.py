"""Shared scratch space for intermediate results that have to outlive an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster, as named by `spark.checkpoint.dir`.

    Only a local session that names none gets a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so that is an error.
    """
    context = spark.sparkContext
    named = context.getConf().get(_SETTING)
    if named:
        return named
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="paytide-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Compute `df` once into a Parquet table in the shared folder and continue from it.

    The table survives lost executors, and readers of it still get column pruning,
    pushed filters and a known size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
