"""Intermediate results that must be read twice: written once to the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet, under the folder named by `spark.checkpoint.dir`.

    Without that setting a local session gets a temporary folder; on a cluster it is an
    error, because a machine-local folder is gone with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tripledger-")
    return f"{base.rstrip('/')}/tripledger/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet to a fresh path and read it back with cut lineage."""
    path = fresh_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
