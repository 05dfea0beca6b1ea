"""Keyed Parquet tables: copy-on-write upserts.

A path that is being read is never overwritten. Tables without partitions get a new version
folder per upsert; tables with a partition column rewrite only the partitions an upsert
touches, from a copy written beforehand. Repeating an interrupted upsert completes it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.operators.upsert import asked_keys, dedupe_latest, replace_keys, same_key, upsert_latest
from tripledger.sources import paths
from tripledger.sources.scratch import materialize

_VERSION = "version="


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current rows of a table written by `upsert_table`."""
    version = _current_version(spark, path)
    return spark.read.parquet(path if version is None else f"{path}/{_VERSION}{version:08d}")


def upsert_table(
    incoming: DataFrame,
    path: str,
    keys: Sequence[str],
    order_by: str | Sequence[str],
    partition_by: str | None = None,
    whole_keys: bool = False,
) -> None:
    """Merge `incoming` into the table: one row per key, the newest of `incoming` wins.

    With `whole_keys` a key stands for all its rows: every incoming row is kept, and together
    they replace all stored rows of their keys.
    """
    if partition_by is None:
        _write_next_version(incoming, path, keys, order_by, whole_keys)
    else:
        _write_partitions(incoming, path, keys, order_by, partition_by, whole_keys)


def _finished_versions(spark: SparkSession, path: str) -> list[int]:
    if not paths.exists(spark, path):
        return []
    names = [n for n in paths.children(spark, path) if n.startswith(_VERSION)]
    return [int(n[len(_VERSION):]) for n in names if paths.exists(spark, f"{path}/{n}/_SUCCESS")]


def _current_version(spark: SparkSession, path: str) -> int | None:
    return max(_finished_versions(spark, path), default=None)


def _write_next_version(incoming, path, keys, order_by, whole_keys) -> None:
    spark = incoming.sparkSession
    version = _current_version(spark, path)
    if version is not None:  # read twice below: computed once
        incoming = materialize(incoming if whole_keys else dedupe_latest(incoming, keys, order_by), "upsert-incoming")
    if whole_keys:
        rows = incoming if version is None else replace_keys(read_table(spark, path), incoming, keys)
    elif version is None:
        rows = dedupe_latest(incoming, keys, order_by)
    else:
        rows = upsert_latest(read_table(spark, path), incoming, keys, order_by)
    rows.write.mode("overwrite").parquet(f"{path}/{_VERSION}{(version or 0) + 1:08d}")


def _write_partitions(incoming, path, keys, order_by, partition_by, whole_keys) -> None:
    spark = incoming.sparkSession
    fresh = incoming if whole_keys else dedupe_latest(incoming, keys, order_by)
    if not paths.exists(spark, path):
        _overwrite_partitions(fresh, path, partition_by)
        return
    fresh = materialize(fresh, "upsert-incoming")
    # Columns that only the table has keep what they hold; a type conflict is an error of the union.
    current = spark.read.option("mergeSchema", "true").parquet(path)
    current = current.withColumn(partition_by, F.col(partition_by).cast(fresh.schema[partition_by].dataType))
    stored = [c for c in current.columns if c not in fresh.columns]
    if stored:
        newest = F.max_by(F.struct(*stored), F.struct(order_by) if isinstance(order_by, str) else F.struct(*order_by))
        old = current.groupBy(*keys).agg(newest.alias("_stored")).alias("t")
        fresh = materialize(
            fresh.alias("f").join(old, same_key("t", "f", keys), "left").select(
                "f.*", *[F.col(f"t._stored.{c}").alias(c) for c in stored]),
            "upsert-incoming")
    # A key may have moved: its old partition is touched as well as its new one.
    asked = asked_keys(fresh, keys)
    moved = current.alias("t").join(asked, same_key("t", "f", keys), "left_semi")
    touched = _values(moved.select(partition_by).union(fresh.select(partition_by)), partition_by)
    kept = current.filter(_one_of(partition_by, touched)).alias("t").join(asked, same_key("t", "f", keys), "left_anti")
    merged = materialize(kept.unionByName(fresh, allowMissingColumns=True), "upsert-merged")
    filled = _values(merged.select(partition_by), partition_by)
    _overwrite_partitions(merged, path, partition_by)
    for value in touched - filled:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value
        paths.drop_directory(spark, f"{path}/{partition_by}={name}")


def _overwrite_partitions(rows: DataFrame, path: str, partition_by: str) -> None:
    # The hint gathers a partition's rows into files of a sensible size and splits large ones.
    (
        rows.hint("rebalance", partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_by)
        .parquet(path)
    )


def _values(df: DataFrame, column: str) -> set:
    """Distinct partition values (one per day for a date column)."""
    return {row[0] for row in df.select(F.col(column).cast("string")).distinct().collect()}


def _one_of(column: str, values: set):
    known = [v for v in values if v is not None]
    hit = F.col(column).cast("string").isin(known)
    return (hit | F.col(column).isNull()) if None in values else hit
