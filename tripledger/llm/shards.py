"""Contiguous shards of near-equal size, cut from global prefix sums of byte sizes.

The rows are range-partitioned and sorted once. Each partition's byte and row totals (one
small row per partition) give every partition its global offset; only the partitions that
hold a cut are summed row by row. Placing the rows is then a map over the sorted files.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripledger.llm.common import packed
from tripledger.sources.scratch import fresh_path

#: Bytes that a document takes besides its text.
OVERHEAD = 8


def _cuts(rows: DataFrame, parts: list, total: int, n_shards: int) -> dict[int, list[int]]:
    """For each partition the row positions at which a next shard begins."""
    before = [0, *accumulate(p["bytes"] for p in parts)]
    #: Shard k takes the rows with 2 * (bytes before) + size at or above points[k - 1].
    points = [-(-2 * total * k // n_shards) for k in range(1, n_shards)]
    hit = {}
    for k, point in enumerate(points):
        at = next(i for i in range(len(parts)) if 2 * before[i] <= point < 2 * before[i + 1])
        hit.setdefault(at, []).append(point)
    found: dict[int, list[int]] = {}
    if not hit:
        return found
    in_order = Window.partitionBy("part").orderBy("at")
    offsets = F.create_map(*[F.lit(x) for i in hit for x in (parts[i]["part"], before[i])])
    wanted = F.create_map(*[x for i, ps in hit.items()
                            for x in (F.lit(parts[i]["part"]), F.array(*[F.lit(p) for p in ps]))])
    summed = (
        rows.where(F.col("part").isin([parts[i]["part"] for i in hit]))
        .select("part", "at", "size", F.sum("size").over(in_order).alias("upto"))
        .select("part", "at", "size",
                (F.element_at(offsets, F.col("part")) + F.col("upto")).alias("end"),
                F.element_at(wanted, F.col("part")).alias("points"))
        .select("part", "at", F.explode("points").alias("point"), "end", "size")
        .where("2 * (end - size) <= point AND point < 2 * end")
    )
    for r in summed.collect():  # one row per cut
        first = r["at"] if 2 * (r["end"] - r["size"]) + r["size"] >= r["point"] else r["at"] + 1
        found.setdefault(r["part"], []).append(first)
    return {p: sorted(at) for p, at in found.items()}


def write_shards(docs: DataFrame, path: str, n_shards: int = 24, key: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Write `docs` in key order as `n_shards` folders of near-equal bytes, and read them back.

    Returns `row` (the whole input row), `size` (UTF-8 bytes of the text plus 8), `slot` (place
    in the shard, gapless from 0) and `shard`. A document belongs to the shard that holds its
    middle byte, so a shard misses its target by half a document at either end at most.

    Null texts count as empty. Null keys come first. Rows with one key are ordered by a hash of
    their text; equal rows may take each other's place. An empty input gives no row. More shards
    than documents leave some shards empty. Columns named like the results stay inside `row`.
    """
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD
    sized = packed(docs, key=F.col(key), size=size, tie=F.xxhash64(text),
                   n=F.monotonically_increasing_id())
    in_order = ("key", "tie", "n")
    ordered = fresh_path(spark, "ordered")
    (
        sized.repartitionByRange(*in_order).sortWithinPartitions(*in_order)
        .select("row", "size", F.spark_partition_id().alias("part"))
        .write.option("compression", "zstd").option("maxRecordsPerFile", 0).parquet(ordered)
    )
    # One file per partition, so a row's place in its file is its place in the partition.
    schema = T.StructType([sized.schema["row"], T.StructField("size", T.LongType()),
                           T.StructField("part", T.IntegerType())])
    rows = spark.read.schema(schema).parquet(ordered).select(
        "row", "size", "part", F.col("_metadata.row_index").alias("at"))
    parts = rows.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    parts = sorted(parts.collect(), key=lambda p: p["part"])  # one row per partition
    total = sum(p["bytes"] for p in parts)
    cuts = _cuts(rows.drop("row"), parts, total, n_shards) if total else {}

    table, shard, first_rows = [], 0, [0]
    for p, rows_before in zip(parts, [0, *accumulate(p["rows"] for p in parts)]):
        at = cuts.get(p["part"], [])
        table.append((p["part"], rows_before, shard, at))
        first_rows += [rows_before + x for x in at]
        shard += len(at)
    first_rows += [first_rows[-1]] * (n_shards - len(first_rows))
    # One row per partition of the range cut, with the cuts that lie in it.
    places = F.broadcast(spark.createDataFrame(
        table, "part int, rows_before long, shard_before int, cuts array<long>"))
    shard_col = F.col("shard_before") + F.size(F.filter("cuts", lambda c: c <= F.col("at")))
    slot = F.col("rows_before") + F.col("at") - F.element_at(
        F.array(*[F.lit(x).cast("long") for x in first_rows]), F.col("shard") + 1)
    (
        rows.join(places, "part").withColumn("shard", shard_col.cast("int"))
        .select("row", "size", slot.alias("slot"), "shard")
        .write.option("compression", "zstd").partitionBy("shard").parquet(path)
    )
    schema = T.StructType([sized.schema["row"], T.StructField("size", T.LongType()),
                           T.StructField("slot", T.LongType()),
                           T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)
