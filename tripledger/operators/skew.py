"""Finding the few keys that hold very many rows, before a plan is chosen.

One pass reads only the key columns and keeps a frequent-items sketch per frame, fed by a
tenth of the rows. Sketches merge in two levels, so no task sees more than a share of them.
What comes back to the driver is bounded: at most `max_hot` keys per frame. Which keys are
reported only decides how rows are spread; every row is in the result, and results are the
same with any list, also with an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 5_000_000
SKIP_BELOW_BYTES = 64 << 20
LOOK_AT = 0.1


@dataclass(frozen=True)
class KeyProfile:
    """Estimated rows, rows without key, and rows of each hot key."""

    rows: int = 0
    null_keys: int = 0
    hot: dict[str, int] = field(default_factory=dict)


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def profile_keys(
    frames: dict[str, DataFrame],
    key: str,
    *,
    min_rows: int = HOT_ROWS,
    max_hot: int = 1000,
    tracked: int = 20_000,
    leaves: int = 64,
    skip_below_bytes: int = SKIP_BELOW_BYTES,
    look_at: float = LOOK_AT,
) -> dict[str, KeyProfile]:
    """Rows, rows without key and hot keys (at least `min_rows` rows) of every frame.

    Frames that together are smaller than `skip_below_bytes` are not read: a task can take all
    of what so few bytes hold, unless every column repeats one value. The sketch looks at a share `look_at` of the rows, in which
    a key with millions of rows cannot hide; of `tracked` items it keeps, it misses none
    with more than about 3.5 / tracked of the rows.
    """
    empty = {name: KeyProfile() for name in frames}
    if sum(plan_bytes(df) for df in frames.values()) < skip_below_bytes:
        return empty
    keys = reduce(
        DataFrame.unionByName,
        [
            _looked_at(df.select(F.col(key).cast("string").alias("item")), look_at)
            .select(F.lit(name).alias("frame"), "item")
            for name, df in frames.items()
        ],
    )
    # `pmod` of the partition number spreads the merging of sketches over `leaves` tasks.
    part = keys.groupBy("frame", F.pmod(F.spark_partition_id(), F.lit(leaves)).alias("leaf")).agg(
        F.expr(f"approx_top_k_accumulate(item, {tracked})").alias("sketch"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("item").isNull()).alias("n_null"),
    )
    found = part.groupBy("frame").agg(
        F.expr(
            f"approx_top_k_estimate(approx_top_k_combine(sketch, {tracked}), {max_hot})"
        ).alias("top"),
        F.sum("n").alias("n"),
        F.sum("n_null").alias("n_null"),
    )
    for row in found.collect():
        estimates = {t["item"]: round(t["count"] / look_at) for t in row["top"] if t["item"] is not None}
        hot = {item: n for item, n in estimates.items() if n >= min_rows}
        empty[row["frame"]] = KeyProfile(round(row["n"] / look_at), round(row["n_null"] / look_at), hot)
    return empty


def _looked_at(keys: DataFrame, share: float) -> DataFrame:
    return keys if share >= 1 else keys.sample(fraction=share, seed=7)


def among(column: Column, values) -> Column:
    return column.isin(list(values))


def not_among(column: Column, values) -> Column:
    """Rows outside the list, those without a value included."""
    return column.isNull() | ~column.isin(list(values))


def stable_salt(buckets: Column, *columns: str) -> Column:
    """A bucket number that is the same when a lost task runs again.

    It depends on the row's content and its input partition, never on row order or chance;
    the partition number spreads groups of identical copies.
    """
    return F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in columns]), buckets)
