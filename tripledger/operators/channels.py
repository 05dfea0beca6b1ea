"""Routing of rows to channels, row counts per channel, and the record contract."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.schema import FIELDS, REQUIRED


def channel_of(source: str = "source") -> Column:
    """Bank and gateway sources by name; every other source is a processor."""
    bank, gateway, processor = fv.TOPICS
    return (
        F.when(F.col(source).isin(*fv.BANK_SOURCES), bank)
        .when(F.col(source).isin(*fv.GATEWAY_SOURCES), gateway)
        .otherwise(processor)
    )


def channel_split(txns: DataFrame) -> DataFrame:
    return txns.withColumn("channel", channel_of())


def load_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Loaded rows per name, zero included; each frame is counted once."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def conformance(txns: DataFrame) -> DataFrame:
    """Violations of the record contract, one row per rule, from one pass over the data.

    Rules: every required field is present, and the status is one of its channel's words.
    """
    known = channel_of()
    allowed = reduce(
        lambda rest, c: F.when(known == c, F.col("status").isin(*fv.STATUSES[c])).otherwise(rest),
        fv.STATUSES,
        F.lit(None).cast("boolean"),
    )
    rules = {f"required:{f}": F.col(f).isNull() for f in REQUIRED}
    rules["domain:status"] = ~allowed
    counts = txns.select(*FIELDS).agg(
        F.count(F.lit(1)).alias("checked"), *[F.count_if(bad).alias(rule) for rule, bad in rules.items()]
    )
    return counts.select(
        "checked",
        F.inline(F.array(*[
            F.struct(F.lit(r).alias("rule"), F.col(f"`{r}`").alias("violations")) for r in rules
        ])),
    ).select("rule", "checked", "violations")
