"""Column expressions shared by the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Runs of space, tab, line feed, vertical tab, form feed and carriage return part words.
SPACE = "[\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """The words of a text, in order; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def packed(docs: DataFrame, **columns: Column) -> DataFrame:
    """Every input column in one struct `row`, so that no name clashes with the given ones."""
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns])
    return docs.select(whole.alias("row"), *[c.alias(n) for n, c in columns.items()])


def unpacked(df: DataFrame, like: DataFrame, *more: str, **changed: Column) -> DataFrame:
    """The inverse of `packed`: `changed` replaces input columns, `more` follows them.

    A name in `more` that the input has already takes the place of the input's column.
    """
    kept = [n for n in like.columns if n not in more]
    cols = [(changed[n] if n in changed else F.col(f"row.`{n}`")).alias(n) for n in kept]
    return df.select(*cols, *more)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
