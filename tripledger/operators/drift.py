"""Contract drift: what raw messages hold besides, instead of or without what the contract says.

Messages are parsed to VARIANT, which keeps whatever they hold, and their top-level fields are
counted by name and type in one aggregate, folded before the shuffle to one row per group, field
and type in each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripledger.schema import TRANSACTION

KNOWN, RETYPED, EMPTY, UNKNOWN, ABSENT, UNREADABLE = "known", "retyped", "empty", "unknown", "absent", "unreadable"
#: Types a value of a declared type may have in JSON.
_FITS = {T.StringType(): ("string",), T.LongType(): ("integer",), T.DoubleType(): ("integer", "number")}


def value_type(variant: Column) -> Column:
    """string, integer, number, boolean, null, array or object."""
    name = F.schema_of_variant(variant)
    return (
        F.when(name.startswith("OBJECT"), "object").when(name.startswith("ARRAY"), "array")
        .when(name == "VOID", "null").when(name == "BIGINT", "integer")
        .when(name.startswith("DECIMAL") | name.isin("DOUBLE", "FLOAT"), "number")
        .otherwise(F.lower(name))
    )


def schema_drift(messages: DataFrame, by: Sequence[str] = ("topic", "event_date"), value: str = "value") -> DataFrame:
    """One row per group, field and type of value: `kind`, how many messages, and their share.

    Kinds: `known` (as the contract says), `retyped` (another type), `empty` (null where a value is
    required), `unknown` (no such field in the contract), `absent` (a required field that messages
    lack), and `unreadable` for messages that are no JSON object, which have neither field nor type.
    """
    by = list(by)
    # Written as variant once; a message that is no object is counted by itself.
    parsed = messages.select(*by, F.try_parse_json(value).alias("_v"))
    is_object = F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False))
    as_map = F.when(is_object, F.variant_get("_v", "$", "map<string, variant>"))
    entries = F.transform(F.map_entries(as_map), lambda e: F.struct(e["key"].alias("field"), value_type(e["value"]).alias("type")))
    required = [f.name for f in TRANSACTION if not f.nullable]
    missing = F.transform(
        F.array_except(F.array(*map(F.lit, required)), F.map_keys(as_map)),
        lambda f: F.struct(f.alias("field"), F.lit(ABSENT).alias("type")))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit("message").alias("type")))
    broken = F.array(F.struct(F.lit(None).cast("string").alias("field"), F.lit(UNREADABLE).alias("type")))
    found = F.concat(whole, F.when(is_object, F.concat(entries, missing)).otherwise(broken))
    counts = parsed.select(*by, F.inline(found)).groupBy(*by, "field", "type").agg(F.count(F.lit(1)).alias("messages"))
    # A group has as many rows as it has fields and types.
    total = F.max(F.when(F.col("type") == "message", F.col("messages"))).over(Window.partitionBy(*by))
    judged = counts.withColumns({"_total": total, "kind": _kind()}).where("type <> 'message'")
    named = F.when(~F.col("kind").isin(ABSENT, UNREADABLE), F.col("type"))
    return judged.select(*by, "field", "kind", named.alias("type"), "messages", (F.col("messages") / F.col("_total")).alias("share"))


def _kind() -> Column:
    fits, names = F.lit(False), []
    for f in TRANSACTION:
        types = (*_FITS[f.dataType], *(("null",) if f.nullable else ()))
        fits = fits | ((F.col("field") == f.name) & F.col("type").isin(*types))
        names.append(f.name)
    return (
        F.when(F.col("type").isin(ABSENT, UNREADABLE), F.col("type"))
        .when(~F.col("field").isin(*names), UNKNOWN).when(fits, KNOWN)
        .when(F.col("type") == "null", EMPTY).otherwise(RETYPED)
    )
