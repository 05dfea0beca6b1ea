"""Raw messages to typed columns.

One JSON parse per message. A second, cheaper look happens only for messages that are not
JSON objects: the plain-text format, other JSON values, and everything else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger import fixed_values as fv

# Amounts stay text until validation: a DOUBLE field would turn the text "12.5" into NULL.
_FIELDS = "transaction_id STRING, user_id STRING, timestamp STRING, amount STRING, status STRING, malformed STRING"
_STRICT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "malformed", "allowSingleQuotes": "false"}
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_SPACE = " \t\r\n"

PARSED = ("transaction_id", "user_id", "event_time", "amount_text", "status")
ERROR, INVALID, MISSING_FIELDS, VALID = "error", "invalid", "missing", "valid"
ALERT, NORMAL = "alert", "normal"


# From year 1 to year 9999; beyond it a long may not be a timestamp at all.
_FIRST_MS, _LAST_MS = -62_135_596_800_000, 253_402_300_799_999


def event_time(millis: Column | str) -> Column:
    """Time of epoch milliseconds; NULL outside the years 1 to 9999."""
    millis = F.col(millis) if isinstance(millis, str) else millis
    return F.when(millis.between(_FIRST_MS, _LAST_MS), F.timestamp_millis(millis))


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds the parsed fields and `shape`: 'json', 'text', 'error' or 'invalid'.

    'error' is JSON that is not an object (or no message at all), 'invalid' is neither JSON
    nor the text format. A status that is absent or null reads 'unknown'. `timestamp_text` is
    what the message holds as its time, whether or not it is one.
    """
    raw = F.col(value)
    # Only what may be an object goes to the JSON parser: failing it is slow.
    opened = F.startswith(F.ltrim(raw, F.lit(_SPACE)), F.lit("{"))
    parsed = messages.withColumn("_json", F.when(opened, F.from_json(raw, _FIELDS, _STRICT)))
    json = F.col("_json")
    # The parser stops after the object; text behind it makes the message invalid.
    closed = F.endswith(F.rtrim(raw, F.lit(_SPACE)), F.lit("}"))
    well_formed = json.isNotNull() & json["malformed"].isNull()
    text = "(?U)" + fv.TEXT_MESSAGE
    shape = (
        F.when(raw.isNull(), ERROR)
        .when(well_formed, F.when(closed, "json").otherwise(INVALID))
        .when(raw.rlike(text), "text")
        .when(F.try_parse_json(raw).isNotNull(), ERROR)
        .otherwise(INVALID)
    )
    shaped = parsed.withColumn("shape", shape)
    is_json, is_text = F.col("shape") == "json", F.col("shape") == "text"

    def field(name: str, group: int | None = None) -> Column:
        column = F.when(is_json, json[name])
        return column if group is None else column.when(is_text, F.regexp_extract(raw, text, group))

    fields = {
        "shape": F.col("shape"),
        "transaction_id": field("transaction_id"),
        "user_id": field("user_id", 1),
        "event_time": event_time(field("timestamp").try_cast("bigint")),
        "timestamp_text": field("timestamp"),
        "amount_text": field("amount", 2),
        "status": F.when(
            is_json | is_text, F.coalesce(field("status"), F.lit(fv.STATUS_WHEN_ABSENT))
        ),
    }
    # As a generator of one row, so that filters on the fields stay above it: pushed below,
    # each of them would parse the message again.
    row = F.struct(*[column.alias(name) for name, column in fields.items()])
    return shaped.select(*[c for c in messages.columns if c not in fields], F.inline(F.array(row)))


def classify(parsed: DataFrame) -> DataFrame:
    """Adds `amount` and `row_class`: 'error', 'invalid', 'missing' or 'valid'.

    Amounts that are no finite number are errors.
    """
    number = F.when(F.col("amount_text").rlike(_NUMBER), F.trim("amount_text").try_cast("double"))
    amount = F.when(F.abs(number) < float("inf"), number)
    incomplete = F.col("user_id").isNull() | (F.col("user_id") == "") | F.col("amount_text").isNull()
    return parsed.withColumn("amount", amount).withColumn(
        "row_class",
        F.when(F.col("shape").isin(ERROR, INVALID), F.col("shape"))
        .when(incomplete, MISSING_FIELDS)
        .when(F.col("amount").isNull(), ERROR)
        .otherwise(VALID),
    )


def class_alone() -> Column:
    """Final class of a classified row judged without any history of its user."""
    alone = (F.col("amount") > fv.LARGE_AMOUNT) | F.col("status").isin(*fv.SUSPICIOUS_STATUSES)
    return F.when(F.col("row_class") != VALID, F.col("row_class")).otherwise(
        F.when(alone, ALERT).otherwise(NORMAL)
    )
