"""The fraud rules as columns, and the verdict line as text.

The typed columns are the contract. The text is derived from them; numbers beyond ten
million or with more than two decimals may print differently than in other languages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger import fixed_values as fv
from tripledger.functions.messages import ALERT, ERROR, INVALID, MISSING_FIELDS, NORMAL


def apply_rules(df: DataFrame, threshold: float = fv.LARGE_AMOUNT) -> DataFrame:
    """Adds the rule flags, `is_suspicious` and `row_class`; needs `txn_count`, `txn_total`."""
    rules = {
        "is_large": F.col("amount") > F.lit(float(threshold)),
        "is_repeated": (F.col("txn_count") >= fv.REPEAT_COUNT) & (F.col("txn_total") > fv.REPEAT_TOTAL),
        "is_bad_status": F.coalesce(F.col("status").isin(*fv.SUSPICIOUS_STATUSES), F.lit(False)),
    }
    flagged = df.withColumns(rules)
    suspicious = F.col("is_large") | F.col("is_repeated") | F.col("is_bad_status")
    return flagged.withColumn("is_suspicious", suspicious).withColumn(
        "row_class", F.when(F.col("is_suspicious"), ALERT).otherwise(NORMAL)
    )


def reasons(threshold: float = fv.LARGE_AMOUNT) -> Column:
    """Texts of the rules that fired, in rule order."""
    return F.array_compact(
        F.array(
            F.when(
                F.col("is_large"),
                F.format_string(fv.REASON_LARGE, F.col("amount").cast("string"), F.lit(str(float(threshold)))),
            ),
            F.when(F.col("is_repeated"), F.format_string(fv.REASON_REPEAT, "txn_total", "user_id")),
            F.when(F.col("is_bad_status"), F.format_string(fv.REASON_STATUS, "status")),
        )
    )


def alert_text(threshold: float = fv.LARGE_AMOUNT) -> Column:
    """Verdict line of a judged row."""
    joined = F.array_join(reasons(threshold), fv.REASON_JOINER)
    return F.when(
        F.col("is_suspicious"), F.format_string(fv.LINE_ALERT, "user_id", "amount", joined)
    ).otherwise(F.format_string(fv.LINE_NORMAL, "user_id", "amount"))


def rejected_text(value: str = "value") -> Column:
    """Verdict line of a row that is not valid."""
    lines = {INVALID: fv.LINE_INVALID, MISSING_FIELDS: fv.LINE_MISSING, ERROR: fv.LINE_ERROR}
    column = F.lit(None).cast("string")
    for row_class, line in lines.items():
        column = F.when(F.col("row_class") == row_class, F.format_string(line, value)).otherwise(column)
    return column
