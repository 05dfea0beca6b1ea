"""The transaction record."""

from pyspark.sql import types as T

TRANSACTION = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), False),
        T.StructField("user_id", T.StringType(), False),
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("status", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("merchant", T.StringType(), False),
        T.StructField("card_type", T.StringType(), False),
        T.StructField("location", T.StringType(), True),
        T.StructField("ip_address", T.StringType(), True),
        T.StructField("device_id", T.StringType(), True),
    ]
)

REQUIRED = tuple(f.name for f in TRANSACTION if not f.nullable)
FIELDS = tuple(TRANSACTION.fieldNames())

# What the loaders return: the record plus its event time.
LOADED = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in TRANSACTION]
    + [T.StructField("event_time", T.TimestampType(), True)]
)
