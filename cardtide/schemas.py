"""Column layouts shared by the batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# The ten positions of a wire message and the text between them.
WIRE_FIELDS = (
    "cc_no",
    "cc_provider",
    "txn_time",
    "txn_id",
    "merchant",
    "location",
    "country",
    "items",
    "amount",
    "score",
)
WIRE_SEPARATOR = ";"
ITEM_SEPARATOR = ","
PRICE_ARROW = "->"

# The two outcomes, the score below which a transaction is
# rejected, and how long a stored transaction is kept.
APPROVED = "APPROVED"
REJECTED = "REJECTED"
REJECT_BELOW = 5
RETENTION_SECONDS = 86_400

MONEY = T.DecimalType(18, 2)

ITEMS = T.ArrayType(
    T.StructType([T.StructField("item", T.StringType()), T.StructField("price", MONEY)])
)

# Names and order of the stored transaction columns.
TRANSACTION = T.StructType(
    [
        T.StructField("cc_no", T.StringType()),
        T.StructField("cc_provider", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("min", T.IntegerType()),
        T.StructField("txn_time", T.TimestampType()),
        T.StructField("txn_id", T.StringType()),
        T.StructField("merchant", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("status", T.StringType()),
        T.StructField("date_text", T.StringType()),
    ]
)

# Names of the stored per-minute columns. ``minute_ts`` is the
# real key; the five calendar columns are a readable copy of it.
MINUTE = T.StructType(
    [
        T.StructField("minute_ts", T.TimestampType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("minute", T.IntegerType()),
        T.StructField("approved_rate_min", T.DoubleType()),
        T.StructField("ttl_txn_min", T.LongType()),
        T.StructField("approved_txn_min", T.LongType()),
    ]
)
CARRIED = T.StructType(
    [
        T.StructField("approved_rate_hr", T.DoubleType()),
        T.StructField("ttl_txn_hr", T.LongType()),
        T.StructField("approved_txn_hr", T.LongType()),
    ]
)

# What the tables hold on disk: the row, when it was written, and the partition.
TRANSACTION_TABLE = T.StructType(
    TRANSACTION.fields
    + [
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField("txn_date", T.DateType()),
    ]
)
# The same, partitioned by the day of writing, for tables that expire.
WRITTEN_TABLE = T.StructType(
    TRANSACTION.fields
    + [
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField("ingest_date", T.DateType()),
    ]
)
MINUTE_TABLE = T.StructType(
    MINUTE.fields
    + [
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField("minute_date", T.DateType()),
    ]
)
