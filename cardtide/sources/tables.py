"""The two stored tables: write, read, create, extend, expire, query with SQL."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from cardtide.operators.carry import chained_totals
from cardtide.operators.keyed import expiry_bound, latest_per_key, retain
from cardtide.schemas import (
    CARRIED,
    MINUTE,
    MINUTE_TABLE,
    RETENTION_SECONDS,
    TRANSACTION,
    TRANSACTION_TABLE,
)


# Partition days of the transaction table, and the times they are the day of.
DAYS = {"txn_date": "txn_time", "ingest_date": "ingest_ts"}


def transaction_rows(txns: DataFrame, day: str = "txn_date") -> DataFrame:
    """Stored form: the fifteen columns, the time of writing and the partition day, which is
    that of the transaction (``txn_date``) or of writing (``ingest_date``)."""
    if day not in DAYS:
        raise ValueError(f"day must be one of {tuple(DAYS)}, not {day!r}")
    ingest = F.col("ingest_ts") if "ingest_ts" in txns.columns else F.current_timestamp()
    rows = txns.select(*TRANSACTION.names, ingest.alias("ingest_ts"))
    return rows.withColumn(day, F.to_date(DAYS[day]))


def minute_rows(minutes: DataFrame) -> DataFrame:
    """Stored form of minute rows, with the time of writing and the partition day."""
    ingest = F.col("ingest_ts") if "ingest_ts" in minutes.columns else F.current_timestamp()
    return minutes.select(
        *MINUTE.names, ingest.alias("ingest_ts"), F.to_date("minute_ts").alias("minute_date")
    )


def write_transactions(
    txns: DataFrame,
    path: str,
    mode: str = "append",
    rebalance: bool = False,
    keys: Sequence[str] = (),
) -> None:
    """Write transactions partitioned by day.

    Input in time order needs no shuffle: each task writes one or two days. For
    input in any other order ``rebalance`` gathers days first, with AQE splitting
    days that are too large for one task. ``keys`` such as ``["txn_id", "cc_no"]`` are
    columns to look rows up by (``by_key``, ``find_transactions``).
    """
    rows = transaction_rows(txns)
    if keys:
        by_key(rows, "txn_date", keys).mode(mode).partitionBy("txn_date").parquet(path)
        return
    if rebalance:
        rows = rows.hint("rebalance", F.col("txn_date"))
    rows.write.mode(mode).partitionBy("txn_date").parquet(path)


def by_key(rows: DataFrame, day: str, keys: Sequence[str]) -> DataFrameWriter:
    """A writer of day partitions in which few row groups may hold a key.

    Days are gathered, AQE splitting large ones, and sorted by key, so row groups' ranges do not
    overlap within a file; a Bloom filter on each key rules out most others. A lookup
    by key then reads the row groups that can have it.
    """
    sorted_rows = rows.hint("rebalance", F.col(day)).sortWithinPartitions(day, *keys)
    writer = sorted_rows.write
    for key in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
    return writer


def write_minutes(minutes: DataFrame, path: str, mode: str = "append") -> None:
    """Write minute rows partitioned by day, one file of at most 1,440 rows for each."""
    width = int(minutes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = minute_rows(minutes).repartition(width, "minute_date")
    rows.write.mode(mode).partitionBy("minute_date").parquet(path)


def write_counted(txns: DataFrame, path: str, **how) -> int:
    """``write_transactions``, and how many rows it wrote, from the same pass."""
    seen = Observation("rows_processed")
    write_transactions(txns.observe(seen, F.count(F.lit(1)).alias("n")), path, **how)
    return seen.get["n"]


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return read_with(spark, path, TRANSACTION_TABLE)


def find_transactions(
    spark: SparkSession,
    path: str,
    day: dt.date | tuple[dt.date, dt.date] | None = None,
    **keys: str,
) -> DataFrame:
    """Transactions by ``txn_id``, ``cc_no`` or other columns, of a day or of days from to.

    The values reach the scan: on a table written with these ``keys``, row groups are passed over by
    their range or Bloom filter, and days by their partition. A value of None finds nulls.
    """
    found = read_transactions(spark, path)
    for key, value in keys.items():
        found = found.filter(F.col(key).isNull() if value is None else F.col(key) == F.lit(value))
    if day is not None:
        first, last = day if isinstance(day, tuple) else (day, day)
        found = found.filter(F.col("txn_date").between(F.lit(first), F.lit(last)))
    return found


def read_minutes(spark: SparkSession, path: str) -> DataFrame:
    """Stored minutes, of each the row written last, so that a minute written again replaces
    its earlier row. Rows of unknown time of writing are the oldest.

    The partition day and the calendar parts are part of the key, which they follow from, so
    that filters on them reach the scan.
    """
    kept = ["ttl_txn_min", "approved_txn_min", "approved_rate_min", "ingest_ts"]
    stored = read_with(spark, path, MINUTE_TABLE)
    keys = [c for c in stored.columns if c not in kept]
    return latest_per_key(stored, keys, ["ingest_ts"]).drop("ingest_ts")


def read_with(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read Parquet as ``schema``.

    Files written before a column was added give null for it. No footer is read to
    find the schema, however many files there are.
    """
    return spark.read.schema(schema).parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """Read Parquet with the union of its files' schemas, where none is known."""
    return spark.read.option("mergeSchema", True).parquet(path)


def read_retained(
    spark: SparkSession,
    path: str,
    seconds: int = RETENTION_SECONDS,
    as_of: dt.datetime | None = None,
) -> DataFrame:
    """Stored transactions that have not expired."""
    return retain(read_transactions(spark, path), "ingest_ts", seconds, as_of)


def create_tables(
    spark: SparkSession,
    transactions_path: str,
    minutes_path: str,
    transactions: str = "transactions",
    minutes: str = "txn_count_min",
) -> None:
    """Create both tables in the catalog, empty or over what the paths hold.

    Rows added by path later are seen once ``spark.catalog.recoverPartitions`` has found
    their days; rows added with ``transaction_rows(df).write.insertInto(table)`` at once.
    """
    for name, path, schema, day in (
        (transactions, transactions_path, TRANSACTION_TABLE, "txn_date"),
        (minutes, minutes_path, MINUTE_TABLE, "minute_date"),
    ):
        # An empty append makes the folder and adds no file.
        spark.createDataFrame([], schema).write.mode("append").partitionBy(day).parquet(path)
        location = path.replace("\\", "\\\\").replace("'", "\\'")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
            f"PARTITIONED BY ({day}) LOCATION '{location}'"
        )
        spark.catalog.recoverPartitions(name)


def create_minute_view(
    spark: SparkSession, source: str = "txn_count_min", view: str = "txn_count_min_carried"
) -> None:
    """Keep in the catalog, for every session: a view of all eleven minute columns, and a table
    function of the same name and ``_between`` for the days from one to another.

    ``source`` is the catalog's minute table (``create_tables``). Both are SQL: of a minute written again
    the last row counts, days are chained one by one, and what crosses midnight goes through
    one row per day, as in ``chained_totals``. The function reads the days up to its last one.
    """
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in [*MINUTE, *CARRIED])
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {_carried_sql(source)}")
    spark.sql(
        f"CREATE OR REPLACE FUNCTION {view}_between(first_day DATE, last_day DATE) "
        f"RETURNS TABLE ({columns}) RETURN SELECT * FROM "
        f"({_carried_sql(source, 'minute_date <= last_day')}) WHERE to_date(minute_ts) >= first_day"
    )


def _carried_sql(source: str, wanted: str = "true") -> str:
    """Minute rows of a table with the totals carried into them."""
    counts = [c for c in MINUTE.names if c.endswith("_min")]
    key = ", ".join(c for c in MINUTE.names if c not in counts)
    newest = ", ".join(f"newest.{c}" for c in counts)
    return f"""
WITH stored AS (
  SELECT {key}, max(struct(ingest_ts, {", ".join(counts)})) AS newest
  FROM {source} WHERE {wanted} GROUP BY minute_date, {key}
),
numbered AS (
  SELECT {key}, {newest}, unix_seconds(minute_ts) DIV 60 AS m,
         floor(unix_seconds(minute_ts) / 86400) AS utc_day
  FROM stored
),
gaps AS (
  SELECT *, CASE WHEN m - lag(m) OVER (PARTITION BY utc_day ORDER BY m) = 1 THEN 0 ELSE 1 END AS gap
  FROM numbered
),
runs AS (SELECT *, sum(gap) OVER (PARTITION BY utc_day ORDER BY m) AS run FROM gaps),
totals AS (
  SELECT *, sum(ttl_txn_min) OVER in_run AS total, sum(approved_txn_min) OVER in_run AS approved
  FROM runs WINDOW in_run AS (PARTITION BY utc_day, run ORDER BY m ROWS UNBOUNDED PRECEDING)
),
ends AS (
  SELECT utc_day, min(m) AS first_m, max(m) AS last_m, max(run) AS runs,
         max_by(total, m) AS total, max_by(approved, m) AS approved
  FROM totals GROUP BY utc_day
),
touching AS (
  SELECT *, coalesce(first_m - lag(last_m) OVER (ORDER BY utc_day) = 1, false) AS touches FROM ends
),
chains AS (
  SELECT *, sum(CASE WHEN touches AND runs = 1 THEN 0 ELSE 1 END) OVER (ORDER BY utc_day) AS chain
  FROM touching
),
passed AS (
  SELECT *, sum(total) OVER in_chain AS total_out, sum(approved) OVER in_chain AS approved_out
  FROM chains WINDOW in_chain AS (PARTITION BY chain ORDER BY utc_day ROWS UNBOUNDED PRECEDING)
),
taken AS (
  SELECT utc_day, CASE WHEN touches THEN lag(total_out) OVER (ORDER BY utc_day) ELSE 0 END AS total_in,
         CASE WHEN touches THEN lag(approved_out) OVER (ORDER BY utc_day) ELSE 0 END AS approved_in
  FROM passed
),
carried AS (
  SELECT totals.*, total + CASE WHEN run = 1 THEN total_in ELSE 0 END AS ttl_txn_hr,
         approved + CASE WHEN run = 1 THEN approved_in ELSE 0 END AS approved_txn_hr
  FROM totals JOIN taken USING (utc_day)
)
SELECT {", ".join(MINUTE.names)},
       coalesce(try_divide(CAST(approved_txn_hr AS DOUBLE), ttl_txn_hr) * 100D, 0D) AS approved_rate_hr,
       ttl_txn_hr, approved_txn_hr
FROM carried"""


def add_column(spark: SparkSession, table: str, column: str, kind: str) -> None:
    """Add a column to a catalog table; rows already stored give null for it."""
    spark.sql(f"ALTER TABLE {table} ADD COLUMNS (`{column}` {kind})")


def register_views(
    spark: SparkSession,
    transactions_path: str,
    minutes_path: str,
    transactions: str = "transactions",
    minutes: str = "txn_count_min",
) -> None:
    """Make both stored tables available to ``spark.sql`` under these names.

    The minute view also has the carried totals, which are worked out when it is read.
    """
    read_transactions(spark, transactions_path).createOrReplaceTempView(transactions)
    chained_totals(read_minutes(spark, minutes_path)).createOrReplaceTempView(minutes)


def expired_days(
    spark: SparkSession,
    path: str,
    seconds: int = RETENTION_SECONDS,
    as_of: dt.datetime | None = None,
) -> list[dt.date]:
    """Partition days of a transaction table in which every row has expired.

    The newest write of each day decides, so a day that received a late row stays, and so does
    a day with a row whose time of writing is not known. Only the ``ingest_ts`` column is read;
    the answer has one entry per day. Rows that arrive for a day after this was asked are not
    seen: let no writer add to days as old as that before ``drop_days`` has ended.
    """
    newest = (
        read_transactions(spark, path)
        .groupBy("txn_date")
        .agg(
            F.max("ingest_ts").alias("ingest_ts"),
            F.count_if(F.col("ingest_ts").isNull()).alias("_unknown"),
        )
    )
    bound = expiry_bound(newest.schema["ingest_ts"].dataType, seconds, as_of)
    expired = (F.col("_unknown") == 0) & (F.col("ingest_ts") <= bound)
    gone = newest.filter(expired).orderBy("txn_date")
    return [row.txn_date for row in gone.select("txn_date").toLocalIterator()]


def drop_days(spark: SparkSession, path: str, days: Iterable[dt.date]) -> None:
    """Delete these partition days of a batch-written transaction table.

    For a table written by a stream use the ``retention`` option of its sink, which
    also keeps the sink's own list of files right (``start_raw`` passes it on).
    """
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.exists(hadoop.Path(root, "_spark_metadata")):
        raise ValueError(f"{path} is written by a stream; set retention on its sink")
    for day in days:
        files.delete(hadoop.Path(root, f"txn_date={day.isoformat()}"), True)
