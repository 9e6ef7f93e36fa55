"""The screening job as streams: raw transactions, minute rows, duplicates.

State is kept per open minute or per recent transaction id, never per stream, and
watermarks let it go. Carried totals are worked out when the minute table is read
(``operators.carry``): a running total kept in a stream would be one key that every
row goes through, and would count a replayed batch twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from cardtide.functions.calendar import calendar_parts
from cardtide.functions.rates import approval_rate
from cardtide.operators.minutes import minute_rollup
from cardtide.schemas import APPROVED
from cardtide.sources.tables import minute_rows, transaction_rows

# Name of the metric that counts the rows a stream hands to its sink.
ROWS_OUT = "rows_out"


def minutes_of(
    txns: DataFrame, delay: str = "1 minute", beats: DataFrame | None = None, **how
) -> DataFrame:
    """``minute_rollup`` of a stream by event time.

    A minute is given out once, when the watermark (newest time seen less
    ``delay``) has passed its end; rows for it that come later are dropped here, and
    found again by ``sources.complete``. With ``beats`` (``heartbeat``) the watermark moves
    with the clock, so that the last minute closes without a further transaction, and quiet minutes
    are rows with 0.
    """
    if beats is not None:
        txns, how["counted"] = _with_beats(txns, beats, "txn_time"), ~F.col("_beat")
    return minute_rollup(_watermarked(txns, delay), **how)


def minutes_by_arrival(
    txns: DataFrame, calendar: str = "iso", beats: DataFrame | None = None
) -> DataFrame:
    """``minute_rollup`` by the clock at which a micro-batch runs, not by event time.

    ``beats`` as in ``minutes_of``: without them a minute waits for the next transaction.
    """
    arrived, counted = txns.withColumn("arrived_at", F.current_timestamp()), None
    if beats is not None:
        arrived, counted = _with_beats(arrived, beats, "arrived_at"), ~F.col("_beat")
    arrived = arrived.withWatermark("arrived_at", "0 seconds")
    return minute_rollup(arrived, time="arrived_at", calendar=calendar, counted=counted)


def _watermarked(txns: DataFrame, delay: str) -> DataFrame:
    """With a watermark on a time that must be known, as it must in a batch."""
    known = F.coalesce("txn_time", F.raise_error(F.lit("null txn_time")).cast("timestamp"))
    return txns.withColumn("txn_time", known).withWatermark("txn_time", delay)


def heartbeat(spark: SparkSession, per_second: int = 1) -> DataFrame:
    """A stream of clock times, ``timestamp``, from the driver's clock."""
    return spark.readStream.format("rate").option("rowsPerSecond", per_second).load().select("timestamp")


def _with_beats(txns: DataFrame, beats: DataFrame, time: str) -> DataFrame:
    """Status and time of transactions, and rows of the clock without a status."""
    real = txns.select("status", time, F.lit(False).alias("_beat"))
    return real.unionByName(
        beats.select(
            F.lit(None).cast("string").alias("status"),
            F.col("timestamp").alias(time),
            F.lit(True).alias("_beat"),
        )
    )


def sliding_hour_of(txns: DataFrame, delay: str = "1 minute", calendar: str = "iso") -> DataFrame:
    """Trailing-hour totals of a stream, one row per minute with something in its hour.

    Counts minutes first and slides over those, so the sixty-fold overlap applies to
    one row per minute and not to the transactions.
    """
    per_minute = (
        _watermarked(txns, delay)
        .groupBy(F.window("txn_time", "1 minute").alias("_minute"))
        .agg(
            F.count(F.lit(1)).alias("_total"),
            F.count_if(F.col("status") == APPROVED).alias("_approved"),
        )
    )
    hours = per_minute.groupBy(F.window("_minute", "1 hour", "1 minute").alias("_hour")).agg(
        F.sum("_total").alias("_total"), F.sum("_approved").alias("_approved")
    )
    minute_ts = F.col("_hour.end") - F.expr("INTERVAL 1 MINUTE")
    parts = calendar_parts(minute_ts, calendar)
    return hours.select(
        minute_ts.alias("minute_ts"),
        *[part.alias(part_name) for part_name, part in parts.items()],
        approval_rate(F.col("_approved"), F.col("_total")).alias("approved_rate_hr"),
        F.col("_total").alias("ttl_txn_hr"),
        F.col("_approved").alias("approved_txn_hr"),
    )


def unique_transactions(
    txns: DataFrame,
    delay: str = "10 minutes",
    key: str = "txn_id",
    spread: Column | None = None,
    ways: int = 64,
) -> DataFrame:
    """Drop repeats of ``key`` that come within ``delay`` of the first.

    Copies are first dropped within ``ways`` shares of the stream, so a transaction sent very
    many times does not all go to one task; the second pass sees at most ``ways`` copies of
    it. Rows are dealt out at random, the same way if a task runs again, or by ``spread``, any
    number that differs between copies, such as a topic offset. Either pass keeps a
    row of state per recent key; ``ways=1`` saves the first where no key is hot.
    """
    marked = txns.withWatermark("txn_time", delay)
    if ways == 1:
        return marked.dropDuplicatesWithinWatermark([key])
    share = (F.rand(11) * ways).cast("int") if spread is None else F.pmod(spread, F.lit(ways))
    shared = marked.withColumn("_share", share)
    first = shared.dropDuplicatesWithinWatermark([key, "_share"]).drop("_share")
    return first.dropDuplicatesWithinWatermark([key])


def _start(df: DataFrame, path: str, checkpoint: str, day: str, name, trigger, retention):
    writer = (
        df.observe(ROWS_OUT, F.count(F.lit(1)).alias("n"))
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(day)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
    )
    if retention:
        writer = writer.option("retention", retention)
    return (writer.queryName(name) if name else writer).start()


def start_raw(
    txns: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
    retention: str | None = None,
    day: str = "txn_date",
) -> StreamingQuery:
    """Append transactions to their table every second (or as ``trigger`` says).

    ``retention`` (such as ``"86400s"``) makes the sink forget files older than that; with
    ``day="ingest_date"`` they lie by day of writing, and ``expire_written`` deletes them.
    ``BatchLog`` keeps the rows of each batch.
    """
    trigger = trigger or {"processingTime": "1 second"}
    return _start(transaction_rows(txns, day), path, checkpoint, day, name, trigger, retention)


def start_minutes(
    minutes: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
    retention: str | None = None,
) -> StreamingQuery:
    """Append closed minutes to their table every minute (or as ``trigger`` says).

    ``retention`` as in ``start_raw``; it bounds the sink's own list of files.
    """
    trigger = trigger or {"processingTime": "1 minute"}
    rows = minute_rows(minutes)
    return _start(rows, path, checkpoint, "minute_date", name, trigger, retention)


def start_bad_messages(
    bad: DataFrame,
    path: str,
    checkpoint: str,
    name: str | None = None,
    trigger: dict | None = None,
    retention: str | None = None,
) -> StreamingQuery:
    """Append messages set aside (``value, problem``) to a table by day of writing."""
    trigger = trigger or {"processingTime": "1 second"}
    now = F.current_timestamp()
    rows = bad.select(
        "value", "problem", now.alias("ingest_ts"), F.to_date(now).alias("ingest_date")
    )
    return _start(rows, path, checkpoint, "ingest_date", name, trigger, retention)


def start_console(minutes: DataFrame, trigger: dict | None = None) -> StreamingQuery:
    """Print minute rows as they close."""
    trigger = trigger or {"processingTime": "1 minute"}
    return minutes.writeStream.format("console").outputMode("append").trigger(**trigger).start()


def start_screening(
    txns: DataFrame,
    folder: str,
    delay: str = "1 minute",
    trigger: dict | None = None,
    retention: str | None = None,
    bad: DataFrame | None = None,
    beats: DataFrame | None = None,
) -> tuple[StreamingQuery, ...]:
    """Both outputs of one source: raw transactions and minute rows.

    ``sources.complete.complete_minutes`` of both holds every transaction, late ones and those of
    minutes still open included. ``beats`` as in ``minutes_of``.

    Below ``folder``: ``transactions``, ``minutes`` and a checkpoint for each. Started
    again on the same folder, both go on where they stopped. With ``bad`` (``unreadable`` of the
    messages that ``txns`` screens under quarantine) a third query keeps those in
    ``bad_messages``, and one bad message stops nothing.
    """
    raw = start_raw(
        txns, f"{folder}/transactions", f"{folder}/_raw_checkpoint",
        trigger=trigger, retention=retention,
    )
    minutes = start_minutes(
        minutes_of(txns, delay, beats), f"{folder}/minutes", f"{folder}/_minutes_checkpoint",
        trigger=trigger, retention=retention,
    )
    if bad is None:
        return raw, minutes
    aside = start_bad_messages(
        bad, f"{folder}/bad_messages", f"{folder}/_bad_checkpoint",
        trigger=trigger, retention=retention,
    )
    return raw, minutes, aside


def finish(query: StreamingQuery, timeout: int | None = None) -> None:
    """Wait for a query that ends by itself; raise if it failed, or is given a ``timeout``
    in seconds and takes longer. By default it may take as long as its input needs."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"stream did not finish in {timeout} s")


def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for streams with its own number of state partitions.

    A stream keeps the number it first ran with. By default that is one per core, as
    suits state by transaction id. A minute stream holds a few open minutes and wants a
    handful: each further one only adds a commit per batch. The caller's settings, such as its
    state store, hold in it too; the caller's session is left as it is.
    """
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if session.conf.isModifiable(name):
            session.conf.set(name, value)
    width = partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(width))
    return session
