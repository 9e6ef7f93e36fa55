"""

``queries()[name](spark, sf_dir)`` runs on the whole of the named tables;
``oracle_sql()[name]`` says the same in DuckDB SQL. Timestamps leave as
``timestamp_ntz`` and money as double so that both sides have the same types.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardtide import schemas
from cardtide.functions import (
    approved_only,
    card_number,
    card_provider,
    classify,
    decode_wire,
    encode_wire,
)
from cardtide.operators import (
    assign_weighted,
    basket_totals,
    chained_totals,
    explode_items,
    fill_quiet_minutes,
    fold_items,
    latest_per_key,
    minute_rollup,
    point_lookup,
    retain,
    sliding_hour,
    with_previous,
)
from cardtide.plans.events import PROVIDERS, wire_rows
from cardtide.plans.screening import screen, screened_minutes, to_transactions, unreadable
from cardtide.scratch import new_folder
from cardtide.sources.carried import read_chained, write_carry
from cardtide.sources.complete import complete_minutes, settle_minutes, settled_minutes
from cardtide.sources.expiry import expire_written, read_unexpired
from cardtide.sources.files import stream_parquet
from cardtide.sources.tables import (
    create_minute_view,
    create_tables,
    drop_days,
    expired_days,
    find_transactions,
    minute_rows,
    read_minutes,
    read_transactions,
    read_with,
    register_views,
    write_counted,
    write_minutes,
    write_transactions,
)
from cardtide.streaming import (
    BatchLog,
    finish,
    minutes_by_arrival,
    minutes_of,
    sliding_hour_of,
    start_merged,
    start_minutes,
    start_raw,
    start_screening,
    state_session,
    unique_transactions,
)

try:  # the training-data operators may be left out
    import corpus_pipeline
    from cardtide.llm import entries as llm_entries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "cardtide.llm"):
        raise
    corpus_pipeline = llm_entries = None

SMOKE_DIR = "/root/testdata/sf0.001"
ONCE = {"availableNow": True}


# Inputs -----------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def _wire_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wire_rows(_table(_utc(spark), sf_dir, "events"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_wire(_wire_rows(spark, sf_dir))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_wire_rows(spark, sf_dir))


def _minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minute_rollup(_judged(spark, sf_dir))


def _stored_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minute table as a reader finds it: rolled up once, written, read back."""
    path = new_folder(spark, "minutes")
    write_minutes(_minutes(spark, sf_dir), path)
    return read_minutes(spark, path)


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = _table(spark, sf_dir, "events").schema
    return stream_parquet(spark, f"{sf_dir}/events*.parquet", schema)


def _ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def _result(df: DataFrame) -> DataFrame:
    """Timestamps without zone, for comparison."""
    return _ntz(df, *[n for n, kind in df.dtypes if kind == "timestamp"])


# Decoding and classifying -------------------------------------------------------


def decode_transactions(spark, sf_dir):
    return _result(screen(_messages(spark, sf_dir)))


def calendar_compat(spark, sf_dir):
    rows = to_transactions(_wire_rows(spark, sf_dir), calendar="compat")
    return rows.select("txn_id", "year", "month", "day", "hour", "min", "date_text")


def approved_transactions(spark, sf_dir):
    return _result(
        approved_only(_judged(spark, sf_dir)).select("txn_id", "txn_time", "merchant", "status")
    )


def encode_messages(spark, sf_dir):
    return _messages(spark, sf_dir)


def _damaged(rows: DataFrame) -> DataFrame:
    """Messages of wire rows, some of them damaged in four ways."""
    kind = F.col("txn_id").cast("bigint") % 7
    sent = encode_wire(rows, keep=["txn_id"])
    fields = F.split("value", schemas.WIRE_SEPARATOR)

    def with_field(position: int, text: str) -> Column:
        return F.concat_ws(
            schemas.WIRE_SEPARATOR,
            F.transform(fields, lambda x, i: F.when(i == position, F.lit(text)).otherwise(x)),
        )

    return sent.select(
        F.col("txn_id").alias("sent_id"),
        F.when(kind == 0, F.concat_ws(schemas.WIRE_SEPARATOR, F.slice(fields, 1, 9)))
        .when(kind == 1, with_field(9, "abc"))
        .when(kind == 2, with_field(8, ""))
        .when(kind == 3, with_field(2, "not-a-time"))
        .otherwise(F.col("value"))
        .alias("value"),
    )


def quarantine_split(spark, sf_dir):
    """Decode damaged messages, and say what became of each."""
    damaged = _damaged(_wire_rows(spark, sf_dir))
    decoded = decode_wire(damaged, on_error="quarantine", keep=["sent_id"])
    return decoded.select(
        "sent_id", "problem", F.col("score").cast("string").alias("score"), "merchant"
    )


def custom_rules(spark, sf_dir):
    """Two rules in order, with the reason kept."""
    rules = [("low_score", F.col("score") < 5), ("large", F.col("amount") >= 100)]
    judged = classify(_wire_rows(spark, sf_dir), rules=rules, reason="reason")
    return judged.select("txn_id", "status", "reason")


# Baskets ------------------------------------------------------------------------


def _folded(spark, sf_dir):
    return fold_items(
        _table(_utc(spark), sf_dir, "lineitem"),
        "l_orderkey",
        item=F.concat(F.lit("Item_"), F.col("l_partkey").cast("string")),
        price=F.col("l_extendedprice"),
        order_by=["l_linenumber"],
    )


def fold_baskets(spark, sf_dir):
    return _folded(spark, sf_dir).withColumn("amount", F.col("amount").cast("double"))


def items_roundtrip(spark, sf_dir):
    """Fold to text, take the text apart again, and add the printed prices up."""
    items = explode_items(_folded(spark, sf_dir), ["l_orderkey"])
    totals = items.groupBy("l_orderkey").agg(
        F.sum("price").cast("double").alias("amount"), F.count(F.lit(1)).alias("n_items")
    )
    return totals


def basket_amounts(spark, sf_dir):
    totals = basket_totals(_folded(spark, sf_dir), "l_orderkey")
    return totals.withColumn("amount", F.col("amount").cast("double"))


def _segment_shares(spark, sf_dir) -> DataFrame:
    """Market segments' cumulative shares of the customers: five rows."""
    counts = _table(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("c_mktsegment")
    running = counts.withColumns(
        {"upto": F.sum("n").over(order), "total": F.sum("n").over(Window.partitionBy())}
    )
    return running.select(
        (F.col("upto").cast("double") / F.col("total")).alias("cum"),
        F.col("c_mktsegment").alias("merchant"),
    )


def _basket_rows(spark, sf_dir) -> DataFrame:
    """Wire rows of baskets: merchant and place dealt out by shares, items from the lines."""
    orders = _table(_utc(spark), sf_dir, "orders")
    u = (F.col("l_orderkey") * 37 % 1000).cast("double") / 1000
    baskets = _folded(spark, sf_dir).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    dealt = assign_weighted(
        baskets.withColumn("u", u),
        _segment_shares(spark, sf_dir),
        labels={"merchant": "All Other"},
    )
    dealt = assign_weighted(dealt, _shares(spark, sf_dir), labels={"label": "All Other", "region": ""})
    provider = card_provider(F.col("o_custkey") % PROVIDERS)
    return dealt.select(
        card_number(provider, F.col("o_custkey")).alias("cc_no"),
        provider.alias("cc_provider"),
        F.col("o_orderdate").cast("timestamp").alias("txn_time"),
        F.col("l_orderkey").cast("string").alias("txn_id"),
        "merchant",
        F.concat(F.lit("R"), F.col("region")).alias("location"),
        F.col("label").alias("country"),
        "items",
        "amount",
        (F.col("o_custkey") % 100).cast("int").alias("score"),
    )


def basket_messages(spark, sf_dir):
    """Baskets out and in again: folded, labelled, encoded, decoded, judged, items added up."""
    sent = encode_wire(_basket_rows(spark, sf_dir))
    read = classify(decode_wire(sent))
    kept = ["txn_id", "txn_time", "merchant", "location", "country", "amount", "status"]
    items = explode_items(read, kept)
    totals = items.groupBy(*kept).agg(
        F.sum("price").cast("double").alias("items_total"), F.count(F.lit(1)).alias("n_items")
    )
    return _result(totals)


# Minutes --------------------------------------------------------------------------


def minute_rollup_query(spark, sf_dir):
    return _result(_minutes(spark, sf_dir))


def minute_rollup_compat(spark, sf_dir):
    return _result(minute_rollup(_judged(spark, sf_dir), label="end", calendar="compat"))


def previous_minute(spark, sf_dir):
    rows = with_previous(_minutes(spark, sf_dir))
    return _result(
        rows.select(
            "minute_ts",
            "ttl_txn_min",
            "approved_txn_min",
            "prev_ttl_txn_min",
            "prev_approved_txn_min",
        )
    )


def previous_minute_stored(spark, sf_dir):
    """The same lookup as a join with the stored table, on its carried totals."""
    stored = _stored_minutes(spark, sf_dir)
    carried = chained_totals(stored)
    rows = with_previous(stored, carried, columns=["ttl_txn_hr", "approved_txn_hr"])
    return _result(
        rows.select("minute_ts", "ttl_txn_min", "prev_ttl_txn_hr", "prev_approved_txn_hr")
    )


def chained(spark, sf_dir):
    return _result(chained_totals(_minutes(spark, sf_dir)))


def chained_wire(spark, sf_dir):
    """Flagship: wire text to minute rows with chained totals."""
    return _result(screened_minutes(_messages(spark, sf_dir)))


def filled_minutes(spark, sf_dir):
    return _result(fill_quiet_minutes(_stored_minutes(spark, sf_dir)))


def chained_spine(spark, sf_dir):
    return _result(chained_totals(fill_quiet_minutes(_stored_minutes(spark, sf_dir))))


def sliding(spark, sf_dir):
    return _result(sliding_hour(_minutes(spark, sf_dir)))


def sliding_spine(spark, sf_dir):
    return _result(sliding_hour(fill_quiet_minutes(_stored_minutes(spark, sf_dir))))


# Keyed storage ---------------------------------------------------------------------

KEY = ["year", "month", "day", "hour", "minute"]


def latest_per_key_compat(spark, sf_dir):
    rows = minute_rollup(_judged(spark, sf_dir), calendar="compat")
    return _result(latest_per_key(rows, KEY, ["minute_ts"]))


def latest_per_transaction(spark, sf_dir):
    """Each transaction written twice, the second time an hour later and doubled."""
    rows = _wire_rows(spark, sf_dir).select("txn_id", "txn_time", "merchant", "amount")
    again = rows.withColumns(
        {"txn_time": F.col("txn_time") + F.expr("INTERVAL 1 HOUR"), "amount": F.col("amount") * 2}
    )
    return _result(latest_per_key(rows.unionByName(again), ["txn_id"], ["txn_time"]))


def retain_day(spark, sf_dir):
    events = _table(_utc(spark), sf_dir, "events")
    newest = events.agg(F.max("ts")).first()[0]
    kept = retain(events, "ts", schemas.RETENTION_SECONDS, newest)
    return kept.select("event_id", "ts", "event_type")


def minutes_written_twice(spark, sf_dir):
    """Minute rows written with other counts first: the later ones are read and chained."""
    path = new_folder(_utc(spark), "minutes")
    minutes = _minutes(spark, sf_dir)
    write_minutes(minutes.withColumn("ttl_txn_min", F.col("ttl_txn_min") + 1), path)
    write_minutes(minutes, path)
    return _result(chained_totals(read_minutes(spark, path)).drop("minute_date"))


def point_lookup_query(spark, sf_dir):
    """The last minute's row, by its five-part key, from the stored table."""
    stored = _stored_minutes(spark, sf_dir)
    ts = stored.agg(F.max("minute_ts").cast("timestamp_ntz")).first()[0]
    return _result(
        point_lookup(stored, ts.year, ts.month, ts.day, ts.hour, ts.minute).drop("minute_date")
    )


def _days_between(minutes: DataFrame) -> tuple[dt.date, dt.date, dt.date]:
    """First, middle and last day of a minute table."""
    first, last = minutes.agg(F.min("minute_date"), F.max("minute_date")).first()
    return first, first + (last - first) // 2, last


def chained_from_carry(spark, sf_dir):
    """Carried totals kept per closed day: each half of the days is read from the row before it."""
    path = new_folder(spark, "carry")
    stored = _stored_minutes(spark, sf_dir)
    first, middle, last = _days_between(stored)
    for before in (middle, last):
        write_carry(stored, path, before)
    later = middle + dt.timedelta(days=1)
    halves = read_chained(stored, path, first, middle).unionByName(read_chained(stored, path, later))
    return _result(halves.drop("minute_date"))


def lookup_transaction(spark, sf_dir):
    """The newest transaction by its id, and all transactions of its card by the card."""
    path = new_folder(spark, "transactions")
    txns = to_transactions(_wire_rows(spark, sf_dir))
    write_transactions(txns, path, keys=["txn_id", "cc_no"])
    newest = read_transactions(spark, path).agg(F.max_by("txn_id", "txn_time")).first()[0]
    one = find_transactions(spark, path, txn_id=newest)
    card, day = one.select("cc_no", "txn_date").first()
    one = find_transactions(spark, path, day=day, txn_id=newest).withColumn("found_by", F.lit("id"))
    card = find_transactions(spark, path, cc_no=card).withColumn("found_by", F.lit("card"))
    both = one.unionByName(card)
    return _result(both.select("found_by", "txn_id", "cc_no", "txn_time", "merchant", "amount"))


# Lookup on cumulative weights ---------------------------------------------------------


def _shares(spark, sf_dir) -> DataFrame:
    """Nations' cumulative shares of the customers: 25 rows."""
    customer = _table(spark, sf_dir, "customer")
    nation = _table(spark, sf_dir, "nation")
    counts = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    order = Window.orderBy("c_nationkey")
    running = counts.withColumns(
        {"upto": F.sum("n").over(order), "total": F.sum("n").over(Window.partitionBy())}
    )
    return running.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        (F.col("upto").cast("double") / F.col("total")).alias("cum"),
        F.col("n_name").alias("label"),
        F.col("n_regionkey").cast("string").alias("region"),
    )


def _numbered(spark, sf_dir) -> DataFrame:
    customer = _table(_utc(spark), sf_dir, "customer")
    n = customer.select(F.count(F.lit(1))).scalar()
    return customer.select(
        "c_custkey", ((F.col("c_custkey") * 37 % n).cast("double") / n).alias("u")
    )


def assign_weighted_query(spark, sf_dir):
    return assign_weighted(_numbered(spark, sf_dir), _shares(spark, sf_dir))


def assign_weighted_pair(spark, sf_dir):
    """Two labels, and bounds that stop short of 1 so that some rows get the default."""
    shares = _shares(spark, sf_dir).filter(F.col("cum") <= 0.9)
    labels = {"label": "All Other", "region": ""}
    return assign_weighted(_numbered(spark, sf_dir), shares, labels=labels)


def assign_weighted_sliced(spark, sf_dir):
    """The way taken for bounds too many to broadcast."""
    return assign_weighted(
        _numbered(spark, sf_dir), _shares(spark, sf_dir), max_broadcast_bytes=0
    )


def assign_by_counts(spark, sf_dir):
    """Customers dealt out by running counts of orders: many bounds, far from [0, 1)."""
    orders = _table(_utc(spark), sf_dir, "orders")
    customer = _table(spark, sf_dir, "customer").select("c_custkey")
    bounds = orders.select(
        (F.col("o_orderkey") * 3).cast("double").alias("cum"),
        F.col("o_orderkey").cast("string").alias("label"),
    )
    numbers = customer.withColumn("u", (F.col("c_custkey") * 37 + 0.5).cast("double"))
    return assign_weighted(numbers, bounds)


# Tables and SQL ------------------------------------------------------------------------


def transactions_table(spark, sf_dir):
    """Write decoded transactions partitioned by day, and read the table."""
    path = new_folder(spark, "transactions")
    write_transactions(screen(_messages(spark, sf_dir)), path, rebalance=True)
    stored = read_transactions(spark, path).drop("ingest_ts")
    return _result(stored.withColumn("txn_date", F.col("txn_date").cast("string")))


def rows_processed(spark, sf_dir):
    """Rows counted while they are written, against the rows the table then holds."""
    path = new_folder(spark, "transactions")
    n = write_counted(screen(_messages(spark, sf_dir)), path)
    stored = read_transactions(spark, path).agg(F.count(F.lit(1)).alias("stored"))
    return stored.withColumn("processed", F.lit(n).cast("long"))


def added_column(spark, sf_dir):
    """Rows stored before ``date_text`` existed read as null beside rows stored since."""
    path = new_folder(spark, "transactions")
    rows = to_transactions(_wire_rows(spark, sf_dir)).select("txn_id", "txn_time", "date_text")
    rows.drop("date_text").write.parquet(path)
    rows.write.mode("append").parquet(path)
    return _result(read_with(spark, path, rows.schema))


def expire_days(spark, sf_dir):
    """Store by day, drop the days in which every row has expired, count what is left."""
    path = new_folder(spark, "transactions")
    txns = to_transactions(_wire_rows(spark, sf_dir))
    write_transactions(txns.withColumn("ingest_ts", F.col("txn_time")), path)
    newest = read_transactions(spark, path).agg(F.max("ingest_ts").cast("timestamp_ntz")).first()[0]
    drop_days(spark, path, expired_days(spark, path, as_of=newest))
    left = read_transactions(spark, path).groupBy("txn_date").agg(F.count(F.lit(1)).alias("n_txn"))
    return left.withColumn("txn_date", F.col("txn_date").cast("string"))


SQL_TEXT = """
SELECT t.merchant, t.status, count(*) AS n_txn, max(m.ttl_txn_min) AS busiest_minute
FROM transactions t
JOIN txn_count_min m ON date_trunc('minute', t.txn_time) = m.minute_ts
GROUP BY t.merchant, t.status
"""


def _views(spark, sf_dir):
    transactions, minutes = new_folder(spark, "transactions"), new_folder(spark, "minutes")
    write_transactions(to_transactions(_wire_rows(spark, sf_dir)), transactions)
    write_minutes(minute_rollup(read_transactions(spark, transactions)), minutes)
    register_views(spark, transactions, minutes)


def sql_view(spark, sf_dir):
    _views(spark, sf_dir)
    return spark.sql(SQL_TEXT)


CARRIED_TEXT = """
SELECT year, month, day, hour, minute, ttl_txn_min, approved_txn_min, approved_rate_min,
       ttl_txn_hr, approved_txn_hr, approved_rate_hr
FROM txn_count_min
"""


def sql_view_carried(spark, sf_dir):
    """The eleven columns of the minute table, by SQL."""
    _views(spark, sf_dir)
    return spark.sql(CARRIED_TEXT)


def sql_table_function(spark, sf_dir):
    """The eleven minute columns by another session, from what the catalog keeps in SQL: the view
    for the first half of the days, the table function for the second."""
    transactions, minutes = new_folder(_utc(spark), "transactions"), new_folder(spark, "minutes")
    names = [f"{n}_{uuid.uuid4().hex}" for n in ("transactions", "minutes", "carried")]
    create_tables(spark, transactions, minutes, *names[:2])
    minute_rows(_minutes(spark, sf_dir)).repartition("minute_date").write.insertInto(names[1])
    create_minute_view(spark, names[1], names[2])
    first, middle, last = _days_between(spark.table(names[1]))
    other = state_session(spark)
    early = other.sql(f"SELECT * FROM {names[2]} WHERE to_date(minute_ts) <= DATE '{middle}'")
    later = other.sql(
        f"SELECT * FROM {names[2]}_between(DATE '{middle}' + INTERVAL 1 DAY, DATE '{last}')"
    )
    return _result(early.unionByName(later))


# Streams -------------------------------------------------------------------------------


def stream_raw(spark, sf_dir):
    path = new_folder(_utc(spark), "transactions")
    messages = encode_wire(wire_rows(_event_stream(spark, sf_dir)))
    finish(start_raw(screen(messages), path, f"{path}_checkpoint", trigger=ONCE))
    return _result(read_transactions(spark, path).drop("ingest_ts", "txn_date"))


def stream_minute_rollup(spark, sf_dir):
    path = new_folder(_utc(spark), "minutes")
    session = state_session(spark, 8)
    judged = classify(wire_rows(_event_stream(session, sf_dir)))
    minutes = minutes_of(judged)
    finish(start_minutes(minutes, path, f"{path}_checkpoint", trigger=ONCE))
    return _result(read_minutes(spark, path).drop("minute_date"))


def stream_chained(spark, sf_dir):
    """Streamed minute rows, carried totals worked out when they are read."""
    return _result(chained_totals(stream_minute_rollup(spark, sf_dir)))


def stream_sliding_hour(spark, sf_dir):
    path = new_folder(_utc(spark), "hours")
    session = state_session(spark, 8)
    hours = sliding_hour_of(classify(wire_rows(_event_stream(session, sf_dir))))
    finish(
        hours.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}_checkpoint")
        .trigger(**ONCE)
        .start()
    )
    return _result(read_with(spark, path, hours.schema))


def stream_by_arrival(spark, sf_dir):
    """Minutes by the clock of the batch, as stored rows carry it; which minutes those are is
    left out."""
    path = new_folder(_utc(spark), "transactions")
    txns = to_transactions(wire_rows(_event_stream(spark, sf_dir)))
    finish(start_raw(txns, path, f"{path}_checkpoint", trigger=ONCE))
    return minute_rollup(read_transactions(spark, path), time="ingest_ts").agg(
        F.sum("ttl_txn_min").alias("ttl_txn"), F.sum("approved_txn_min").alias("approved_txn")
    )


def stream_quarantine(spark, sf_dir):
    """All outputs of one stream with damaged messages: which were stored, which set aside."""
    folder = new_folder(_utc(spark), "screening")
    sent = _damaged(wire_rows(_event_stream(state_session(spark, 8), sf_dir)))
    good = screen(sent, on_error="quarantine")
    for query in start_screening(good, folder, trigger=ONCE, bad=unreadable(sent)):
        finish(query)
    kept = read_transactions(spark, f"{folder}/transactions").select(
        F.col("txn_id").alias("sent_id"), "status", F.lit(None).cast("string").alias("problem")
    )
    aside = read_with(spark, f"{folder}/bad_messages", unreadable(sent).schema).select(
        F.split("value", schemas.WIRE_SEPARATOR)[3].alias("sent_id"),
        F.lit(None).cast("string").alias("status"),
        "problem",
    )
    return kept.unionByName(aside)


def _in_two_runs(spark, sf_dir, folder: str, start) -> None:
    """Run a job over events of which every fifth comes a run later, behind the watermark."""
    events = _table(spark, sf_dir, "events")
    late = F.col("event_id") % 5 == 0
    for part in (events.filter(~late), events.filter(late)):
        part.write.mode("append").parquet(f"{folder}/source")
        session = state_session(spark, 8)
        stream = stream_parquet(session, f"{folder}/source", events.schema)
        for query in start(to_transactions(wire_rows(stream))):
            finish(query)


def stream_screening(spark, sf_dir):
    """Both outputs of one stream with late rows: the minutes of both together are complete."""
    folder = new_folder(_utc(spark), "screening")
    _in_two_runs(spark, sf_dir, folder, lambda txns: start_screening(txns, folder, trigger=ONCE))
    minutes = complete_minutes(spark, f"{folder}/minutes", f"{folder}/transactions")
    return _result(minutes.drop("minute_date"))


def stream_settled(spark, sf_dir):
    """The same, with the minutes counted again stored, and totals carried over them."""
    folder = new_folder(_utc(spark), "screening")
    _in_two_runs(spark, sf_dir, folder, lambda txns: start_screening(txns, folder, trigger=ONCE))
    tables = f"{folder}/minutes", f"{folder}/transactions", f"{folder}/settled"
    settle_minutes(spark, *tables)
    minutes = settled_minutes(spark, tables[0], tables[2])
    return _result(chained_totals(minutes).drop("minute_date"))


def stream_upsert(spark, sf_dir):
    """Every event, and in a later run every event again with twice the amount: merged at write."""
    folder = new_folder(_utc(spark), "merged")
    events = _table(spark, sf_dir, "events")
    table = f"{folder}/transactions"
    for part in (events, events.withColumn("value", F.col("value") * 2)):
        part.write.mode("append").parquet(f"{folder}/source")
        stream = stream_parquet(state_session(spark), f"{folder}/source", events.schema)
        txns = to_transactions(wire_rows(stream))
        finish(start_merged(txns, table, f"{folder}/checkpoint", trigger=ONCE))
    kept = read_transactions(spark, table)
    return _result(kept.select("txn_id", "txn_time", "cc_no", "merchant", "amount", "status"))


def expire_streamed(spark, sf_dir):
    """A stream stored by day of writing, here the transaction's own time: expired days are
    deleted, and what has not expired is counted."""
    path = new_folder(_utc(spark), "transactions")
    txns = to_transactions(wire_rows(_event_stream(spark, sf_dir)))
    txns = txns.withColumn("ingest_ts", F.col("txn_time"))
    finish(start_raw(txns, path, f"{path}_checkpoint", trigger=ONCE, day="ingest_date"))
    newest = _table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    expire_written(spark, path, as_of=newest, listed="delete")
    left = read_unexpired(spark, path, as_of=newest).groupBy("ingest_date")
    return left.agg(F.count(F.lit(1)).alias("n_txn")).withColumn(
        "ingest_date", F.col("ingest_date").cast("string")
    )


def stream_by_clock(spark, sf_dir):
    """Minutes by the clock of the batch, closed by a beat of the clock and no transaction. Which
    minute that is is left out."""
    path = new_folder(_utc(spark), "minutes")
    beat = F.current_timestamp() + F.expr("INTERVAL 10 MINUTES")
    spark.range(1).select(beat.alias("timestamp")).write.parquet(f"{path}_beats")
    session = state_session(spark, 8)
    beats = session.readStream.schema("timestamp timestamp").parquet(f"{path}_beats")
    txns = to_transactions(wire_rows(_event_stream(session, sf_dir)))
    minutes = minutes_by_arrival(txns, beats=beats)
    finish(start_minutes(minutes, path, f"{path}_checkpoint", trigger=ONCE))
    return read_minutes(spark, path).select("approved_rate_min", "ttl_txn_min", "approved_txn_min")


def stream_rows_processed(spark, sf_dir):
    """Rows in, out and too late, as a listener kept them per batch, against the table's rows."""
    path = new_folder(_utc(spark), "transactions")
    session = state_session(spark)
    log = BatchLog(session, f"{path}_batches")
    txns = to_transactions(wire_rows(_event_stream(session, sf_dir)))
    query = start_raw(txns, path, f"{path}_checkpoint", trigger=ONCE)
    finish(query)
    log.wait(query)
    log.close()
    sums = log.batches().agg(*[F.sum(c).alias(c) for c in ("rows_in", "rows_out", "rows_late")])
    stored = read_transactions(spark, path).agg(F.count(F.lit(1)).alias("rows_stored"))
    return sums.withColumn("rows_stored", F.lit(stored.first()[0]).cast("long"))


def stream_dedup(spark, sf_dir):
    """Every event sent twice, kept once."""
    path = new_folder(_utc(spark), "unique")
    events = _event_stream(state_session(spark), sf_dir)
    sent = events.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1))))
    sent = sent.withColumn("_offset", F.col("_metadata.row_index") * 2 + F.col("_copy"))
    rows = sent.select(
        F.col("event_id").cast("string").alias("txn_id"),
        F.col("ts").cast("timestamp").alias("txn_time"),
        F.col("event_type").alias("merchant"),
        "_offset",
    )
    unique = unique_transactions(rows, spread=F.col("_offset")).drop("_offset")
    finish(
        unique.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}_checkpoint")
        .trigger(**ONCE)
        .start()
    )
    return _result(read_with(spark, path, unique.schema))


# Contract ------------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return chained_wire(spark, SMOKE_DIR)


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_entries is None:
        return {}
    return llm_entries.queries() | {"pipeline": corpus_pipeline.run}


def _llm_sql() -> dict[str, str]:
    if llm_entries is None:
        return {}
    own = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return llm_entries.oracle_sql() | own


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "decode_transactions": decode_transactions,
        "calendar_compat": calendar_compat,
        "approved_transactions": approved_transactions,
        "encode_messages": encode_messages,
        "quarantine_split": quarantine_split,
        "custom_rules": custom_rules,
        "fold_baskets": fold_baskets,
        "items_roundtrip": items_roundtrip,
        "basket_amounts": basket_amounts,
        "basket_messages": basket_messages,
        "minute_rollup": minute_rollup_query,
        "minute_rollup_compat": minute_rollup_compat,
        "previous_minute": previous_minute,
        "previous_minute_stored": previous_minute_stored,
        "chained_totals": chained,
        "chained_totals_wire": chained_wire,
        "filled_minutes": filled_minutes,
        "chained_totals_spine": chained_spine,
        "sliding_hour": sliding,
        "sliding_hour_spine": sliding_spine,
        "latest_per_key_compat": latest_per_key_compat,
        "latest_per_transaction": latest_per_transaction,
        "retain_day": retain_day,
        "minutes_written_twice": minutes_written_twice,
        "point_lookup": point_lookup_query,
        "assign_weighted": assign_weighted_query,
        "assign_weighted_pair": assign_weighted_pair,
        "assign_weighted_sliced": assign_weighted_sliced,
        "assign_by_counts": assign_by_counts,
        "transactions_table": transactions_table,
        "rows_processed": rows_processed,
        "added_column": added_column,
        "expire_days": expire_days,
        "sql_view": sql_view,
        "sql_view_carried": sql_view_carried,
        "stream_raw": stream_raw,
        "stream_minute_rollup": stream_minute_rollup,
        "stream_chained": stream_chained,
        "stream_sliding_hour": stream_sliding_hour,
        "stream_by_arrival": stream_by_arrival,
        "stream_quarantine": stream_quarantine,
        "stream_dedup": stream_dedup,
        "chained_from_carry": chained_from_carry,
        "lookup_transaction": lookup_transaction,
        "sql_table_function": sql_table_function,
        "stream_screening": stream_screening,
        "stream_settled": stream_settled,
        "stream_upsert": stream_upsert,
        "expire_streamed": expire_streamed,
        "stream_by_clock": stream_by_clock,
        "stream_rows_processed": stream_rows_processed,
    } | _llm_queries()


# The transactions that events stand for.
_TXN = """
txn AS (
  SELECT printf('%04d', user_id % 9999) || printf('%012d', user_id) AS cc_no,
         printf('%04d', user_id % 9999) AS cc_provider,
         ts AS txn_time, CAST(event_id AS VARCHAR) AS txn_id, event_type AS merchant,
         '' AS location, 'US' AS country, '' AS items,
         CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS amount,
         CAST(json_extract(props, '$.k') AS INTEGER) AS score,
         CASE WHEN CAST(json_extract(props, '$.k') AS INTEGER) < 5
              THEN 'REJECTED' ELSE 'APPROVED' END AS status
  FROM events
)"""

_TXN_COLUMNS = """
  cc_no, cc_provider,
  CAST(year(txn_time) AS INTEGER) AS year, CAST(month(txn_time) AS INTEGER) AS month,
  CAST(day(txn_time) AS INTEGER) AS day, CAST(hour(txn_time) AS INTEGER) AS hour,
  CAST(minute(txn_time) AS INTEGER) AS min,
  txn_time, txn_id, merchant, location, country, amount, status,
  strftime(txn_time, '%Y%m%d') AS date_text"""

# Minute counts, of the minutes that have any.
_COUNTS = (
    _TXN
    + """,
counts AS (
  SELECT date_trunc('minute', txn_time) AS minute_ts, count(*) AS ttl,
         count(*) FILTER (WHERE status = 'APPROVED') AS app
  FROM txn GROUP BY 1
)"""
)

# The same, with the quiet minutes between the first and the last.
_SPINE = (
    _COUNTS
    + """,
spine AS (
  SELECT unnest(generate_series(min(minute_ts), max(minute_ts), INTERVAL 1 MINUTE)) AS minute_ts
  FROM counts
),
filled AS (
  SELECT s.minute_ts, coalesce(c.ttl, 0) AS ttl, coalesce(c.app, 0) AS app
  FROM spine s LEFT JOIN counts c ON s.minute_ts = c.minute_ts
)"""
)

# Minutes that a one-minute watermark has closed when the events run out.
_CLOSED = (
    _COUNTS
    + """,
closed AS (
  SELECT * FROM counts
  WHERE minute_ts + INTERVAL 1 MINUTE
        <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 MINUTE
)"""
)

_MINUTE_PARTS = """
  CAST(year(minute_ts) AS INTEGER) AS year, CAST(month(minute_ts) AS INTEGER) AS month,
  CAST(day(minute_ts) AS INTEGER) AS day, CAST(hour(minute_ts) AS INTEGER) AS hour,
  CAST(minute(minute_ts) AS INTEGER) AS minute"""

_MINUTE_PARTS_COMPAT = """
  CAST(year(minute_ts) AS INTEGER) AS year, CAST(month(minute_ts) - 1 AS INTEGER) AS month,
  CAST(day(minute_ts) AS INTEGER) AS day, CAST(hour(minute_ts) % 12 AS INTEGER) AS hour,
  CAST(minute(minute_ts) AS INTEGER) AS minute"""

_MINUTE_COUNTS = """
  CASE WHEN ttl > 0 THEN app / CAST(ttl AS DOUBLE) * 100.0 ELSE 0.0 END AS approved_rate_min,
  CAST(ttl AS BIGINT) AS ttl_txn_min, CAST(app AS BIGINT) AS approved_txn_min"""

_MINUTE_COLUMNS = f"minute_ts, {_MINUTE_PARTS}, {_MINUTE_COUNTS}"

_HOUR_COUNTS = """
  CASE WHEN ttl_hr > 0 THEN app_hr / CAST(ttl_hr AS DOUBLE) * 100.0 ELSE 0.0 END
    AS approved_rate_hr,
  CAST(ttl_hr AS BIGINT) AS ttl_txn_hr, CAST(app_hr AS BIGINT) AS approved_txn_hr"""


def _chain(source: str) -> str:
    """Running totals of ``source`` that restart after a missing minute."""
    return f""",
breaks AS (
  SELECT *, CASE WHEN lag(minute_ts) OVER (ORDER BY minute_ts) + INTERVAL 1 MINUTE = minute_ts
                 THEN 0 ELSE 1 END AS brk
  FROM {source}
),
islands AS (SELECT *, sum(brk) OVER (ORDER BY minute_ts) AS isl FROM breaks),
carried AS (
  SELECT *, sum(ttl) OVER (PARTITION BY isl ORDER BY minute_ts) AS ttl_hr,
            sum(app) OVER (PARTITION BY isl ORDER BY minute_ts) AS app_hr
  FROM islands
)"""


def _slide(source: str) -> str:
    """Totals of ``source`` over the sixty minutes that end with each row."""
    return f""",
carried AS (
  SELECT *, sum(ttl) OVER w AS ttl_hr, sum(app) OVER w AS app_hr FROM {source}
  WINDOW w AS (ORDER BY minute_ts
               RANGE BETWEEN INTERVAL 59 MINUTES PRECEDING AND CURRENT ROW)
)"""


_FULL_ROW = f"SELECT {_MINUTE_COLUMNS}, {_HOUR_COUNTS} FROM carried"

_BASKETS = """
WITH entries AS (
  SELECT l_orderkey, l_linenumber, 'Item_' || l_partkey AS item,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem
)"""

_SHARES = """
WITH shares AS (
  SELECT CAST(sum(n) OVER (ORDER BY c_nationkey) AS DOUBLE) / sum(n) OVER () AS cum,
         n_name AS label, CAST(n_regionkey AS VARCHAR) AS region
  FROM (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY c_nationkey)
  JOIN nation ON c_nationkey = n_nationkey
),
numbered AS (
  SELECT c_custkey,
         CAST(c_custkey * 37 % (SELECT count(*) FROM customer) AS DOUBLE)
           / (SELECT count(*) FROM customer) AS u
  FROM customer
)"""

_ASSIGN = (
    _SHARES
    + """
SELECT c_custkey, u, coalesce(label, 'All Other') AS label
FROM numbered ASOF LEFT JOIN shares ON u <= cum"""
)


def oracle_sql() -> dict[str, str]:
    chained_sql = f"WITH {_COUNTS}{_chain('counts')} {_FULL_ROW}"
    transactions_sql = f"WITH {_TXN} SELECT {_TXN_COLUMNS} FROM txn"
    minutes_sql = f"WITH {_COUNTS} SELECT {_MINUTE_COLUMNS} FROM counts"
    return {
        "decode_transactions": transactions_sql,
        "calendar_compat": f"""
WITH {_TXN}, t AS (SELECT txn_id, txn_time AS minute_ts FROM txn)
SELECT txn_id, year, month, day, hour, minute AS min,
       printf('%04d%02d%02d', year, month, day) AS date_text
FROM (SELECT txn_id, {_MINUTE_PARTS_COMPAT} FROM t)""",
        "approved_transactions": f"""
WITH {_TXN} SELECT txn_id, txn_time, merchant, status FROM txn WHERE status = 'APPROVED'""",
        "encode_messages": f"""
WITH {_TXN}
SELECT cc_no || ';' || cc_provider || ';'
       || CASE WHEN contains(CAST(txn_time AS VARCHAR), '.') THEN CAST(txn_time AS VARCHAR)
               ELSE CAST(txn_time AS VARCHAR) || '.0' END
       || ';' || txn_id || ';' || merchant || ';' || location || ';' || country || ';' || items
       || ';' || CAST(CAST(amount AS DECIMAL(18,2)) AS VARCHAR) || ';' || score AS value
FROM txn""",
        "quarantine_split": f"""
WITH {_TXN}
SELECT txn_id AS sent_id,
       CASE CAST(txn_id AS BIGINT) % 7
            WHEN 0 THEN 'too few fields' WHEN 1 THEN 'bad score'
            WHEN 2 THEN 'bad amount' WHEN 3 THEN 'bad txn_time' END AS problem,
       CASE WHEN CAST(txn_id AS BIGINT) % 7 > 1 THEN CAST(score AS VARCHAR) END AS score, merchant
FROM txn""",
        "custom_rules": f"""
WITH {_TXN}
SELECT txn_id,
       CASE WHEN score < 5 OR amount >= 100 THEN 'REJECTED' ELSE 'APPROVED' END AS status,
       CASE WHEN score < 5 THEN 'low_score' WHEN amount >= 100 THEN 'large' END AS reason
FROM txn""",
        "fold_baskets": f"""{_BASKETS}
SELECT l_orderkey, 0 AS part,
       string_agg(item || '->' || CAST(price AS VARCHAR), ','
                  ORDER BY l_linenumber, item, price) AS items,
       CAST(sum(price) AS DOUBLE) AS amount, count(*) AS n_items
FROM entries GROUP BY l_orderkey""",
        "items_roundtrip": f"""{_BASKETS}
SELECT l_orderkey, CAST(sum(price) AS DOUBLE) AS amount, count(*) AS n_items
FROM entries GROUP BY l_orderkey""",
        "basket_amounts": f"""{_BASKETS}
SELECT l_orderkey, CAST(sum(price) AS DOUBLE) AS amount, count(*) AS n_items
FROM entries GROUP BY l_orderkey""",
        "basket_messages": f"""{_SHARES},
segments AS (
  SELECT CAST(sum(n) OVER (ORDER BY c_mktsegment) AS DOUBLE) / sum(n) OVER () AS cum, c_mktsegment
  FROM (SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment)
),
baskets AS (
  SELECT l_orderkey, CAST(l_orderkey * 37 % 1000 AS DOUBLE) / 1000 AS u, count(*) AS n_items,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total
  FROM lineitem GROUP BY l_orderkey
),
sold AS (SELECT b.*, c_mktsegment AS merchant FROM baskets b ASOF LEFT JOIN segments ON u <= cum),
dealt AS (SELECT s.*, label, region FROM sold s ASOF LEFT JOIN shares ON s.u <= shares.cum)
SELECT CAST(l_orderkey AS VARCHAR) AS txn_id, CAST(o_orderdate AS TIMESTAMP) AS txn_time, merchant,
       'R' || region AS location, label AS country, total AS amount,
       CASE WHEN o_custkey % 100 < 5 THEN 'REJECTED' ELSE 'APPROVED' END AS status,
       total AS items_total, n_items
FROM dealt JOIN orders ON o_orderkey = l_orderkey""",
        "minute_rollup": minutes_sql,
        "minute_rollup_compat": f"""
WITH {_COUNTS},
ends AS (SELECT minute_ts + INTERVAL 1 MINUTE AS minute_ts, ttl, app FROM counts)
SELECT minute_ts, {_MINUTE_PARTS_COMPAT}, {_MINUTE_COUNTS} FROM ends""",
        "previous_minute": f"""
WITH {_COUNTS}
SELECT c.minute_ts, c.ttl AS ttl_txn_min, c.app AS approved_txn_min,
       coalesce(p.ttl, 0) AS prev_ttl_txn_min, coalesce(p.app, 0) AS prev_approved_txn_min
FROM counts c LEFT JOIN counts p ON p.minute_ts = c.minute_ts - INTERVAL 1 MINUTE""",
        "previous_minute_stored": f"""
WITH {_COUNTS}{_chain('counts')}
SELECT c.minute_ts, c.ttl AS ttl_txn_min,
       CAST(coalesce(p.ttl_hr, 0) AS BIGINT) AS prev_ttl_txn_hr,
       CAST(coalesce(p.app_hr, 0) AS BIGINT) AS prev_approved_txn_hr
FROM counts c LEFT JOIN carried p ON p.minute_ts = c.minute_ts - INTERVAL 1 MINUTE""",
        "chained_totals": chained_sql,
        "chained_totals_wire": chained_sql,
        "minutes_written_twice": chained_sql,
        "filled_minutes": f"WITH {_SPINE} SELECT {_MINUTE_COLUMNS} FROM filled",
        "chained_totals_spine": f"WITH {_SPINE}{_chain('filled')} {_FULL_ROW}",
        "sliding_hour": f"WITH {_COUNTS}{_slide('counts')} {_FULL_ROW}",
        "sliding_hour_spine": f"WITH {_SPINE}{_slide('filled')} {_FULL_ROW}",
        "latest_per_key_compat": f"""
WITH {_COUNTS},
keyed AS (SELECT minute_ts, {_MINUTE_PARTS_COMPAT}, {_MINUTE_COUNTS} FROM counts)
SELECT max(minute_ts) AS minute_ts, year, month, day, hour, minute,
       arg_max(approved_rate_min, minute_ts) AS approved_rate_min,
       arg_max(ttl_txn_min, minute_ts) AS ttl_txn_min,
       arg_max(approved_txn_min, minute_ts) AS approved_txn_min
FROM keyed GROUP BY year, month, day, hour, minute""",
        "latest_per_transaction": """
SELECT CAST(event_id AS VARCHAR) AS txn_id, ts + INTERVAL 1 HOUR AS txn_time,
       event_type AS merchant, value * 2 AS amount
FROM events""",
        "retain_day": """
SELECT event_id, ts, event_type FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 86400 SECONDS""",
        "point_lookup": f"""
WITH {_COUNTS}
SELECT {_MINUTE_COLUMNS} FROM counts WHERE minute_ts = (SELECT max(minute_ts) FROM counts)""",
        "assign_weighted": _ASSIGN,
        "assign_weighted_pair": f"""{_SHARES},
low AS (SELECT * FROM shares WHERE cum <= 0.9)
SELECT c_custkey, u, coalesce(label, 'All Other') AS label, coalesce(region, '') AS region
FROM numbered ASOF LEFT JOIN low ON u <= cum""",
        "assign_weighted_sliced": _ASSIGN,
        "assign_by_counts": """
WITH numbered AS (
  SELECT c_custkey, CAST(c_custkey * 37 + 0.5 AS DOUBLE) AS u FROM customer
),
bounds AS (
  SELECT CAST(o_orderkey * 3 AS DOUBLE) AS cum, max(CAST(o_orderkey AS VARCHAR)) AS label
  FROM orders GROUP BY ALL
)
SELECT c_custkey, u, coalesce(label, 'All Other') AS label
FROM numbered ASOF LEFT JOIN bounds ON u <= cum""",
        "transactions_table": f"""
WITH {_TXN} SELECT {_TXN_COLUMNS}, strftime(txn_time, '%Y-%m-%d') AS txn_date FROM txn""",
        "rows_processed": "SELECT count(*) AS stored, count(*) AS processed FROM events",
        "added_column": f"""
WITH {_TXN}
SELECT txn_id, txn_time, NULL AS date_text FROM txn
UNION ALL
SELECT txn_id, txn_time, strftime(txn_time, '%Y%m%d') FROM txn""",
        "expire_days": f"""
WITH {_TXN}
SELECT strftime(txn_time, '%Y-%m-%d') AS txn_date, count(*) AS n_txn FROM txn GROUP BY 1
HAVING max(txn_time) > (SELECT max(ts) FROM events) - INTERVAL 86400 SECONDS""",
        "sql_view": f"""
WITH {_COUNTS},
transactions AS (SELECT * FROM txn),
txn_count_min AS (SELECT minute_ts, ttl AS ttl_txn_min FROM counts)
{SQL_TEXT}""",
        "sql_view_carried": f"""
WITH {_COUNTS}{_chain('counts')},
txn_count_min AS ({_FULL_ROW})
{CARRIED_TEXT}""",
        "stream_raw": transactions_sql,
        "stream_minute_rollup": f"WITH {_CLOSED} SELECT {_MINUTE_COLUMNS} FROM closed",
        "stream_chained": f"WITH {_CLOSED}{_chain('closed')} {_FULL_ROW}",
        "stream_sliding_hour": f"""
WITH {_CLOSED},
ends AS (
  SELECT unnest(generate_series(min(minute_ts), max(minute_ts) + INTERVAL 59 MINUTES,
                                INTERVAL 1 MINUTE)) AS minute_ts
  FROM counts
),
carried AS (
  SELECT e.minute_ts, sum(c.ttl) AS ttl_hr, sum(c.app) AS app_hr
  FROM ends e JOIN counts c
    ON c.minute_ts BETWEEN e.minute_ts - INTERVAL 59 MINUTES AND e.minute_ts
  WHERE e.minute_ts + INTERVAL 1 MINUTE
        <= (SELECT date_trunc('millisecond', max(ts)) FROM events) - INTERVAL 1 MINUTE
  GROUP BY e.minute_ts
)
SELECT minute_ts, {_MINUTE_PARTS}, {_HOUR_COUNTS} FROM carried""",
        "stream_by_arrival": f"""
WITH {_TXN}
SELECT count(*) AS ttl_txn, count(*) FILTER (WHERE status = 'APPROVED') AS approved_txn FROM txn""",
        "stream_quarantine": f"""
WITH {_TXN}, told AS (
  SELECT *, CASE CAST(txn_id AS BIGINT) % 7
                 WHEN 0 THEN 'too few fields' WHEN 1 THEN 'bad score'
                 WHEN 2 THEN 'bad amount' WHEN 3 THEN 'bad txn_time' END AS problem
  FROM txn
)
SELECT txn_id AS sent_id, CASE WHEN problem IS NULL THEN status END AS status, problem FROM told""",
        "stream_dedup": """
SELECT CAST(event_id AS VARCHAR) AS txn_id, ts AS txn_time, event_type AS merchant FROM events""",
        "chained_from_carry": chained_sql,
        "lookup_transaction": f"""
WITH {_TXN}, newest AS (SELECT * FROM txn ORDER BY txn_time DESC LIMIT 1)
SELECT 'id' AS found_by, txn_id, cc_no, txn_time, merchant, amount FROM newest
UNION ALL
SELECT 'card', t.txn_id, t.cc_no, t.txn_time, t.merchant, t.amount
FROM txn t JOIN newest n ON t.cc_no = n.cc_no""",
        "sql_table_function": chained_sql,
        "stream_screening": minutes_sql,
        "stream_settled": chained_sql,
        "stream_upsert": f"""
WITH {_TXN}, twice AS (SELECT event_id, CAST(value * 2 AS DECIMAL(18,2)) AS amount FROM events)
SELECT txn_id, txn_time, cc_no, merchant, CAST(twice.amount AS DOUBLE) AS amount, status
FROM txn JOIN twice ON txn_id = CAST(event_id AS VARCHAR)""",
        "expire_streamed": """
SELECT strftime(ts, '%Y-%m-%d') AS ingest_date, count(*) AS n_txn FROM events
WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 86400 SECONDS GROUP BY 1""",
        "stream_by_clock": f"""
WITH {_TXN},
arrived AS (SELECT count(*) AS ttl, count(*) FILTER (WHERE status = 'APPROVED') AS app FROM txn)
SELECT {_MINUTE_COUNTS} FROM arrived""",
        "stream_rows_processed": """
SELECT count(*) AS rows_in, count(*) AS rows_out, CAST(0 AS BIGINT) AS rows_late,
       count(*) AS rows_stored
FROM events""",
    } | _llm_sql()
