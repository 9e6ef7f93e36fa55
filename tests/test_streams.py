import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardtide.functions import classify, encode_wire
from cardtide.operators import chained_totals, minute_rollup, sliding_hour
from cardtide.plans.events import wire_rows
from cardtide.plans.screening import screen, unreadable
from cardtide.schemas import TRANSACTION
from cardtide.sources.files import stream_parquet, stream_text
from cardtide.sources.tables import drop_days, read_minutes, read_transactions, read_with
from cardtide.streaming import (
    BatchLog,
    finish,
    heartbeat,
    minutes_by_arrival,
    minutes_of,
    sliding_hour_of,
    start_console,
    start_minutes,
    start_raw,
    start_screening,
    state_session,
    unique_transactions,
)

EVENTS = "/root/testdata/sf0.001/events*.parquet"  # a stream takes a folder or a glob, not a file
ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def messages(spark, tmp_path_factory):
    """Event messages as text files in time order, in three parts."""
    rows = encode_wire(wire_rows(spark.read.parquet(EVENTS)), keep=["txn_time"]).cache()
    folder = tmp_path_factory.mktemp("messages")
    texts = [r.value for r in rows.orderBy("txn_time").collect()]
    cuts = [0, 300, 650, len(texts)]
    return [
        (folder, f"{i}.txt", "\n".join(texts[a:b]) + "\n")
        for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
    ]


def deliver(part, folder):
    folder.mkdir(exist_ok=True)
    (folder / part[1]).write_text(part[2])


def events_batch(spark):
    return classify(wire_rows(spark.read.parquet(EVENTS)))


def closed(df, spark, delay_minutes=1):
    last = spark.read.parquet(EVENTS).agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    limit = last - dt.timedelta(minutes=delay_minutes + 1)
    return df.filter(F.col("minute_ts") <= F.lit(limit))


def test_raw_stream_equals_batch(spark, tmp_path, messages):
    for part in messages:
        deliver(part, tmp_path / "in")
    txns = screen(stream_text(spark, str(tmp_path / "in")))
    query = start_raw(txns, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=ONCE)
    finish(query)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1000
    got = read_transactions(spark, str(tmp_path / "out")).select(*TRANSACTION.names)
    want = screen(encode_wire(wire_rows(spark.read.parquet(EVENTS))))
    assert sorted(got.collect()) == sorted(want.collect())


def test_both_outputs_go_on_after_a_restart(spark, tmp_path, messages):
    """Each part arrives between runs; the last run has nothing new."""
    session = state_session(spark, 2)
    for part in [*messages, None]:
        if part:
            deliver(part, tmp_path / "in")
        txns = screen(stream_text(session, str(tmp_path / "in")))
        for query in start_screening(txns, str(tmp_path / "out"), trigger=ONCE):
            finish(query)
    raw = read_transactions(spark, str(tmp_path / "out" / "transactions"))
    assert raw.count() == raw.select("txn_id").distinct().count() == 1000
    minutes = read_minutes(spark, str(tmp_path / "out" / "minutes")).drop("minute_date")
    want = closed(minute_rollup(events_batch(spark)), spark)
    assert sorted(minutes.collect()) == sorted(want.collect())
    assert sorted(chained_totals(minutes).collect()) == sorted(chained_totals(want).collect())
    with pytest.raises(ValueError, match="retention"):
        drop_days(spark, str(tmp_path / "out" / "transactions"), [])


def test_bad_messages_stop_nothing(spark, tmp_path, messages):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    texts = [m[2] for m in messages]
    texts[1] = "no message at all\n" + texts[1]
    for i, text in enumerate(texts):
        (source / f"{i}.txt").write_text(text)
        sent = stream_text(state_session(spark, 2), str(source))
        txns = screen(sent, on_error="quarantine")
        for query in start_screening(txns, str(out), trigger=ONCE, bad=unreadable(sent)):
            finish(query)
    n = sum(text.count("\n") for text in texts) - 1
    assert read_transactions(spark, str(out / "transactions")).count() == n
    (bad,) = spark.read.parquet(str(out / "bad_messages")).collect()
    assert (bad.value, bad.problem) == ("no message at all", "too few fields")


def test_sliding_hour_stream_equals_batch(spark, tmp_path):
    session = state_session(spark, 2)
    stream = stream_parquet(session, EVENTS, spark.read.parquet(EVENTS).schema)
    hours = sliding_hour_of(classify(wire_rows(stream)))
    finish(
        hours.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(**ONCE)
        .start()
    )
    names = ["minute_ts", "approved_rate_hr", "ttl_txn_hr", "approved_txn_hr"]
    got = read_with(spark, str(tmp_path / "out"), hours.schema).select(*names)
    batch = closed(sliding_hour(minute_rollup(events_batch(spark))), spark).select(*names)
    # The stream also reports minutes without transactions of their own.
    busy = got.join(batch.select("minute_ts"), "minute_ts", "left_semi").select(*names)
    assert sorted(busy.collect()) == sorted(batch.collect())
    assert got.count() == got.select("minute_ts").distinct().count() > batch.count()


@pytest.mark.parametrize("spread", [True, False])
def test_repeats_are_dropped(spark, tmp_path, spread):
    """A third of all rows are copies of one transaction."""
    start = dt.datetime(2024, 3, 1)
    rows = [(f"t{i}", start + dt.timedelta(seconds=i)) for i in range(400)]
    rows = rows * 2 + [rows[5]] * 400
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "txn_id string, txn_time timestamp, offset long")
    df.write.parquet(str(tmp_path / "in"))
    stream = stream_parquet(state_session(spark, 2), str(tmp_path / "in"), df.schema)
    unique = unique_transactions(stream, spread=F.col("offset") if spread else None, ways=4)
    assert unique.columns == df.columns
    finish(
        unique.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(**ONCE)
        .start()
    )
    got = [r.txn_id for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(got) == sorted(f"t{i}" for i in range(400))


def test_minutes_by_arrival(spark, tmp_path):
    """Rows are counted under the clock of their batch; a later batch closes it."""
    session = state_session(spark, 2)
    schema = spark.read.parquet(EVENTS).schema

    def run():
        txns = classify(wire_rows(stream_parquet(session, str(tmp_path / "in"), schema)))
        query = (
            minutes_by_arrival(txns)
            .writeStream.format("memory")
            .queryName("arrivals")
            .outputMode("complete")
            .trigger(**ONCE)
            .start()
        )
        finish(query)
        return session.sql("SELECT * FROM arrivals").collect()

    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, second=0, microsecond=0)
    spark.read.parquet(EVENTS).write.parquet(str(tmp_path / "in"))
    rows = run()
    after = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    assert sum(r.ttl_txn_min for r in rows) == 1000
    assert sum(r.approved_txn_min for r in rows) == 944
    assert all(before <= r.minute_ts <= after for r in rows)


def test_console_and_named_queries_start(spark, tmp_path):
    session = state_session(spark, 2)
    schema = spark.read.parquet(EVENTS).schema
    minutes = minutes_of(classify(wire_rows(stream_parquet(session, EVENTS, schema))))
    finish(start_console(minutes, trigger=ONCE))
    query = start_minutes(
        minutes, str(tmp_path / "out"), str(tmp_path / "cp"), name="minutes", trigger=ONCE
    )
    assert query.name == "minutes"
    finish(query)


def test_default_triggers_run_on_the_clock(spark, tmp_path, messages):
    deliver(messages[0], tmp_path / "in")
    txns = screen(stream_text(spark, str(tmp_path / "in")))
    query = start_raw(txns, str(tmp_path / "out"), str(tmp_path / "cp"), retention="86400s")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert read_transactions(spark, str(tmp_path / "out")).count() == 300


def test_finish_reports_a_failed_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "bad.txt").write_text("not;enough;fields\n")
    txns = screen(stream_text(spark, str(tmp_path / "in")))
    with pytest.raises(Exception, match="bad "):
        finish(start_raw(txns, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=ONCE))


def test_state_session_keeps_settings(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    kept = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    before = spark.conf.get(name)
    spark.conf.set(name, kept)
    try:
        assert state_session(spark, 3).conf.get(name) == kept
    finally:
        spark.conf.set(name, before)


def beats_at(spark, folder, *times):
    """A clock of one's own: these times, one file each."""
    for time in times:
        df = spark.createDataFrame([(time,)], "timestamp timestamp")
        df.write.mode("append").parquet(str(folder))
    return state_session(spark, 2).readStream.schema("timestamp timestamp").parquet(str(folder))


def test_a_beat_closes_the_last_minute(spark, tmp_path):
    """No transaction comes after; quiet minutes in which the clock beat are rows with 0."""
    last = spark.read.parquet(EVENTS).agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    beats = beats_at(spark, tmp_path / "beats", *[last + dt.timedelta(minutes=m) for m in (2, 3, 9)])
    schema = spark.read.parquet(EVENTS).schema
    session = state_session(spark, 2)
    txns = classify(wire_rows(stream_parquet(session, EVENTS, schema)))
    minutes = minutes_of(txns, beats=beats)
    finish(start_minutes(minutes, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=ONCE))
    got = read_minutes(spark, str(tmp_path / "out")).drop("minute_date")
    quiet = got.filter("ttl_txn_min = 0").orderBy("minute_ts").collect()
    assert [(r.minute_ts - last.replace(second=0, microsecond=0)).seconds // 60 for r in quiet] == [2, 3]
    assert {(r.approved_txn_min, r.approved_rate_min) for r in quiet} == {(0, 0.0)}
    want = minute_rollup(events_batch(spark))
    assert sorted(got.filter("ttl_txn_min > 0").collect()) == sorted(want.collect())


def test_the_clock_beats(spark):
    """The rate source's times reach the minutes."""
    query = heartbeat(spark, 5).writeStream.format("memory").queryName("beats").start()
    try:
        query.awaitTermination(4)
    finally:
        query.stop()
    times = [r.timestamp for r in spark.table("beats").collect()]
    assert times and len(set(times)) == len(times)


def test_rows_of_each_batch(spark, tmp_path):
    """Three files, one a batch; the second repeats the first, the third comes too late."""
    session = state_session(spark, 2)
    log = BatchLog(session, str(tmp_path / "log"), every=2)
    start = dt.datetime(2024, 3, 1)
    for n, (first, day) in enumerate([(0, 5), (0, 5), (50, 1)]):
        rows = [(f"t{first + i}", start + dt.timedelta(days=day, seconds=i)) for i in range(20)]
        df = spark.createDataFrame(rows, "txn_id string, txn_time timestamp")
        df.write.mode("append").parquet(str(tmp_path / "in"))
        stream = stream_parquet(session, str(tmp_path / "in"), df.schema)
        given = {f.name: F.lit(None).cast(f.dataType) for f in TRANSACTION if f.name not in df.columns}
        unique = unique_transactions(stream).withColumns(given)
        query = start_raw(unique, str(tmp_path / "out"), str(tmp_path / "cp"), name="unique", trigger=ONCE)
        finish(query)
        log.wait(query)
        assert n < 2 or log.batches().count() >= 3
    log.close()
    got = sorted((r.rows_in, r.rows_out, r.rows_late) for r in log.batches().filter("rows_in > 0").collect())
    assert got == [(20, 0, 0), (20, 0, 20), (20, 20, 0)]
    assert {r.query for r in log.batches().collect()} == {"unique"}
    # Without a path the newest are kept in memory.
    memory = BatchLog(session, keep=1)
    for n in range(2):
        query = start_raw(
            stream.withColumns(given), str(tmp_path / f"o{n}"), str(tmp_path / f"c{n}"), trigger=ONCE
        )
        finish(query)
        memory.wait(query)
    memory.close()
    (row,) = memory.batches().collect()
    assert (row.rows_in, row.rows_out, row.rows_late) == (60, 60, 0) and row.query == str(query.id)
    with pytest.raises(ValueError, match="path"):
        memory.save()


def test_an_unknown_time_raises_in_a_stream_as_in_a_batch(spark, tmp_path):
    rows = events_batch(spark).select("status", "txn_time").limit(20)
    nulls = rows.withColumn("txn_time", F.when(F.col("txn_time").isNotNull(), None).cast("timestamp"))
    rows.unionByName(nulls).write.parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match="null txn_time"):
        minute_rollup(spark.read.parquet(str(tmp_path / "in"))).collect()
    stream = stream_parquet(state_session(spark, 2), str(tmp_path / "in"), rows.schema)
    query = start_minutes(minutes_of(stream), str(tmp_path / "out"), str(tmp_path / "cp"), trigger=ONCE)
    with pytest.raises(Exception, match="null txn_time"):
        finish(query)
