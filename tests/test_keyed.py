import datetime as dt

from pyspark.sql import functions as F

from cardtide.operators import latest_per_key, minute_rollup, point_lookup, retain


def test_latest_row_wins_for_the_twelve_hour_key(spark):
    day = dt.datetime(2024, 3, 1)
    rows = [(day + dt.timedelta(hours=1, minutes=5), "APPROVED")] * 7
    rows += [(day + dt.timedelta(hours=13, minutes=5), "APPROVED")] * 9
    minutes = minute_rollup(
        spark.createDataFrame(rows, "txn_time timestamp, status string"), calendar="compat"
    )
    key = ["year", "month", "day", "hour", "minute"]
    out = latest_per_key(minutes, key, ["minute_ts"])
    assert out.columns == minutes.columns
    (row,) = out.collect()
    assert (row.hour, row.ttl_txn_min) == (1, 9)


def test_same_time_is_settled_by_content(spark):
    rows = [("k", 1, "b", None), ("k", 1, "a", 5), ("k", 0, "z", 9)]
    df = spark.createDataFrame(rows, "k string, t int, v string, w int")
    for parts in (1, 3):
        assert latest_per_key(df.repartition(parts), ["k"], ["t"]).first() == ("k", 1, "b", None)


def test_null_key_is_a_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 1)], "k int, t int")
    got = latest_per_key(df, ["k"], ["t"]).collect()
    assert sorted(got, key=str) == sorted([(None, 2), (1, 1)], key=str)


def test_retention_edge(spark):
    now = dt.datetime(2024, 3, 2, 12)
    rows = [(age, now - dt.timedelta(seconds=age)) for age in (0, 86_399, 86_400, 90_000)]
    df = spark.createDataFrame(rows, "age long, ingest_ts timestamp")
    zoned = now.replace(tzinfo=dt.timezone.utc)
    for as_of in (now, zoned, F.lit("2024-03-02 12:00:00").cast("timestamp")):
        kept = retain(df, as_of=as_of).collect()
        assert sorted(r.age for r in kept) == [0, 86_399]
    assert retain(df).count() == 0


def test_retention_without_zone(spark):
    now = dt.datetime(2024, 3, 2, 12)
    df = spark.createDataFrame([(now,), (now - dt.timedelta(days=2),)], "t timestamp_ntz")
    assert retain(df, "t", as_of=now).count() == 1


def test_point_lookup(spark):
    rows = [(dt.datetime(2024, 3, 1, 13, m), "APPROVED") for m in range(5)]
    minutes = minute_rollup(spark.createDataFrame(rows, "txn_time timestamp, status string"))
    (row,) = point_lookup(minutes, 2024, 3, 1, 13, 4).collect()
    assert row.minute_ts == rows[4][0]
    assert point_lookup(minutes, 2024, 3, 1, 1, 4).count() == 0
