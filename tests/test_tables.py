import datetime as dt

import pytest
from pyspark.sql import functions as F

from cardtide.operators import chained_totals, minute_rollup, point_lookup
from cardtide.plans.screening import screen
from cardtide.schemas import MINUTE, MINUTE_TABLE, TRANSACTION, TRANSACTION_TABLE
from cardtide.sources import kafka
from cardtide.sources.tables import (
    add_column,
    create_tables,
    drop_days,
    expired_days,
    read_merged,
    read_minutes,
    read_retained,
    read_transactions,
    read_with,
    register_views,
    transaction_rows,
    write_counted,
    write_minutes,
    write_transactions,
)

DAY = dt.datetime(2024, 3, 1)


@pytest.fixture(scope="module")
def txns(spark):
    times = [DAY + dt.timedelta(hours=h) for h in range(0, 96, 2)]
    rows = [(f"1;1;{t};{i};m;CA;US;;1.00;{i}",) for i, t in enumerate(times)]
    return screen(spark.createDataFrame(rows, "value string"))


@pytest.mark.parametrize("rebalance", [False, True])
def test_transactions_round_trip(spark, tmp_path, txns, rebalance):
    path = str(tmp_path / "t")
    write_transactions(txns, path, rebalance=rebalance)
    stored = read_transactions(spark, path)
    assert stored.schema == TRANSACTION_TABLE
    assert sorted(stored.select(*TRANSACTION.names).collect()) == sorted(txns.collect())
    assert stored.select("txn_date").distinct().count() == 4


def test_second_write_appends(spark, tmp_path, txns):
    path = str(tmp_path / "t")
    assert write_counted(txns, path) == 48
    assert write_counted(txns.limit(3), path) == 3
    assert read_transactions(spark, path).count() == 51


def test_minutes_round_trip_and_pruned_lookup(spark, tmp_path, txns):
    path = str(tmp_path / "m")
    write_minutes(minute_rollup(txns), path)
    stored = read_minutes(spark, path)
    assert stored.columns == [*MINUTE.names, "minute_date"]
    assert chained_totals(stored).count() == 48
    found = point_lookup(stored, 2024, 3, 2, 4, 0)
    assert found.first().minute_ts == dt.datetime(2024, 3, 2, 4)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(minute_date" in plan
    assert "PushedFilters: [IsNotNull(year)" in plan


def test_minute_written_again_replaces_its_row(spark, tmp_path, txns):
    path = str(tmp_path / "m")
    minutes = minute_rollup(txns)
    late, early = (F.lit(t).cast("timestamp") for t in ("2024-06-02", "2024-06-01"))
    write_minutes(minutes.withColumn("ingest_ts", late), path)
    wrong = minutes.withColumn("ttl_txn_min", F.lit(99).cast("long"))
    write_minutes(wrong.withColumn("ingest_ts", early), path)
    write_minutes(wrong.withColumn("ingest_ts", F.lit(None).cast("timestamp")), path)
    stored = read_minutes(spark, path).drop("minute_date")
    assert sorted(stored.collect()) == sorted(minutes.collect())


def test_compat_lookup_names_the_right_day(spark, tmp_path, txns):
    path = str(tmp_path / "m")
    write_minutes(minute_rollup(txns, calendar="compat"), path)
    found = point_lookup(read_minutes(spark, path), 2024, 2, 2, 4, 0, calendar="compat")
    assert sorted(r.minute_ts.hour for r in found.collect()) == [4, 16]


def test_column_added_later_is_null_before(spark, tmp_path, txns):
    path = str(tmp_path / "t")
    txns.select("txn_id").write.parquet(path)
    txns.select("txn_id", "date_text").write.mode("append").parquet(path)
    schema = txns.select("txn_id", "date_text").schema
    for df in (read_with(spark, path, schema), read_merged(spark, path)):
        assert df.count() == 96
        assert df.filter("date_text IS NULL").count() == 48


def test_catalog_tables(spark, tmp_path, txns):
    create_tables(spark, str(tmp_path / "t"), str(tmp_path / "m"), "cat_t", "cat_m")
    try:
        assert spark.table("cat_t").count() == 0
        assert [f.name for f in spark.table("cat_m").schema] == MINUTE_TABLE.names
        transaction_rows(txns).write.insertInto("cat_t")
        assert spark.table("cat_t").count() == 48
        write_transactions(txns.limit(2), str(tmp_path / "t"))
        spark.catalog.recoverPartitions("cat_t")
        assert spark.table("cat_t").count() == 50
        add_column(spark, "cat_t", "channel", "string")
        assert spark.table("cat_t").filter("channel IS NULL").count() == 50
        create_tables(spark, str(tmp_path / "t"), str(tmp_path / "m"), "cat_t2", "cat_m2")
        assert spark.table("cat_t2").count() == 50
    finally:
        for name in ("cat_t", "cat_m", "cat_t2", "cat_m2"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_views(spark, tmp_path, txns):
    write_transactions(txns, str(tmp_path / "t"))
    write_minutes(minute_rollup(txns), str(tmp_path / "m"))
    register_views(spark, str(tmp_path / "t"), str(tmp_path / "m"))
    assert spark.sql("SELECT count(*) n FROM transactions WHERE status = 'REJECTED'").first().n == 5
    assert spark.sql("SELECT sum(ttl_txn_min) n FROM txn_count_min").first().n == 48


def test_expiry(spark, tmp_path, txns):
    path = str(tmp_path / "t")
    written = txns.withColumn("ingest_ts", F.col("txn_time"))
    write_transactions(written, path)
    late = written.filter("txn_id = '0'").withColumn("ingest_ts", F.lit(DAY + dt.timedelta(days=9)))
    now = DAY + dt.timedelta(days=3, hours=1)
    assert read_retained(spark, path, as_of=now).count() == 23  # hours 50 to 94
    assert expired_days(spark, path, as_of=now) == [DAY.date(), dt.date(2024, 3, 2)]
    write_transactions(late, path)  # a late row for the first day keeps that day
    gone = expired_days(spark, path, as_of=now)
    assert gone == [dt.date(2024, 3, 2)]
    drop_days(spark, path, gone)
    left = read_transactions(spark, path)
    assert [r.txn_date for r in left.select("txn_date").distinct().orderBy("txn_date").collect()] == [
        dt.date(2024, 3, 1),
        dt.date(2024, 3, 3),
        dt.date(2024, 3, 4),
    ]


def test_topic_options():
    assert kafka.source_options("h:9092", "new") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "new",
        "startingOffsets": "latest",
    }
    more = kafka.source_options("h:9092", "new", "earliest", 1000, 64)
    assert more["maxOffsetsPerTrigger"] == "1000" and more["minPartitions"] == "64"
    assert kafka.sink_options("h:9092", "new") == {
        "kafka.bootstrap.servers": "h:9092",
        "topic": "new",
    }


def test_topic_message_text(spark):
    raw = spark.createDataFrame([(b"k", b"a;b")], "key binary, value binary")
    assert kafka.message_text(raw).first().asDict() == {"value": "a;b"}


def test_rows_of_unknown_age_are_not_expired(spark, tmp_path):
    rows = spark.sql(
        "SELECT timestamp'2024-01-01 10:00:00' AS ingest_ts, date'2024-01-01' AS txn_date "
        "UNION ALL SELECT CAST(NULL AS timestamp), date'2024-01-02' "
        "UNION ALL SELECT timestamp'2024-01-01 10:00:00', date'2024-01-02'"
    )
    rows.write.partitionBy("txn_date").parquet(f"{tmp_path}/t")
    gone = expired_days(spark, f"{tmp_path}/t", as_of=dt.datetime(2024, 1, 2, 10))
    assert gone == [dt.date(2024, 1, 1)]
    assert expired_days(spark, f"{tmp_path}/t", as_of=dt.datetime(2024, 1, 2, 9, 59, 59)) == []
