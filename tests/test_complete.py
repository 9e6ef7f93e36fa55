"""Complete minutes from both tables, and carried totals kept per day."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardtide.operators import chained_totals, minute_rollup
from cardtide.schemas import APPROVED, REJECTED, TRANSACTION
from cardtide.sources.carried import read_carry, read_chained, write_carry
from cardtide.sources.complete import (
    complete_minutes,
    recounted,
    settle_minutes,
    settled_minutes,
    unsettled_days,
)
from cardtide.sources.files import stream_parquet
from cardtide.sources.tables import (
    create_minute_view,
    create_tables,
    minute_rows,
    read_minutes,
    read_transactions,
    write_minutes,
    write_transactions,
)
from cardtide.streaming import finish, start_screening, state_session

START = dt.datetime(2024, 3, 1, 23, 50)


def transactions(spark, minutes, prefix="t"):
    """One transaction at each of these minutes after the start."""
    rows = [
        (f"{prefix}{i}", START + dt.timedelta(minutes=m), REJECTED if m % 7 == 0 else APPROVED)
        for i, m in enumerate(minutes)
    ]
    df = spark.createDataFrame(rows, "txn_id string, txn_time timestamp, status string")
    given = {f.name: F.lit(None).cast(f.dataType) for f in TRANSACTION if f.name not in df.columns}
    return df.withColumns(given).select(TRANSACTION.names)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_late_rows_and_the_open_tail_are_counted(spark, tmp_path):
    """Parts arrive one by one: one in time order, one far behind it, and one between days."""
    rng = random.Random(1)
    parts = [
        sorted(rng.randrange(0, 400) for _ in range(300)),
        [rng.randrange(0, 300) for _ in range(80)] + [5000],
        [rng.randrange(0, 5000) for _ in range(90)] + [9000, 9000],
    ]
    folder, seen = str(tmp_path / "out"), []
    tables = f"{folder}/minutes", f"{folder}/transactions", f"{folder}/settled"
    for n, part in enumerate(parts):
        txns = transactions(spark, part, prefix=f"p{n}-")
        txns.write.mode("append").parquet(str(tmp_path / "in"))
        stream = stream_parquet(state_session(spark, 2), str(tmp_path / "in"), txns.schema)
        for query in start_screening(stream, folder, trigger={"availableNow": True}):
            finish(query)
        seen += part
        want = minute_rollup(transactions(spark, seen)).withColumn("minute_date", F.to_date("minute_ts"))
        got = complete_minutes(spark, *tables[:2])
        assert sorted(got.select(want.columns).collect()) == sorted(want.collect())
        assert read_minutes(spark, tables[0]).count() < want.count()
        # What is stored once is not counted again.
        days = settle_minutes(spark, *tables)
        assert days
        assert sorted(settled_minutes(spark, tables[0], tables[2]).select(want.columns).collect()) == sorted(
            want.collect()
        )
        assert settle_minutes(spark, *tables) == []
        assert plan_of(complete_minutes(spark, *tables)).count("txn_date") == 0


def test_only_days_with_more_rows_are_counted_again(spark, tmp_path):
    minutes_path, path = str(tmp_path / "minutes"), str(tmp_path / "transactions")
    txns = transactions(spark, [0, 1, 1, 20, 1500, 1501, 3000])
    write_transactions(txns, path)
    write_minutes(minute_rollup(txns.filter(F.col("txn_id") != "t5")), minutes_path)
    day = dt.date(2024, 3, 3)
    minutes, stored = read_minutes(spark, minutes_path), read_transactions(spark, path)
    assert unsettled_days(minutes, stored) == [day]
    plan = plan_of(recounted(minutes, stored, [day]))
    assert "PartitionFilters: [isnotnull(txn_date" in plan
    assert "ReadSchema: struct<txn_time:timestamp,status:string>" in plan
    assert settle_minutes(spark, minutes_path, path, str(tmp_path / "settled"), before=day) == []
    got = complete_minutes(spark, minutes_path, path)
    assert {r.minute_ts: r.ttl_txn_min for r in got.collect()} == {
        r.minute_ts: r.ttl_txn_min for r in minute_rollup(txns).collect()
    }


def test_a_transaction_table_behind_its_minutes_loses_nothing(spark, tmp_path):
    minutes_path, path = str(tmp_path / "minutes"), str(tmp_path / "transactions")
    write_minutes(minute_rollup(transactions(spark, [0, 1, 1, 5])), minutes_path)
    write_transactions(transactions(spark, [0, 1, 6, 7, 8, 9]), path)
    got = complete_minutes(spark, minutes_path, path)
    counts = {(r.minute_ts - START).seconds // 60: r.ttl_txn_min for r in got.collect()}
    assert counts == {0: 1, 1: 2, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1}
    # Rows without a time are of no minute, and no table is no day.
    nulls = transactions(spark, [1]).withColumn("txn_time", F.lit(None).cast("timestamp"))
    write_transactions(nulls, path)
    assert complete_minutes(spark, minutes_path, path).count() == 7


def random_minutes(rng):
    """Minutes over eleven days: whole days, quiet days, breaks at and across midnight."""
    minutes = []
    for day in range(11):
        first = day * 1440 + 10  # the start is ten minutes ahead of midnight
        kind = rng.randrange(4)
        if kind == 0:
            minutes += range(first, first + 1440)
        elif kind == 1:
            minutes += [*range(first, first + 30), *range(first + 1400, first + 1440)]
        elif kind == 2:
            minutes += [first + rng.randrange(1440) for _ in range(20)]
    return minutes or [3]


@pytest.mark.parametrize("seed, zone", enumerate(["UTC", "Asia/Tokyo", "America/Lima"]))
def test_chained_from_stored_days(spark, tmp_path, seed, zone):
    rng = random.Random(seed)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        path, carry = str(tmp_path / "minutes"), str(tmp_path / "carry")
        write_minutes(minute_rollup(transactions(spark, random_minutes(rng))), path)
        minutes = read_minutes(spark, path)
        whole = chained_totals(minutes).cache()
        days = [r.minute_date for r in minutes.select("minute_date").distinct().orderBy("minute_date").collect()]
        for before in sorted(rng.sample(days, min(2, len(days)))):
            write_carry(minutes, carry, before)
            assert write_carry(minutes, carry, before) == 0
        for first in [days[0] - dt.timedelta(days=3), *rng.sample(days, min(2, len(days)))]:
            last = max(first, rng.choice(days))
            got = read_chained(minutes, carry, first, last)
            want = whole.filter(F.col("minute_date").between(F.lit(first), F.lit(last)))
            assert sorted(got.collect()) == sorted(want.collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_earlier_days_are_not_read(spark, tmp_path):
    path, carry = str(tmp_path / "minutes"), str(tmp_path / "carry")
    write_minutes(minute_rollup(transactions(spark, range(0, 5 * 1440, 3))), path)
    minutes = read_minutes(spark, path)
    assert write_carry(minutes, carry, dt.date(2024, 3, 5)) == 4
    chained = read_chained(minutes, carry, dt.date(2024, 3, 5), dt.date(2024, 3, 5))
    assert chained.count() == 480
    assert "(minute_date#" in plan_of(chained) and "> 2024-03-04)" in plan_of(chained)


def test_changed_days_are_chained_anew(spark, tmp_path):
    """A late row closes the gap of one day; the days behind it get other totals."""
    path, carry = str(tmp_path / "minutes"), str(tmp_path / "carry")
    every = list(range(0, 4 * 1440))
    write_minutes(minute_rollup(transactions(spark, [m for m in every if m != 1500])), path)
    write_carry(read_minutes(spark, path), carry, dt.date(2024, 3, 5))
    before = {r._day: r._total_out for r in read_carry(spark, carry).collect()}
    write_minutes(minute_rollup(transactions(spark, [1500])), path)
    minutes = read_minutes(spark, path)
    write_carry(minutes, carry, dt.date(2024, 3, 5), changed=[dt.date(2024, 3, 3)])
    after = {r._day: r._total_out for r in read_carry(spark, carry).collect()}
    assert [after[d] - before[d] for d in sorted(before)] == [0, 0, 1501, 1501]
    got = read_chained(minutes, carry, dt.date(2024, 3, 4))
    want = chained_totals(minutes).filter(F.col("minute_date") >= F.lit(dt.date(2024, 3, 4)))
    assert sorted(got.collect()) == sorted(want.collect())


def test_carry_of_nothing(spark, tmp_path):
    path, carry = str(tmp_path / "minutes"), str(tmp_path / "carry")
    write_minutes(minute_rollup(transactions(spark, [5])).limit(0), path)
    minutes = read_minutes(spark, path)
    assert write_carry(minutes, carry, dt.date(2024, 3, 5)) == 0
    assert read_chained(minutes, carry, dt.date(2024, 3, 1)).count() == 0


def test_carried_minutes_in_sql_for_another_session(spark, tmp_path):
    rng = random.Random(5)
    create_tables(spark, str(tmp_path / "t"), str(tmp_path / "m"), "txns_sql", "minutes_sql")
    try:
        minutes = minute_rollup(transactions(spark, random_minutes(rng) + list(range(700, 3000))))
        worse = minutes.withColumn("ttl_txn_min", F.col("ttl_txn_min") + 3)
        minute_rows(worse).write.insertInto("minutes_sql")
        minute_rows(minutes).write.insertInto("minutes_sql")
        create_minute_view(spark, "minutes_sql", "minutes_carried")
        other = spark.newSession()
        other.conf.set("spark.sql.session.timeZone", "UTC")
        want = sorted(chained_totals(minutes).collect())
        assert sorted(other.table("minutes_carried").collect()) == want
        some = other.sql("SELECT * FROM minutes_carried_between(DATE '2024-03-03', DATE '2024-03-04')")
        days = (dt.date(2024, 3, 3), dt.date(2024, 3, 4))
        assert sorted(some.collect()) == [r for r in want if r.minute_ts.date() in days]
    finally:
        for kind, name in (("VIEW", "minutes_carried"), ("TABLE", "txns_sql"), ("TABLE", "minutes_sql")):
            spark.sql(f"DROP {kind} IF EXISTS {name}")
        spark.sql("DROP FUNCTION IF EXISTS minutes_carried_between")
