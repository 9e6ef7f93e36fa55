"""Transactions merged, looked up by key and expired by day of writing."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from cardtide.schemas import TRANSACTION
from cardtide.sources.expiry import expire_written, read_unexpired
from cardtide.sources.files import stream_parquet
from cardtide.sources.paths import names_in
from cardtide.sources.tables import (
    find_transactions,
    read_transactions,
    read_with,
    transaction_rows,
    write_transactions,
)
from cardtide.schemas import WRITTEN_TABLE
from cardtide.streaming import finish, merge_batch, start_merged, start_raw

ONCE = {"availableNow": True}
START = dt.datetime(2024, 3, 1)


def rows_of(spark, rows):
    """(id, hour, amount) as transactions."""
    df = spark.createDataFrame(
        [(i, None if h is None else START + dt.timedelta(hours=h), float(a)) for i, h, a in rows],
        "txn_id string, txn_time timestamp, amount double",
    )
    given = {f.name: F.lit(None).cast(f.dataType) for f in TRANSACTION if f.name not in df.columns}
    return df.withColumns(given).select(TRANSACTION.names)


def written(spark, rows, at):
    return transaction_rows(rows_of(spark, rows).withColumn("ingest_ts", F.lit(at)))


def kept(spark, path):
    return sorted(((r.txn_id, r.txn_date, r.amount) for r in read_transactions(spark, path).collect()), key=str)


def test_merge_against_a_dictionary(spark, tmp_path):
    """Batches of new and known keys over several days, each run twice."""
    rng, path, want = random.Random(3), str(tmp_path / "t"), {}
    for batch in range(5):
        rows = [(f"k{rng.randrange(40)}", rng.randrange(5) * 24 + rng.randrange(24), rng.randrange(1000))
                for _ in range(30)]
        rows += [(None, 3, batch), (f"z{batch}", None, 1)] + [("hot", 5, n) for n in range(100)]
        last = {}
        for i, h, a in rows:
            day = None if h is None else (START + dt.timedelta(hours=h)).date()
            last.setdefault((i, day), []).append(a)
        for key, amounts in last.items():
            want[key] = amounts
        at = START + dt.timedelta(days=30 + batch)
        for _ in range(2):
            merge_batch(written(spark, rows, at), path, batch)
        got = kept(spark, path)
        assert sorted(((i, d) for i, d, _ in got), key=str) == sorted(want, key=str)
        assert all(a in want[i, d] for i, d, a in got)


def test_a_batch_lost_half_way_goes_on(spark, tmp_path, monkeypatch):
    """The copy beside the table is written, the table is not: the batch that runs again ends it."""
    from cardtide.streaming import merge

    path = str(tmp_path / "t")
    merge_batch(written(spark, [("a", 1, 1), ("b", 2, 1)], START + dt.timedelta(days=40)), path, 0)
    whole, writes = merge._write, []

    def lost(rows, target, keys, mode):
        if target == path and mode == "overwrite":
            writes.append(target)
            raise RuntimeError("driver lost")
        whole(rows, target, keys, mode)

    later = [("a", 1, 2), ("c", 3, 2)]
    monkeypatch.setattr(merge, "_write", lost)
    with pytest.raises(RuntimeError):
        merge_batch(written(spark, later, START + dt.timedelta(days=41)), path, 1)
    monkeypatch.undo()
    assert writes
    for _ in range(2):
        merge_batch(written(spark, later, START + dt.timedelta(days=41)), path, 1)
        assert [(i, a) for i, _, a in kept(spark, path)] == [("a", 2), ("b", 1), ("c", 2)]


def test_days_without_known_keys_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    merge_batch(written(spark, [("a", 1, 1), ("b", 25, 1)], START), path, 0)
    files = set(names_in(spark, f"{path}/txn_date=2024-03-01"))
    merge_batch(written(spark, [("c", 2, 1), ("b", 26, 5)], START + dt.timedelta(days=1)), path, 1)
    assert files < set(names_in(spark, f"{path}/txn_date=2024-03-01"))
    assert [(i, a) for i, _, a in kept(spark, path)] == [("a", 1), ("b", 5), ("c", 1)]


def test_merged_stream_goes_on_after_a_restart(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "t", "c"))
    for part in ([("a", 1, 1), ("b", 25, 1)], [("a", 1, 7), ("c", 49, 1)], None):
        if part:
            rows_of(spark, part).write.mode("append").parquet(source)
        stream = stream_parquet(spark, source, TRANSACTION)
        finish(start_merged(stream, path, checkpoint, name="merged", trigger=ONCE))
    assert [(i, a) for i, _, a in kept(spark, path)] == [("a", 7), ("b", 1), ("c", 1)]


def scanned_rows(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if plan.getClass().getSimpleName().startswith("Adaptive") else plan
    leaves, n = plan.collectLeaves(), 0
    for i in range(leaves.size()):
        n += leaves.apply(i).metrics().get("numOutputRows").get().value()
    return n


def test_lookup_by_key_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    txns = rows_of(spark, [(f"t{i:06d}", i % 48, i) for i in range(40_000)]).withColumn(
        "cc_no", F.concat(F.lit("card"), F.col("amount").cast("int") % 5000)
    )
    size = "parquet.block.size"
    spark.sparkContext._jsc.hadoopConfiguration().set(size, str(64 << 10))
    try:
        write_transactions(txns, path, keys=["txn_id", "cc_no"])
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset(size)
    one = find_transactions(spark, path, day=dt.date(2024, 3, 2), txn_id="t020000")
    assert [r.amount for r in one.collect()] == [20000.0]
    assert scanned_rows(find_transactions(spark, path, txn_id="t020000")) < 12_000
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(txn_id,t020000)" in plan and "PartitionFilters: [isnotnull(txn_date" in plan
    card = find_transactions(spark, path, cc_no="card77", day=(dt.date(2024, 3, 1), dt.date(2024, 3, 9)))
    assert sorted(r.amount for r in card.collect()) == [77.0 + 5000 * i for i in range(8)]
    assert find_transactions(spark, path, merchant=None).count() == 40_000
    assert find_transactions(spark, path, txn_id="none").count() == 0


def expiring(spark, tmp_path, rows, retention=None):
    """Store rows of a day of writing through a stream."""
    source, path = str(tmp_path / "in"), str(tmp_path / "t")
    hours = {i: h for i, h, _ in rows}
    txns = rows_of(spark, rows).withColumn("ingest_ts", F.col("txn_time"))
    txns.write.mode("append").parquet(source)
    assert hours
    stream = stream_parquet(spark, source, txns.schema)
    query = start_raw(stream, path, str(tmp_path / "c"), trigger=ONCE, retention=retention, day="ingest_date")
    finish(query)
    return path


def test_expired_days_of_writing_are_deleted(spark, tmp_path):
    path = expiring(spark, tmp_path, [(f"t{h}", h, h) for h in range(0, 96, 5)])
    as_of = START + dt.timedelta(hours=80)
    want = sorted(f"t{h}" for h in range(0, 96, 5) if h > 80 - 24)
    assert expire_written(spark, path, as_of=as_of).listed == [dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    gone = expire_written(spark, path, as_of=as_of, listed="delete")
    assert gone.deleted == [dt.date(2024, 3, 1), dt.date(2024, 3, 2)]
    left = read_unexpired(spark, path, as_of=as_of)
    assert sorted(r.txn_id for r in left.collect()) == want
    plan = left._jdf.queryExecution().executedPlan().toString()
    assert "(ingest_date#" in plan and ">= 2024-03-03)" in plan
    assert [n for n in names_in(spark, path) if n.startswith("ingest")] == [
        "ingest_date=2024-03-03", "ingest_date=2024-03-04",
    ]
    assert expire_written(spark, path, as_of=as_of, listed="delete").deleted == []
    with pytest.raises(ValueError):
        expire_written(spark, path, listed="some")


def test_days_are_deleted_in_step_with_the_sinks_list(spark, tmp_path):
    """The sink forgets old files when it compacts its list; only then does the day go, and a
    reader without any bound never meets a missing file."""
    spark.conf.set("spark.sql.streaming.fileSink.log.compactInterval", "1")
    try:
        path = expiring(spark, tmp_path, [("old", 1, 1)])
        as_of = START + dt.timedelta(hours=80)
        assert expire_written(spark, path, as_of=as_of).deleted == []
        time.sleep(11)
        expiring(spark, tmp_path, [("new", 79, 1)], retention="10s")
    finally:
        spark.conf.unset("spark.sql.streaming.fileSink.log.compactInterval")
    assert expire_written(spark, path, as_of=as_of).deleted == [dt.date(2024, 3, 1)]
    assert [r.txn_id for r in read_with(spark, path, WRITTEN_TABLE).collect()] == ["new"]
    assert [r.txn_id for r in read_unexpired(spark, path, as_of=as_of).collect()] == ["new"]
