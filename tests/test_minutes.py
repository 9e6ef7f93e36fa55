import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.errors import PySparkException

from cardtide.operators import (
    chained_totals,
    fill_quiet_minutes,
    minute_rollup,
    sliding_hour,
    with_previous,
)
from cardtide.schemas import MINUTE

T0 = dt.datetime(2024, 3, 1, 23, 58)


def at(minute, second=0):
    return T0 + dt.timedelta(minutes=minute, seconds=second)


def transactions(spark, rows):
    return spark.createDataFrame(rows, "txn_time timestamp, status string")


def minute_table(spark, counts):
    """``counts``: minute offset -> (total, approved)."""
    rows = [(at(m), total, approved) for m, (total, approved) in counts.items()]
    return spark.createDataFrame(
        rows, "minute_ts timestamp, ttl_txn_min long, approved_txn_min long"
    )


def by_minute(df, *names):
    return {r.minute_ts: tuple(r[n] for n in names) for r in df.collect()}


def test_rollup_counts_and_rate(spark):
    rows = [(at(0, s), "APPROVED") for s in (0, 30, 59)] + [(at(0, 10), "REJECTED")]
    rows += [(at(1), "REJECTED")]
    out = minute_rollup(transactions(spark, rows))
    assert out.columns == MINUTE.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in MINUTE]
    assert by_minute(out, "ttl_txn_min", "approved_txn_min", "approved_rate_min") == {
        at(0): (4, 3, 75.0),
        at(1): (1, 0, 0.0),
    }


def test_rollup_label_end_and_compat_calendar(spark):
    out = minute_rollup(transactions(spark, [(at(0, 5), "APPROVED")]), label="end", calendar="compat")
    row = out.first()
    assert row.minute_ts == at(1)
    assert (row.year, row.month, row.day, row.hour, row.minute) == (2024, 2, 1, 11, 59)


def test_rollup_of_nothing(spark):
    assert minute_rollup(transactions(spark, [])).collect() == []


def test_rollup_before_1970_and_null_time(spark):
    early = dt.datetime(1969, 12, 31, 23, 59, 30)
    out = minute_rollup(transactions(spark, [(early, "APPROVED")]))
    assert out.first().minute_ts == early.replace(second=0)
    with pytest.raises(PySparkException, match="null txn_time"):
        minute_rollup(transactions(spark, [(None, "APPROVED")])).collect()


def test_every_row_is_counted_once(spark):
    rng = random.Random(5)
    rows = [
        (at(0, rng.randrange(5000)), rng.choice(["APPROVED", "REJECTED"])) for _ in range(2000)
    ]
    out = minute_rollup(transactions(spark, rows)).collect()
    assert sum(r.ttl_txn_min for r in out) == len(rows)
    assert sum(r.approved_txn_min for r in out) == Counter(s for _, s in rows)["APPROVED"]


def test_golden_chain(spark):
    minutes = minute_table(spark, {0: (4, 3), 1: (0, 0), 2: (1, 0), 4: (2, 2)})
    out = chained_totals(minutes)
    assert by_minute(out, "ttl_txn_hr", "approved_txn_hr", "approved_rate_hr") == {
        at(0): (4, 3, 75.0),
        at(1): (4, 3, 75.0),
        at(2): (5, 3, 60.0),
        at(4): (2, 2, 100.0),
    }


def expected_chain(counts):
    out, carried = {}, {}
    for m in sorted(counts):
        before = carried.get(m - 1, (0, 0))
        carried[m] = tuple(x + y for x, y in zip(before, counts[m]))
        out[at(m)] = carried[m]
    return out


def random_counts(seed):
    """Runs and gaps of all lengths over two weeks, some longer than whole days."""
    rng = random.Random(seed)
    counts, m = {}, 0
    while m < 14 * 1440:
        run = rng.choice([1, 2, 30, 600, 1440, 2881, 4000])
        for i in range(m, m + run):
            total = rng.randrange(5)
            counts[i] = (total, rng.randint(0, total))
        m += run + rng.choice([1, 1, 2, 59, 60, 61, 1440, 3000])
    return counts


@pytest.mark.parametrize("seed", range(4))
def test_chain_across_midnights(spark, seed):
    counts = random_counts(seed)
    out = chained_totals(minute_table(spark, counts).repartition(7))
    assert by_minute(out, "ttl_txn_hr", "approved_txn_hr") == expected_chain(counts)


def test_chain_without_any_gap(spark):
    counts = {m: (1, 1) for m in range(5 * 1440)}
    out = by_minute(chained_totals(minute_table(spark, counts)), "ttl_txn_hr")
    assert out == {at(m): (m + 1,) for m in counts}


def test_golden_sliding_hour(spark):
    minutes = fill_quiet_minutes(minute_table(spark, {0: (1, 1), 59: (1, 0), 60: (0, 0)}))
    out = by_minute(sliding_hour(minutes), "ttl_txn_hr", "approved_rate_hr")
    assert len(out) == 61
    assert out[at(59)] == (2, 50.0)
    assert out[at(60)] == (1, 0.0)


@pytest.mark.parametrize("seed, length", [(0, 60), (1, 60), (2, 1), (3, 1440)])
def test_sliding_across_midnights(spark, seed, length):
    counts = random_counts(seed)
    running, upto = defaultdict(int), 0
    last = max(counts)
    for m in range(0, last + 1):
        upto += counts.get(m, (0, 0))[0]
        running[m] = upto
    want = {at(m): (running[m] - running[m - length],) for m in counts}
    out = sliding_hour(minute_table(spark, counts), length)
    assert by_minute(out, "ttl_txn_hr") == want


def test_previous_minute_across_midnight(spark):
    minutes = minute_table(spark, {0: (4, 3), 1: (2, 1), 2: (5, 5), 9: (1, 1)})
    want = {at(0): (0, 0), at(1): (4, 3), at(2): (2, 1), at(9): (0, 0)}
    names = ("prev_ttl_txn_min", "prev_approved_txn_min")
    assert by_minute(with_previous(minutes), *names) == want
    assert by_minute(with_previous(minutes, minutes), *names) == want


def test_previous_is_looked_up_in_the_stored_table(spark):
    stored = chained_totals(minute_table(spark, {0: (4, 3), 1: (2, 1)}))
    now = minute_table(spark, {2: (5, 5)})
    out = with_previous(now, stored, ["ttl_txn_hr", "approved_txn_hr"])
    assert by_minute(out, "prev_ttl_txn_hr", "prev_approved_txn_hr") == {at(2): (6, 4)}


def test_fill_quiet_minutes(spark):
    counts = {0: (4, 3), 5: (1, 0), 3000: (2, 2)}
    out = by_minute(fill_quiet_minutes(minute_table(spark, counts)), "ttl_txn_min", "approved_rate_min")
    assert len(out) == 3001
    assert out[at(0)] == (4, 75.0)
    assert out[at(3000)] == (2, 100.0)
    assert sum(t for t, _ in out.values()) == 7
    assert out[at(1500)] == (0, 0.0)


def test_fill_of_nothing(spark):
    nothing = minute_table(spark, {0: (1, 1)}).limit(0)
    assert fill_quiet_minutes(nothing).collect() == []


def test_chain_carries_through_filled_minutes(spark):
    minutes = minute_table(spark, {0: (4, 3), 4000: (1, 0)})
    out = by_minute(chained_totals(fill_quiet_minutes(minutes)), "ttl_txn_hr")
    assert out[at(3999)] == (4,)
    assert out[at(4000)] == (5,)


def test_a_stray_time_raises_instead_of_filling_centuries(spark):
    rows = minute_rollup(
        spark.createDataFrame(
            [(dt.datetime(1970, 1, 1), "APPROVED"), (dt.datetime(2024, 3, 1), "APPROVED")],
            "txn_time timestamp, status string",
        )
    )
    with pytest.raises(Exception, match="19783 days of minutes, over 3660"):
        fill_quiet_minutes(rows).count()
    assert fill_quiet_minutes(rows, max_days=20_000).count() == 19_783 * 1440 + 1
