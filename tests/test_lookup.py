import bisect
import random

import pytest
from pyspark.sql import functions as F

from cardtide.operators import assign_weighted

WAYS = {"broadcast": 1 << 20, "distributed": 0}


def bounds_of(spark, pairs):
    return spark.createDataFrame(pairs, "cum double, label string")


def numbers_of(spark, us):
    return spark.createDataFrame(list(enumerate(us)), "id long, u double")


def labels(spark, pairs, us, way):
    out = assign_weighted(numbers_of(spark, us), bounds_of(spark, pairs), max_broadcast_bytes=WAYS[way])
    assert out.columns == ["id", "u", "label"]
    found = {r.id: r.label for r in out.collect()}
    return [found[i] for i in range(len(us))]


@pytest.mark.parametrize("way", WAYS)
def test_golden_ceiling(spark, way):
    pairs = [(0.2, "A"), (0.5, "B"), (1.0, "C")]
    us = [0.0, 0.2, 0.21, 0.5, 0.99]
    assert labels(spark, pairs, us, way) == ["A", "A", "B", "B", "C"]
    assert labels(spark, pairs[:2], us, way) == ["A", "A", "B", "B", "All Other"]


@pytest.mark.parametrize("way", WAYS)
def test_outside_and_missing_numbers(spark, way):
    us = [-5.0, 1.5, None, float("nan"), 7.0]
    got = labels(spark, [(0.5, "A"), (3.0, "B")], us, way)
    assert got == ["A", "B", "All Other", "All Other", "All Other"]


@pytest.mark.parametrize("way", WAYS)
def test_repeated_and_null_bounds(spark, way):
    got = labels(spark, [(0.5, "A"), (0.5, "B"), (None, "Z"), (1.0, "C")], [0.5, 0.6], way)
    assert got == ["B", "C"]


@pytest.mark.parametrize("way", WAYS)
@pytest.mark.parametrize("seed", range(3))
def test_against_bisection(spark, way, seed):
    """Random bounds, some packed into a sliver; one number makes up a third of rows."""
    rng = random.Random(seed)
    cums = {rng.random() for _ in range(200)} | {0.4 + rng.random() / 1e6 for _ in range(200)}
    cums = sorted(cums)
    us = [rng.random() for _ in range(500)] + [0.4 + rng.random() / 1e6 for _ in range(500)]
    us += rng.sample(cums, 50) + [0.4000005] * 500
    want = []
    for u in us:
        i = bisect.bisect_left(cums, u)
        want.append(f"L{i}" if i < len(cums) else "All Other")
    assert labels(spark, [(c, f"L{i}") for i, c in enumerate(cums)], us, way) == want


def test_several_labels_with_their_own_defaults(spark):
    bounds = spark.createDataFrame([(0.3, "US", "CA"), (0.6, "NA", "")], "cum double, c string, r string")
    out = assign_weighted(
        numbers_of(spark, [0.1, 0.5, 0.9]), bounds, labels={"c": "All Other", "r": ""}
    )
    assert [(r.c, r.r) for r in out.orderBy("id").collect()] == [
        ("US", "CA"),
        ("NA", ""),
        ("All Other", ""),
    ]


def test_rows_are_not_shuffled_and_joined_by_hash(spark):
    out = assign_weighted(numbers_of(spark, [0.1]), bounds_of(spark, [(0.5, "A")]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    many = bounds_of(spark, [(i / 200, "A") for i in range(200)])
    plan = assign_weighted(numbers_of(spark, [0.1]), many)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("way", WAYS)
def test_running_counts_as_bounds(spark, way):
    """Bounds far from [0, 1), enough of them for a second level of cuts."""
    bounds = spark.range(1, 5001).select((F.col("id") * 3).cast("double").alias("cum"), "id")
    bounds = bounds.withColumn("label", F.col("id").cast("string"))
    rows = spark.range(0, 15010).select("id", (F.col("id") - 2.5).alias("u"))
    out = assign_weighted(rows, bounds, max_broadcast_bytes=WAYS[way])
    want = F.when(F.col("u") <= 0, "1").when(F.col("u") > 15000, "All Other")
    want = want.otherwise(F.ceil(F.col("u") / 3).cast("string"))
    assert out.count() == 15010
    assert out.filter(F.col("label") != want).isEmpty()


@pytest.mark.parametrize("way", WAYS)
def test_no_bounds(spark, way):
    assert labels(spark, [(None, "Z")], [0.5, None], way) == ["All Other", "All Other"]


@pytest.mark.parametrize("way", WAYS)
def test_works_on_a_stream(spark, tmp_path, way):
    numbers_of(spark, [0.1, 0.7]).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long, u double").parquet(str(tmp_path / "in"))
    out = assign_weighted(stream, bounds_of(spark, [(0.5, "A"), (1.0, "B")]), max_broadcast_bytes=WAYS[way])
    query = (
        out.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    assert query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("id").select(F.col("label")).collect()
    assert [r.label for r in got] == ["A", "B"]


def test_a_hot_cut_and_missing_numbers_are_spread(spark):
    """A third of the rows on one cut, a third without a number, bounds too many to broadcast."""
    bounds = spark.range(1, 3001).select(F.col("id").cast("double").alias("cum"), F.col("id").cast("string").alias("label"))
    rows = spark.range(0, 90_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, 1500.5)
        .when(F.col("id") % 3 == 1, (F.col("id") % 3100).cast("double"))
        .alias("u"),
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = assign_weighted(rows, bounds, max_broadcast_bytes=0)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 3 * sizes[4]
        wrong = out.filter(
            F.col("label") != F.when(F.col("u") > 3000, "All Other")
            .when(F.col("u").isNull(), "All Other")
            .otherwise(F.greatest(F.ceil("u"), F.lit(1)).cast("string"))
        )
        assert out.count() == 90_000 and wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("n", [0, 1, 2, 3, 63, 64, 65, 130])
def test_any_number_of_bounds(spark, n):
    rng = random.Random(n)
    cums = sorted({round(rng.random(), 4) for _ in range(n)})
    us = [rng.random() for _ in range(200)] + cums + [None, float("nan"), float("inf"), -1.0]
    want = []
    for u in us:
        i = bisect.bisect_left(cums, u) if u is not None and u == u else len(cums)
        want.append(f"L{i}" if i < len(cums) else "All Other")
    assert labels(spark, [(c, f"L{i}") for i, c in enumerate(cums)], us, "broadcast") == want
