from pyspark.sql import functions as F

from cardtide.functions import approval_rate, classify


def test_first_rule_that_holds_is_the_reason(spark):
    df = spark.createDataFrame([(1, 500.0), (50, 500.0), (50, 1.0)], "score int, amount double")
    rules = [("low", F.col("score") < 5), ("large", F.col("amount") > 100)]
    rows = classify(df, rules=rules, reason="why").collect()
    assert [(r.status, r.why) for r in rows] == [
        ("REJECTED", "low"),
        ("REJECTED", "large"),
        ("APPROVED", None),
    ]


def test_unknown_score_is_not_approved(spark):
    df = spark.createDataFrame([(None,)], "score int")
    assert classify(df).first().status is None


def test_rate(spark):
    df = spark.createDataFrame([(0, 0), (3, 4), (1, 3)], "a long, t long")
    rows = df.select(approval_rate(F.col("a"), F.col("t")).alias("r")).collect()
    assert [r.r for r in rows] == [0.0, 75.0, 1 / 3 * 100.0]
