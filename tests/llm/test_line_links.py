import random

from pyspark.sql import functions as F

from cardtide.llm import lines


def test_large_bucket_loses_no_link(spark):
    """A near pair in a large bucket that no leader of the first round belongs to is still linked."""
    rng = random.Random(3)
    n = 300
    ids = spark.range(1, n + 1).withColumnRenamed("id", "line_id")
    orders = [F.xxhash64(F.lit(lines.LEADERS + i), "line_id") for i in range(lines.LEADERS)]
    first = {
        ids.select(*[o.alias(f"h{i}") for i, o in enumerate(orders)], "line_id")
        .orderBy(f"h{i}").first()["line_id"]
        for i in range(len(orders))
    }
    x, y = [i for i in range(1, n + 1) if i not in first][:2]
    text = {i: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(60)) for i in range(1, n + 1)}
    text[y] = text[x][:-1] + ("A" if text[x][-1] != "A" else "B")
    least = [0] * (lines.BANDS * lines.ROWS)
    met = spark.createDataFrame([(i, 7) for i in text], "line_id long, band long")
    texts = spark.createDataFrame(
        [(i, t, least) for i, t in text.items()], "line_id long, line string, least array<int>"
    )
    roots = {r["node"]: r["root"] for r in lines._linked(met, texts).collect()}
    assert roots.get(x) == roots.get(y) == min(x, y)
    assert all(roots.get(i, i) == i for i in text if i not in (x, y))
