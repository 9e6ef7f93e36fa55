from pyspark.sql import functions as F

from cardtide.llm import lines


def test_leader_rounds_stay_one_ranking(spark):
    """However many leaders a late round elects, it is one ranking per bucket, not one
    aggregate per leader, and each line meets the lines of least hash of its bucket."""
    rows = [(i, 7 if i % 3 else 8, i) for i in range(1, 301)]
    met = spark.createDataFrame(rows, "line_id long, band long, root long")
    turn = 6  # 2048 leaders, more than a bucket holds: all pairs
    pairs = lines._met_leaders(met, turn)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") < 8
    band = {i: b for i, b, _ in rows}
    want = {(a, b) for a in band for b in band if a < b and band[a] == band[b]}
    assert {(r.a, r.b) for r in pairs.collect()} == want

    n = lines.LEADERS << 1
    few = {(r.a, r.b) for r in lines._met_leaders(met, 1).collect()}
    hashed = met.select("line_id", "band", F.xxhash64(F.lit(1), "line_id").alias("h")).collect()
    leaders = {
        b: {r.line_id for r in sorted((r for r in hashed if r.band == b), key=lambda r: (r.h, r.line_id))[:n]}
        for b in (7, 8)
    }
    assert few == {
        (min(i, j), max(i, j)) for i in band for j in leaders[band[i]] if i != j
    }


def test_joined_components_carry_earlier_links(spark):
    """Components of one round joined by the links of the next: a link between two members
    joins their whole components, and roots stay the smallest line."""
    roots = spark.createDataFrame([(2, 1), (1, 1), (3, 1), (5, 4), (4, 4), (9, 6), (6, 6)], "node long, root long")
    found = spark.createDataFrame([(3, 5), (10, 11)], "a long, b long")
    got = {r.node: r.root for r in lines._joined(roots, found).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 6, 9: 6, 10: 10, 11: 10}
