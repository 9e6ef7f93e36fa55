import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cardtide.operators import basket_totals, explode_items, fold_items


def lines_of(spark, rows):
    return spark.createDataFrame(rows, "basket long, n int, item string, price double")


def fold(df, **how):
    return fold_items(df, "basket", F.col("item"), F.col("price"), order_by=["n"], **how)


def test_golden_basket(spark):
    lines = lines_of(spark, [(1, 2, "Item_2", 3.0), (1, 1, "Item_1", 1.5), (2, 1, "Item_9", 7.25)])
    rows = {r.basket: r for r in fold(lines).collect()}
    assert rows[1].items == "Item_1->1.50,Item_2->3.00"
    assert (rows[1].part, rows[1].amount, rows[1].n_items) == (0, Decimal("4.50"), 2)
    assert rows[2].items == "Item_9->7.25"


def test_ties_are_listed_by_name_then_price(spark):
    lines = lines_of(spark, [(1, 1, "b", 10.0), (1, 1, "b", 9.0), (1, 1, "a", 99.0)])
    assert fold(lines).first().items == "a->99.00,b->9.00,b->10.00"


def test_large_baskets_are_one_ordered_text(spark):
    """One basket of a third of all rows, one of copies of a single line, and one
    without a key, beside small ones."""
    rng = random.Random(3)
    rows = [(1, rng.randrange(9), f"i{rng.randrange(50)}", rng.randrange(500) / 100) for _ in range(30_000)]
    rows += [(2, 1, "same", 1.25)] * 9000
    rows += [(None, 1, f"x{i}", 1.0) for i in range(300)]
    rows += [(b, i, f"i{i}", 0.1) for b in range(10, 300) for i in range(3)]
    got = {r.basket: r for r in fold(lines_of(spark, rows)).collect()}
    want = defaultdict(list)
    for basket, n, item, price in rows:
        want[basket].append((n, item, Decimal(f"{price:.2f}")))
    assert got.keys() == want.keys()
    for basket, entries in want.items():
        row = got[basket]
        assert row["items"] == ",".join(f"{i}->{p}" for _, i, p in sorted(entries))
        assert (row.part, row.n_items, row.amount) == (0, len(entries), sum(p for _, _, p in entries))


@pytest.mark.parametrize("item, price", [(None, 1.0), ("a", None), ("a->b", 1.0), ("a,b", 1.0), ("a;b", 1.0)])
def test_unclear_items_raise(spark, item, price):
    with pytest.raises(Exception, match="item"):
        fold(lines_of(spark, [(1, 1, item, price), (1, 2, "x", 2.0)])).collect()


def test_prices_add_up_exactly(spark):
    lines = lines_of(spark, [(1, i, "a", 0.1) for i in range(1000)])
    assert fold(lines).first().amount == Decimal("100.00")
