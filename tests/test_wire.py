import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cardtide.functions import (
    bad_rows,
    card_number,
    card_provider,
    decode_items,
    decode_wire,
    encode_wire,
    good_rows,
)
from cardtide.plans.screening import screen, to_transactions
from cardtide.schemas import TRANSACTION

GOLDEN = (
    "1234000000000042;1234;2016-01-15 13:05:07.12;id-1;Target;CA;US;"
    "Item_1->1.50,Item_2->3.00;4.50;4"
)
WIRE_TYPES = (
    "cc_no string, cc_provider string, txn_time timestamp, txn_id string, merchant string, "
    "location string, country string, items string, amount double, score int"
)


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def with_field(position, text):
    fields = GOLDEN.split(";")
    fields[position] = text
    return ";".join(fields)


@pytest.mark.parametrize(
    "calendar, parts, date_text",
    [("iso", (2016, 1, 15, 13, 5), "20160115"), ("compat", (2016, 0, 15, 1, 5), "20160015")],
)
def test_golden_message(spark, calendar, parts, date_text):
    out = screen(messages(spark, GOLDEN), calendar=calendar)
    assert out.columns == TRANSACTION.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in TRANSACTION]
    row = out.first()
    assert (row.year, row.month, row.day, row.hour, row.min) == parts
    assert row.date_text == date_text
    assert row.txn_time == dt.datetime(2016, 1, 15, 13, 5, 7, 120000)
    assert (row.cc_no, row.cc_provider) == ("1234000000000042", "1234")
    assert (row.merchant, row.location, row.country) == ("Target", "CA", "US")
    assert (row.amount, row.status) == (4.5, "REJECTED")


def test_items_of_golden_message(spark):
    row = decode_wire(messages(spark, GOLDEN)).select(decode_items(F.col("items")).alias("i")).first()
    assert [tuple(x) for x in row.i] == [
        ("Item_1", Decimal("1.50")),
        ("Item_2", Decimal("3.00")),
    ]


def test_items_keep_repeats_and_allow_none(spark):
    df = spark.createDataFrame([("a->1.00,a->1.00",), ("",)], "items string")
    rows = df.select(decode_items(F.col("items")).alias("i")).collect()
    assert [len(r.i) for r in rows] == [2, 0]


def test_bad_item_price_raises(spark):
    df = spark.createDataFrame([("a->x",)], "items string")
    with pytest.raises(PySparkException, match="bad price"):
        df.select(decode_items(F.col("items"))).collect()


def test_good_edge_messages(spark):
    rows = decode_wire(messages(spark, GOLDEN + ";extra", with_field(5, ""))).collect()
    assert [r.location for r in rows] == ["CA", ""]
    assert [r.score for r in rows] == [4, 4]


BAD = {
    "too few fields": ";".join(GOLDEN.split(";")[:9]),
    "bad score": with_field(9, "abc"),
    "bad amount": with_field(8, ""),
    "bad txn_time": with_field(2, "not-a-time"),
}


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", [*BAD.values(), with_field(9, "5.0")])
def test_bad_message_fails(spark, text, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(PySparkException, match="bad "):
            decode_wire(messages(spark, GOLDEN, text)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_only_used_fields_are_checked(spark):
    assert decode_wire(messages(spark, BAD["bad amount"])).select("score").first().score == 4


def test_quarantine(spark):
    texts = [GOLDEN, *BAD.values(), with_field(9, "5.0")]
    out = decode_wire(messages(spark, *texts, None), on_error="quarantine")
    bad = {r.value: r.problem for r in bad_rows(out).collect()}
    want = {text: problem for problem, text in BAD.items()}
    assert bad == {**want, with_field(9, "5.0"): "bad score", None: "too few fields"}
    good = good_rows(out)
    assert good.columns == decode_wire(messages(spark, GOLDEN)).columns
    assert good.collect() == decode_wire(messages(spark, GOLDEN)).collect()


def test_binary_value_and_kept_columns(spark):
    df = spark.createDataFrame([(7, GOLDEN.encode())], "offset long, value binary")
    row = decode_wire(df, keep=["offset"]).first()
    assert (row.offset, row.txn_id) == (7, "id-1")


def test_encode_golden(spark):
    assert encode_wire(decode_wire(messages(spark, GOLDEN))).first().value == GOLDEN


def test_encode_fills_nulls_and_whole_seconds(spark):
    row = (None, "0001", dt.datetime(2016, 1, 15, 1, 2, 3), "x", None, "", "US", None, 2.0, 7)
    df = spark.createDataFrame([row], WIRE_TYPES)
    assert encode_wire(df).first().value == ";0001;2016-01-15 01:02:03.0;x;;;US;;2.00;7"


def test_encode_refuses_separator_in_text(spark):
    row = ("1", "1", dt.datetime(2016, 1, 1), "x", "a;b", "", "US", "", 2.0, 7)
    with pytest.raises(PySparkException, match="separator in merchant"):
        encode_wire(spark.createDataFrame([row], WIRE_TYPES)).collect()


text = st.text(st.characters(exclude_characters=";", exclude_categories=("Cs", "Cc")), max_size=12)
wire_row = st.tuples(
    text,
    text,
    st.datetimes(dt.datetime(1971, 1, 1), dt.datetime(2100, 1, 1)),
    text,
    text,
    text,
    text,
    text,
    st.integers(-10**9, 10**11).map(lambda cents: cents / 100),
    st.integers(0, 99),
)


@settings(max_examples=10, deadline=None)
@given(st.lists(wire_row, min_size=1, max_size=40))
def test_decode_undoes_encode(spark, rows):
    df = spark.createDataFrame(rows, WIRE_TYPES).coalesce(1)
    assert decode_wire(encode_wire(df)).collect() == df.collect()


def test_card_fields_are_padded_not_cut(spark):
    df = spark.createDataFrame([(7, 42), (12345, 10**13)], "p long, n long")
    provider = card_provider(F.col("p"))
    rows = df.select(provider.alias("p"), card_number(provider, F.col("n")).alias("n")).collect()
    assert [tuple(r) for r in rows] == [
        ("0007", "0007000000000042"),
        ("12345", "1234510000000000000"),
    ]


def test_status_edges(spark):
    texts = [with_field(9, str(score)) for score in (0, 4, 5, 99)]
    rows = screen(messages(spark, *texts)).collect()
    assert [r.status for r in rows] == ["REJECTED", "REJECTED", "APPROVED", "APPROVED"]


def test_threshold_is_a_parameter(spark):
    decoded = decode_wire(messages(spark, with_field(9, "50")))
    assert to_transactions(decoded, reject_below=51).first().status == "REJECTED"


def test_split_is_done_once_below_filters(spark):
    from cardtide.functions import approved_only

    df = approved_only(screen(messages(spark, GOLDEN)))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1
