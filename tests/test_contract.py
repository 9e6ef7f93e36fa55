"""Every registered query against its SQL, and what its plan must not hold."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_queries import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for file in pathlib.Path(SF_DIR).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


@pytest.mark.parametrize("name", sorted(contract.queries().keys() - contract._llm_queries().keys()))
def test_query_equals_its_sql(spark, con, name):
    df = contract.queries()[name](spark, SF_DIR)
    got = df.toPandas()
    assert len(got) > 0
    assert compare(got, con.sql(contract.oracle_sql()[name]).df()) == ""
    plan = df._jdf.queryExecution().executedPlan().toString()
    for slow in ("CartesianProduct", "NestedLoopJoin", "PythonUDF", "InPandas", "InArrow"):
        assert slow not in plan


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.count() == 988
    assert df.schema == contract.queries()["chained_totals"](spark, SF_DIR).schema


def test_messages_are_read_once(spark):
    """Totals carried over midnight reuse the per-minute counts."""
    df = contract.queries()["chained_totals_wire"](spark, SF_DIR)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1
    assert "ReusedExchange" in final


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("retain_day", "GreaterThan(ts,"),
        ("point_lookup", "(minute_date#"),
        ("minute_rollup", "ReadSchema: struct<ts:timestamp_ntz,props:string>"),
        ("chained_totals", "ReadSchema: struct<ts:timestamp_ntz,props:string>"),
    ],
)
def test_scan_reads_only_what_is_needed(spark, name, pushed):
    df = contract.queries()[name](spark, SF_DIR)
    assert pushed in df._jdf.queryExecution().executedPlan().toString()
