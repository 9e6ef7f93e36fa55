"""The registered queries and the pipeline on the smallest tables."""

import pathlib

import duckdb
import pytest

import corpus_pipeline
from cardtide.llm import entries
from tools.check_queries import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for file in pathlib.Path(SF_DIR).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return db


@pytest.mark.parametrize("name", entries.oracle_sql())
def test_query_equals_its_sql(spark, con, name):
    got = entries.queries()[name](spark, SF_DIR).toPandas()
    assert compare(got, con.sql(entries.oracle_sql()[name]).df()) == ""


@pytest.mark.parametrize("name", ["op7_secret_scan", "op8_chat_format", "op9_source_mix"])
def test_native_queries_run_no_python(spark, name):
    plan = entries.queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for slow in ("PythonUDF", "InPandas", "InArrow", "ArrowEval", "CartesianProduct", "NestedLoopJoin"):
        assert slow not in plan


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts, current = [docs.count()], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, SF_DIR)
        assert current.columns == docs.columns, name
        counts.append(current.count())
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert packed.groupBy("sequence_id").sum("length").agg({"sum(length)": "max"}).first()[0] <= 2048
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("toxic = 1").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("toxic = 0").collect()}
    kept = {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, SF_DIR).select("doc_id").collect()}
    assert len(kept & clean) >= 0.97 * len(clean)
    assert len(kept & toxic) <= 0.5 * len(toxic)


@pytest.mark.parametrize("rows", ["awkward", "none"])
def test_pipeline_on_awkward_rows(spark, tmp_path, rows):
    """Null and repeated ids, empty, long and equal texts, names of the stages' own; no rows at all."""
    texts = [None, "", " \n\t", "one", "one", "long " * 20_000, "a b c d e f g h i j\n" * 3, "ü" * 300]
    names = "given string, row string, removed string, copies string, _row string, _mix_id string"
    given = [
        (None if i % 3 == 2 else i // 2, t, "en", "s" if i % 2 else None, len(t or ""), *["mine"] * 6)
        for i, t in enumerate(texts * 2)
    ]
    docs = spark.createDataFrame(
        given if rows == "awkward" else [],
        "doc_id long, text string, lang string, source string, n_chars long, " + names,
    )
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    current = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        current = stage(spark, current, str(tmp_path))
        assert current.columns == docs.columns, name
        kept = current.collect()
        assert {(r.given, r.row, r.removed, r.copies, r._row, r._mix_id) for r in kept} <= {("mine",) * 6}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert bool(packed) == (rows == "awkward")
    assert all(p.length >= 1 and p.offset + p.length <= 2048 for p in packed)
