"""The registered queries of the operators against SQL, and the pipeline stage by stage."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from reviewmill.llm import queries, shared

MEDIUM = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"
#: Two lines of 25 words and 149 characters.
TWO = [" ".join([word] * 25) for word in ("alpha", "gamma")]


def test_every_operator_has_a_query():
    names = entry_points.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "conversations", "labels"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{MEDIUM}/{table}.parquet'")
    expected = db.execute(queries.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, MEDIUM).toPandas()
    columns = sorted(expected.columns)
    assert sorted(got.columns) == columns

    def rows(frame):
        plain = frame[columns].astype(object)  # nulls alike, whatever their kind
        return sorted(map(tuple, plain.where(plain.notna(), None).astype(str).values.tolist()))

    assert rows(got) == rows(expected)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = shared.stored(stage(spark, before, SMALL))
        known = before.select("doc_id").distinct()
        assert after.join(known, "doc_id", "left_anti").count() == 0
        if name != "encoding":
            assert after.columns == columns
        if name == "line_dedup":
            assert after.filter(F.char_length("text") != F.col("n_chars")).count() == 0
        if name == "near_dedup":
            assert after.groupBy("doc_id").count().filter("count > 1").count() == 0
        if name == "source_mixing":  # every document, and some more often
            assert after.select("doc_id").distinct().count() == before.count() <= after.count()
        if name == "encoding":
            assert after.count() == before.count() and after.filter("size(ids) = 0").count() == 0
        before = after
    assert corpus_pipeline.run(spark, SMALL).count() == before.count()


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = shared.stored(stage(spark, docs, SMALL))
    assert docs.count() == 0


def test_query_deletes_wordy_runs_of_two_lines(spark, tmp_path):
    rows = [(495, "top\n" + "\n".join(TWO)), (2855, "other\n" + "\n".join(TWO) + "\nend")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.text for r in queries.op10_line_runs(spark, str(tmp_path)).collect()}
    assert got == {495: rows[0][1], 2855: "other\nend"}


def test_pipeline_deletes_wordy_runs_of_two_lines(spark):
    rows = [(495, "top\n" + "\n".join(TWO), "en", "s", 0), (2855, "other\n" + "\n".join(TWO) + "\nend", "en", "s", 0)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, given, SMALL).collect()}
    assert got == {495: "top\n" + "\n".join(TWO), 2855: "other\nend"}
