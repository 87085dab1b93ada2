import duckdb
import pytest

import corpus_pipeline
from hourwise.llm import decontaminate, line_dedup, near_dedup
from hourwise.llm.queries import oracle_sql, queries

from .test_line_dedup import brute as brute_lines
from .test_near_dedup import brute as brute_classes

SF = "/root/testdata/sf0.001"


def test_stages_in_turn(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        rows = before.orderBy("doc_id").collect()
        after = spark.createDataFrame(after.collect(), after.schema)
        got = {x.doc_id: x.text for x in after.collect()}
        if name != "mixing":
            assert after.columns == columns
        if name == "language_id":
            assert set(got) == {r.doc_id for r in rows if r.text and any(c.isalpha() for c in r.text)}
        if name == "line_dedup":
            expected = brute_lines([r.text for r in rows], line_dedup.MIN_WORDS)
            assert got == {r.doc_id: t for r, t in zip(rows, expected) if t == r.text or t.strip()}
        if name == "near_dedup":
            assert set(got) == {rows[c].doc_id for c in set(brute_classes([r.text for r in rows]))}
        if name == "decontaminate":
            bad = decontaminate.report(before, spark.read.parquet(f"{SF}/benchmark.parquet")).filter("contaminated").collect()
            assert set(got) == {r.doc_id for r in rows} - {x.doc_id for x in bad}
        if name == "mixing":
            assert set(got) <= {r.doc_id for r in rows} and after.filter("taken > 3 * size or taken < 1").count() == 0
        before = after
    assert before.count() > 0


def test_near_dedup_classes_of_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.orderBy("doc_id").collect()
    got = {x.doc_id: x.class_id for x in near_dedup.labelled(docs).collect()}
    assert [got[r.doc_id] for r in rows] == [rows[c].doc_id for c in brute_classes([r.text for r in rows])]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries()[name](spark, SF)
    columns = sorted(df.columns)
    expected = con.execute(oracle_sql()[name]).to_arrow_table().select(columns).to_pylist()
    fixed = lambda rows: sorted(repr([round(r[c], 6) if isinstance(r[c], float) else r[c] for c in columns]) for r in rows)
    got = fixed([r.asDict() for r in df.collect()])
    assert got and got == fixed(expected)
