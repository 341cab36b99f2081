"""Registered queries against their check SQL, and the pipeline stage by stage."""

import os
import sys

import pytest
from checking import connect, spark_rows, sql_rows
from pyspark.sql import functions as F

from amihan.llm import mixing, pii
from amihan.llm.queries import CHECK_SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", list(CHECK_SQL))
def test_query_equals_check_sql(spark, key):
    names, rows = spark_rows(QUERIES[key](spark, SF_DIR))
    sql_names, expected = sql_rows(connect(SF_DIR), CHECK_SQL[key])
    assert names == sql_names
    assert rows == expected


def test_pipeline_stage_by_stage(spark, tmp_path):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = spark.createDataFrame([(-1, None, None, None, None), (-2, "...", "en", "src0", 3)], docs.schema)
    docs = docs.unionByName(extra)
    kept = {}
    for name, stage in pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(path := str(tmp_path / name))
        kept[name], docs = (docs, spark.read.parquet(path)), spark.read.parquet(path)
    ids = lambda df: {r["doc_id"] for r in df.select("doc_id").distinct().collect()}
    before, after = kept["language_id"]
    assert ids(before) - ids(after) == {-1, -2}
    before, after = kept["near_duplicates"]
    assert after.columns == before.columns and after.count() == len(ids(after)) < before.count()
    before, after = kept["personal_data"]
    assert after.count() == before.count()
    assert pii.find_spans(after).where(F.exists("spans", lambda s: s["kind"] == "email")).count() == 0
    before, after = kept["source_mix"]
    copies = {r["doc_id"]: r["n_copies"] for r in mixing.mix_sources(before).collect()}
    assert {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()} == copies
    assert docs.where("n_tokens <> size(ids) or n_tokens is null").count() == 0
    assert docs.count() == sum(copies.values())


def test_pipeline_keeps_texts_of_unlabelled_tables(spark):
    import corpus_pipeline as pipeline

    rows = [(1, "Größe", None, "a", 5), (2, "日本", None, "a", 2), (3, "12 .", None, "a", 4), (4, None, None, "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"]: r["lang"] for r in pipeline.identify_language(spark, docs, SF_DIR).collect()}
    assert kept == {1: "und", 2: "und"}


def test_pipeline_keeps_one_row_of_repeated_and_missing_ids(spark):
    import corpus_pipeline as pipeline

    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(1, a), (1, a), (1, a + " more"), (2, a), (None, a), (None, b), (None, b), (None, b + " more"), (None, c), (7, d), (7, None)]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert out.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(kept) == 4 and {(1, a), (None, c), (7, d)} < set(kept)
    assert {t for _, t in kept} - {a, c, d} < {b, b + " more"}


def test_mixing_draws_rows_without_id_apart(spark):
    rows = [(None, f"text {i:03d}", "en", "a", 8) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    texts = {r["text"] for r in mixing.mix_sources(docs).collect()}
    assert 150 < len(texts) < 230
