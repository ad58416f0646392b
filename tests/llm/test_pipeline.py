"""The corpus pipeline against its parts, on the smallest tables."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from checks.compare import differences, duck
from paytide.llm import quality, secrets
from paytide.llm.queries import QUERIES, SQL

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")
def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = dict.fromkeys(texts)
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SMALL)
        assert frame.columns == docs.columns, name
        kept = {r.doc_id: r.text for r in frame.collect()}
        assert set(kept) <= set(rows)
        rows = kept
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    toxic = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    assert len(toxic & set(rows)) <= len(toxic) // 4
    assert all(not secrets.base_spans(text) for text in rows.values())
    packed = corpus_pipeline.run(spark, SMALL).toPandas()
    assert set(packed.doc_id) == set(rows)
    assert quality.scored(docs, quality.Model(3)).count() == len(texts)
    assert len(QUERIES) == 13


def test_one_row_of_each_group_of_near_duplicates(spark):
    words = [f"w{i}" for i in range(40)]
    text, near, other = " ".join(words), " ".join([*words, "more"]), " ".join(reversed(words))
    rows = [(5, text), (5, text), (3, near), (None, text), (None, other), (None, other), (5, "quite another")]
    rows += [(8, None), (8, None), (9, " ")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, row_key int")
    got = corpus_pipeline.near_duplicate_removal(spark, docs, SMALL)
    assert got.columns == docs.columns
    kept = [(None, other), (3, near), (5, "quite another"), (8, None), (8, None), (9, " ")]
    assert sorted((repr(r.doc_id), repr(r.text)) for r in got.collect()) == sorted((repr(a), repr(b)) for a, b in kept)


def test_leaking_texts_go_whatever_their_ids(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").filter("length(text) > 150").first().text
    clean = " ".join(f"w{i}" for i in range(60))
    rows = [(None, item), (7, f"{clean} {item}"), (7, clean), (None, clean), (8, None), (9, "")]
    docs = spark.createDataFrame([(*r, "own", i) for i, r in enumerate(rows)], "doc_id long, text string, text_key string, item_id int")
    got = corpus_pipeline.benchmark_decontamination(spark, docs, SMALL)
    assert got.columns == docs.columns
    assert sorted(r.item_id for r in got.collect()) == [2, 3, 4, 5]


def test_stages_of_clashing_columns_and_empty_tables(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    clashing = docs.withColumns({c: F.lit("own") for c in ("expected_grade", "tail_probability", "component_id")})
    for frame in (clashing, clashing.filter("false")):
        given = frame.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SMALL)
            assert out.columns == frame.columns, name
            rows = out.collect()
            assert len(rows) <= given and (given or not rows), name
            assert all(r.expected_grade == r.component_id == "own" for r in rows), name


def test_sql_of_the_queries(spark):
    for name in SQL:
        ours, theirs, differing, left, right = differences(spark, duck(SMALL), name, SMALL, QUERIES, SQL)
        assert ours == theirs and not differing, (name, left, right)
