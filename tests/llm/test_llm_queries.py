"""Registered queries of the training-data operators against DuckDB, and the pipeline."""

from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from indexkit.llm import queries  # noqa: F401  (registers)
from indexkit.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "labels", "conversations")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_one_query_for_every_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_duckdb(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == Counter(res.fetchall())


def test_pipeline_stages(spark, scratch):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_classifier", "exact_dedup", "ngram_jaccard_join", "best_fit_packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10 ** 9, "", "en", None, 0), (10 ** 9, "", "en", None, 0)], docs.schema)
    docs = docs.unionByName(odd).withColumn("kept", F.lit(1)).withColumn("perplexity", F.lit("x"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if name != "best_fit_packing":
            assert out.columns == docs.columns
        before, after = docs.count(), out.count()
        out.write.parquet(f"{scratch}/{k}")
        assert (after <= before) or name == "best_fit_packing"
        docs = spark.read.parquet(f"{scratch}/{k}")
        if name != "best_fit_packing":
            assert docs.filter("kept <> 1 OR perplexity <> 'x'").count() == 0
    assert docs.count() > 100


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0
