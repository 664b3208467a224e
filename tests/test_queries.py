"""Registered queries against their DuckDB oracle on the smallest driver data,
plus the driver entry point."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as E
from indexkit.plans.standins import TABLES

SF = "/root/testdata/sf0.001"
FAST = ["occupation_index", "axis_industry", "axis_region", "axis_wage_band", "clean_parse", "tasks_scored",
        "band_join", "weighted_mean", "rank_nulls", "agreement", "stratified_sample", "response_parse",
        "histogram", "funnel", "swap_flags", "latest_slice", "manifest_diff", "dim_region", "landing_roundtrip", "quarantine",
        "occupation_index_placeholder", "anti_left", "anti_right", "except_keys", "tasks_left", "coverage", "dim_industry",
        "vw_industry_occupation", "calibration", "score_worklist", "newest_slice", "publish_reload", "seed_if_empty",
        "ordered_counts", "staging_tasks", "staging_scores", "worklist"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    def v(x):
        if isinstance(x, float) and math.isnan(x):
            return None
        return x
    return Counter(tuple(repr(v(r[i])) for i in order) for r in rows)


def test_every_query_has_an_oracle_or_is_documented():
    missing = {n for n in E.REGISTRY if n not in E.oracle_sql()}
    assert missing == set()


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "BOOLEAN": "boolean"}


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    types = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert {f.name: f.dataType.simpleString() for f in df.schema.fields} == types
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _canon(df.columns, rows) == _canon(dcols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "AI_EXPOSURE" in df.columns
