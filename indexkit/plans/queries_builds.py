"""Registered queries: versioned publish, incremental rebuild, append-only
result stores and seeds, on data derived from the driver tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from indexkit.plans import oracle as O
from indexkit.plans import pipeline as P
from indexkit.plans import standins as S
from indexkit.plans.queries_ops import LATEST
from indexkit.plans.queries_quality import BASE_RULES_SQL, base_rules
from indexkit.plans.queries_staging import SOC_SQL, STG_SCORES_SQL, _land_catalogue, _land_oews, _land_scores
from indexkit.plans.registry import query
from indexkit.session import compiled, remove, written
from indexkit.sources import ingest as I
from indexkit.sources.publish import Publication, append_once, insert_if_empty

# ------------------------------------------------------------ publish

_OPEN = "o_orderstatus = 'O'"


@query("publish_reload", f"""
SELECT 'first' AS version, o_orderpriority, COUNT(*) AS n FROM orders WHERE {_OPEN} GROUP BY o_orderpriority UNION ALL
SELECT 'after_failure', o_orderpriority, COUNT(*) FROM orders WHERE {_OPEN} GROUP BY o_orderpriority UNION ALL
SELECT 'after_reload', o_orderpriority, COUNT(*) FROM orders GROUP BY o_orderpriority UNION ALL
SELECT 'reader_of_first', o_orderpriority, COUNT(*) FROM orders WHERE {_OPEN} GROUP BY o_orderpriority""", ids=("S07", "S11", "D28"))
def q_publish_reload(spark, sf_dir):
    """A table is published, a rebuild over it fails, a full reload replaces it;
    a reader that resolved the first version keeps it."""
    home = Publication(spark, I.work_dir(spark, "publish"))
    orders = S.read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")

    def seen(df, version):
        return df.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).select(F.lit(version).alias("version"), "o_orderpriority", "n")
    b = home.begin()
    b.put("orders", orders.filter(_OPEN))
    b.publish()
    reader = home.table("orders")
    out = written(seen(reader, "first"), "version")
    b = home.begin()
    try:
        b.put("orders", orders.withColumn("o_orderpriority", F.raise_error(F.lit("reload broken off"))))
        b.publish()
    except Exception:  # noqa: BLE001  (the failure that is shown)
        b.abandon()
    out = out.unionByName(written(seen(home.table("orders"), "after_failure"), "version"))
    b = home.begin()
    b.put("orders", orders)
    b.publish()
    return out.unionByName(seen(home.table("orders"), "after_reload")).unionByName(seen(reader, "reader_of_first"))


# ------------------------------------------------------------ rebuild

_JOINED = "lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"
_OEWS = f"(SELECT year(o_orderdate) AS y, c_nationkey, c_mktsegment FROM {_JOINED} WHERE l_partkey <> 0)"
_ONE_YEAR_OUT = ("dim_region", "dim_industry", "dq_results")
_EACH_BUILD = ("stg_national", "stg_tasks", "stg_scores", "dim_occupation", "dim_task", "dim_region", "dim_industry",
               "dim_wage_band", "ai_exposure_placeholder", "occupation_exposure_fact", "industry_occupation_exposure_fact",
               "region_occupation_exposure_fact", "industry_exposure_fact", "region_exposure_fact", "wage_band_exposure_fact",
               "vw_exposure_axis", "dq_results")
_NATIONAL = f"""(SELECT lpad(CAST(OCC_CODE AS VARCHAR), 7, '0') AS OCC_CODE FROM {LATEST} l
  WHERE AREA_TYPE = '1' AND I_GROUP = 'cross-industry' AND OWN_CODE = '1235' AND O_GROUP = 'detailed' AND OCC_CODE <> 0)"""
_COUNTS = {
    "stg_national": f"SELECT COUNT(*) FROM {_NATIONAL}", "dim_occupation": f"SELECT COUNT(DISTINCT OCC_CODE) FROM {_NATIONAL}",
    "stg_tasks": "SELECT COUNT(*) FROM lineitem", "dim_task": "SELECT COUNT(*) FROM lineitem",
    "stg_scores": f"SELECT COUNT(*) FROM ({STG_SCORES_SQL}) s", "dim_wage_band": "SELECT 3",
    "dim_region": f"SELECT COUNT(DISTINCT c_nationkey) FROM {_OEWS}", "dim_industry": f"SELECT COUNT(DISTINCT c_mktsegment) FROM {_OEWS}",
    "ai_exposure_placeholder": "SELECT COUNT(DISTINCT l_partkey) FROM lineitem"}


def _rebuild_sql():
    years = f"(SELECT y, COUNT(*) AS n FROM {_OEWS} GROUP BY y)"
    oldest = f"(SELECT min(y) FROM {_OEWS})"
    out = []
    for b in ("b1", "b2", "b3"):
        # the third build finds every row of the oldest year twice
        n, hit = (f"CASE WHEN y = {oldest} THEN 2 * n ELSE n END", f"y = {oldest}") if b == "b3" else ("n", "true" if b == "b1" else "false")
        out.append(f"SELECT '{b}' AS build, 'stg_oews@' || y AS table_name, {hit} AS written, ({n})::BIGINT AS n FROM {years}")
        for t in _EACH_BUILD:
            wrote = b == "b1" or (b == "b3" and t in _ONE_YEAR_OUT)
            count = f"({_COUNTS[t]})::BIGINT" if t in _COUNTS else "NULL::BIGINT"
            out.append(f"SELECT '{b}', '{t}', {str(wrote).lower()}, {count}")
    return " UNION ALL ".join(out)


@query("rebuild_incremental", _rebuild_sql(), ids=("D28", "S20", "S11", "S19"))
def q_rebuild_incremental(spark, sf_dir):
    """The domain pipeline three times: from nothing, from the same inputs, and
    with a changed oldest year.  Per build and table: was it written, and how
    many rows does the published table have (where SQL counts them plainly)."""
    with compiled(spark):
        out = I.work_dir(spark, "rebuild")
        # the text goes as soon as it is landed
        text = I.work_dir(spark, "text")
        oews = written(_land_oews(spark, sf_dir, f"{text}/oews"), "oews")
        remove(spark, f"{text}/oews")
        statements, ratings, _ctx = (written(d, "catalogue") for d in _land_catalogue(spark, sf_dir, f"{text}/catalogue"))
        remove(spark, text)
        scores = _land_scores(spark, sf_dir)
        oldest = oews.agg(F.min("DATA_YEAR")).first()[0]
        report = []
        for build, raw in (("b1", oews), ("b2", oews), ("b3", oews.unionByName(oews.filter(F.col("DATA_YEAR") == oldest)))):
            try:
                t = P.rebuild(spark, P.RawTables(raw, statements, ratings, scores), out, build=build, publish_failed=True)
            except P.QualityFailure as e:    # line items repeat keys, so rules FAIL on the stand-ins
                t = e.tables
            wrote = {r[0] for r in t["written"].collect()}
            tables = Publication(spark, out).current()["tables"]
            for name in sorted(tables):
                rows = t[name].count() if name in _COUNTS or name.startswith("stg_oews@") else None
                report.append((build, name, name in wrote, rows))
    return spark.createDataFrame(report, "build string, table_name string, written boolean, n long")


# ------------------------------------------------------------ result stores

_BUILDS = (("2024-01", datetime(2024, 1, 31, 6, 0)), ("2024-02", datetime(2024, 2, 29, 6, 0)))


@query("quality_history", f"""
SELECT b.BUILD_ID, r.CHECK_ID, r.CHECK_NAME, r.METRIC, r.METRIC_VALUE, r.STATUS, b.CHECKED_AT
FROM ({BASE_RULES_SQL}) r,
     (VALUES {', '.join(f"('{k}', TIMESTAMP '{at}')" for k, at in _BUILDS)}) b(BUILD_ID, CHECKED_AT)""", ids=("Q00", "Q31", "Q32", "F6"))
def q_quality_history(spark, sf_dir):
    """Rule results of two builds in an append-only store, stamped with each
    build's clock; a replay of the first build adds nothing."""
    path = I.work_dir(spark, "quality")
    results = written(base_rules(spark, sf_dir), "rules")
    for key, at in (*_BUILDS, _BUILDS[0]):
        append_once(spark, path, results.withColumn("CHECKED_AT", F.lit(at)), key)
    return spark.read.parquet(path).select(F.col("BUILD_ID").cast("string").alias("BUILD_ID"), "CHECK_ID", "CHECK_NAME", "METRIC",
                                           "METRIC_VALUE", "STATUS", F.col("CHECKED_AT").cast("timestamp_ntz").alias("CHECKED_AT"))


@query("seed_if_empty", """
SELECT 'empty' AS store, r_regionkey AS key, r_name AS name FROM region UNION ALL
SELECT 'filled', n_nationkey, n_name FROM nation""", ids=("S14",))
def q_seed_if_empty(spark, sf_dir):
    """Defaults go into a store without rows, once, and not into one that has some."""
    root = I.work_dir(spark, "seed")
    defaults = S.read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"))
    own = S.read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    append_once(spark, f"{root}/filled", own, "first")
    for store in ("empty", "filled", "empty"):
        insert_if_empty(spark, f"{root}/{store}", defaults)
    return spark.read.parquet(f"{root}/empty").select(F.lit("empty").alias("store"), "key", "name").unionByName(
        spark.read.parquet(f"{root}/filled").select(F.lit("filled").alias("store"), "key", "name"))
