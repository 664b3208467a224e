"""Registered queries: the domain staging layer on text derived from the
driver tables (tab files with quoting off, a scores CSV with quoted text,
two appended runs), plus views, summaries and the pilot head."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from indexkit.functions.clean import ONET_NULL_TOKENS
from indexkit.functions.numeric import exact_ratio
from indexkit.operators import relational as REL
from indexkit.operators.rollup import units, weighted_rollup
from indexkit.plans import index as ix
from indexkit.plans import oracle as O
from indexkit.plans import pipeline as P
from indexkit.plans import standins as S
from indexkit.plans.queries import occupation_index_df
from indexkit.plans.queries_scoring import ONE_LINE_SQL, TASK_ID_SQL, one_line_per_task, task_id
from indexkit.plans.registry import query
from indexkit.schemas import (OCCUPATION_DATA_SCHEMA, SCORE_SCHEMA, TASK_RATING_SCHEMA,
                              TASK_STATEMENT_SCHEMA)
from indexkit.session import open_files, remove, written
from indexkit.sources import ingest as I


def _soc():
    """A detailed code like '0001616.06.12.19950301': the first 7 characters are
    the occupation, the suffix (line, supplier, ship date) varies as in
    11-1011.00 / 11-1011.03; with the order number it names one line item."""
    return F.concat(F.lpad(F.col("l_partkey").cast("string"), 7, "0"), F.lit(".0"), F.col("l_linenumber").cast("string"), F.lit("."),
                    F.col("l_suppkey").cast("string"), F.lit("."), F.date_format("l_shipdate", "yyyyMMdd"))


SOC_SQL = ("lpad(CAST(l_partkey AS VARCHAR), 7, '0') || '.0' || CAST(l_linenumber AS VARCHAR) || '.' "
           "|| CAST(l_suppkey AS VARCHAR) || '.' || strftime(l_shipdate, '%Y%m%d')")


def _write_tsv(df, path):
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "") \
      .option("escape", "").option("nullValue", "n/a").option("compression", "gzip").csv(path)


def _land_catalogue(spark, sf_dir, root=None, lines=None):
    """Statements, ratings and occupation context of ``lines`` (all line items)
    as tab files under ``root``, landed back."""
    root = root or I.work_dir(spark, "catalogue")
    d = S.read(spark, sf_dir, "lineitem") if lines is None else lines
    soc = _soc()
    st = d.select(soc.alias("ONET_SOC_CODE"), F.col("l_orderkey").cast("string").alias("TASK_ID"),
                  F.concat(F.lit('Handle "line" '), F.col("l_linenumber").cast("string"), F.lit(", carefully"))
                   .alias("TASK"),
                  F.when(F.col("l_returnflag") == "A", F.lit("Core"))
                   .when(F.col("l_returnflag") == "N", F.lit("Supplemental")).alias("TASK_TYPE"),
                  *[F.lit("10").alias(c) for c in ("INCUMBENTS_RESPONDING",)],
                  F.lit("08/2023").alias("DATE_UPDATED"), F.lit("Analyst").alias("DOMAIN_SOURCE"))
    ra = d.select(soc.alias("ONET_SOC_CODE"), F.col("l_orderkey").cast("string").alias("TASK_ID"),
                  F.when(F.col("l_linestatus") == "F", F.lit("IM")).otherwise(F.lit("RT")).alias("SCALE_ID"),
                  F.lit(None).cast("string").alias("CATEGORY"),
                  F.format_string("%.2f", F.col("l_quantity") / 10).alias("DATA_VALUE"),
                  *[F.lit("1").alias(c) for c in ("N", "STANDARD_ERROR", "LOWER_CI_BOUND", "UPPER_CI_BOUND")],
                  F.lit("N").alias("RECOMMEND_SUPPRESS"), F.lit("08/2023").alias("DATE_UPDATED"),
                  F.lit("Analyst").alias("DOMAIN_SOURCE"))
    # detailed codes of first lines have a context row, the others none
    p = S.read(spark, sf_dir, "part")
    ctx = d.filter("l_linenumber = 1").select(soc.alias("ONET_SOC_CODE"), "l_partkey").distinct().join(
        p, F.col("l_partkey") == F.col("p_partkey")).select(
        "ONET_SOC_CODE", F.col("p_name").alias("TITLE"), F.col("p_type").alias("DESCRIPTION"))
    for name, df in (("statements", st), ("ratings", ra), ("occupations", ctx)):
        _write_tsv(df, os.path.join(root, name))
    rd = lambda n, s: I.read_delimited(spark, os.path.join(root, n), s, sep="\t", quote=None,
                                       tokens=ONET_NULL_TOKENS, keep_corrupt=False)
    return (rd("statements", TASK_STATEMENT_SCHEMA), rd("ratings", TASK_RATING_SCHEMA),
            rd("occupations", OCCUPATION_DATA_SCHEMA))


STG_TASKS_SQL = f"""
SELECT CAST(l_orderkey AS BIGINT) AS TASK_ID, {SOC_SQL} AS ONET_SOC_CODE,
       lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS OCC_CODE,
       'Handle "line" ' || CAST(l_linenumber AS VARCHAR) || ', carefully' AS TASK_STATEMENT,
       CASE l_returnflag WHEN 'A' THEN 'Core' WHEN 'N' THEN 'Supplemental' END AS TASK_TYPE,
       CASE WHEN l_linestatus = 'F' THEN CAST(printf('%.2f', l_quantity / 10) AS DOUBLE) END AS IMPORTANCE_RAW,
       CASE WHEN l_linestatus = 'F' THEN (CAST(printf('%.2f', l_quantity / 10) AS DOUBLE) - 1.0) / 4.0 END
         AS IMPORTANCE_NORM
FROM ({ONE_LINE_SQL}) d"""


@query("staging_tasks", STG_TASKS_SQL,
       ids=("S02", "S15", "D05", "D06", "D07", "D08", "D12", "P02", "P05", "P08", "P10", "J01"))
def q_staging_tasks(spark, sf_dir):
    """Line items are deduplicated by task, so statement ⟕ importance keeps one
    row per task."""
    st, ra, _ctx = _land_catalogue(spark, sf_dir, lines=written(one_line_per_task(spark, sf_dir), "tasks"))
    tasks = P.stg_tasks(P.stg_statements(st), P.stg_importance(P.stg_ratings(ra)))
    return P.dim_task(tasks)


@query("occupation_context", f"""
SELECT {SOC_SQL} AS ONET_SOC_CODE, coalesce(p_name, '') AS OCCUPATION_TITLE,
       coalesce(p_type, '') AS OCCUPATION_DESCRIPTION
FROM lineitem LEFT JOIN part ON p_partkey = l_partkey AND l_linenumber = 1""",
       ids=("S15", "C01"))
def q_occupation_context(spark, sf_dir):
    st, _ra, ctx = _land_catalogue(spark, sf_dir)
    c = ctx.select("ONET_SOC_CODE", F.col("TITLE").alias("OCCUPATION_TITLE"),
                   F.col("DESCRIPTION").alias("OCCUPATION_DESCRIPTION"))
    j = st.select("ONET_SOC_CODE").join(c, "ONET_SOC_CODE", "left")
    return j.select("ONET_SOC_CODE", F.coalesce("OCCUPATION_TITLE", F.lit("")).alias("OCCUPATION_TITLE"),
                    F.coalesce("OCCUPATION_DESCRIPTION", F.lit("")).alias("OCCUPATION_DESCRIPTION"))


def _land_scores(spark, sf_dir):
    """Two scoring runs exported as CSV (quoted rationale with commas and
    quotes), appended to the run table one after the other."""
    root = I.work_dir(spark, "scores")
    d = S.read(spark, sf_dir, "lineitem")
    err = (F.col("l_returnflag") == "R") & (F.col("l_tax") <= 0.03)
    base = d.select(
        F.concat(F.lit(" "), F.col("l_orderkey").cast("string")).alias("TASK_ID"),
        _soc().alias("ONET_SOC_CODE"),
        F.when(~err, (F.col("l_discount") * 10).cast("string")).alias("AI_EXPOSURE_SCORE"),
        F.when(~err, (F.col("l_tax") * 10).cast("string")).alias("AUTOMATION_SCORE"),
        F.when(~err, (1 - F.col("l_discount") * 10).cast("string")).alias("AUGMENTATION_SCORE"),
        F.when(~err, (1 - F.col("l_tax") * 10).cast("string")).alias("CONFIDENCE"),
        F.lit('Deciding factor: "routine", repetitive').alias("RATIONALE"),
        F.when(F.col("l_linestatus") == "F", F.lit("reviewed")).otherwise(F.lit(" ")).alias("REVIEW_STATUS"),
        F.lit("v2").alias("RUBRIC_VERSION"), F.lit("abcd1234").alias("RUBRIC_HASH"), F.lit("p1").alias("PROMPT_VERSION"),
        F.lit("model-x").alias("MODEL_ID"), F.lit("2024-05-01").alias("SCORED_AT"),
        F.when(err, F.lit("timeout")).alias("ERROR_MESSAGE"))
    # the run wrote the closed lines twice, so staging has rows to drop
    base = base.unionByName(base.filter("REVIEW_STATUS = 'reviewed'"))
    runs = os.path.join(root, "runs")
    for run in ("run_a", "run_b"):
        text = base.withColumn("SCORING_RUN_ID", F.lit(run)).select(*[c for c in SCORE_SCHEMA.names])
        path = os.path.join(root, f"csv_{run}")
        I.write_csv(text, path, compression="gzip")
        I.append_run(I.read_delimited(spark, path, SCORE_SCHEMA, keep_corrupt=False, multiline=True), runs)
        remove(spark, path)     # the run table holds its rows
    return spark.read.parquet(runs)


STG_SCORES_SQL = f"""
SELECT CAST(l_orderkey AS BIGINT) AS TASK_ID, {SOC_SQL} AS ONET_SOC_CODE,
       lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS OCC_CODE,
       l_discount * 10 AS AI_EXPOSURE_SCORE, l_tax * 10 AS AUTOMATION_SCORE,
       1 - l_discount * 10 AS AUGMENTATION_SCORE, 1 - l_tax * 10 AS CONFIDENCE,
       'Deciding factor: "routine", repetitive' AS RATIONALE,
       CASE WHEN l_linestatus = 'F' THEN 'reviewed' ELSE 'unreviewed' END AS REVIEW_STATUS,
       'run_b' AS SCORING_RUN_ID, 'v2' AS RUBRIC_VERSION, 'abcd1234' AS RUBRIC_HASH, 'p1' AS PROMPT_VERSION,
       'model-x' AS MODEL_ID
FROM lineitem WHERE NOT (l_returnflag = 'R' AND l_tax <= 0.03)"""


@query("staging_scores", STG_SCORES_SQL, ids=("S08", "S09", "D09", "J11", "P06", "P13", "P14", "W09"))
def q_staging_scores(spark, sf_dir):
    return P.stg_scores(_land_scores(spark, sf_dir), None)


@query("score_summary", f"""
SELECT COUNT(*) AS scored_tasks, COUNT(DISTINCT OCC_CODE) AS occupations,
       {O.ratio(f"SUM({O.units('AI_EXPOSURE_SCORE')})", "COUNT(AI_EXPOSURE_SCORE) * 10000", 3)} AS avg_exposure,
       {O.ratio(f"SUM({O.units('CONFIDENCE')})", "COUNT(CONFIDENCE) * 10000", 3)} AS avg_confidence
FROM ({O.TASKS}) t WHERE AI_EXPOSURE_SCORE IS NOT NULL""", ids=("A15", "A12"))
def q_score_summary(spark, sf_dir):
    t = S.task_statements(spark, sf_dir).filter(F.col("AI_EXPOSURE_SCORE").isNotNull())
    return t.agg(F.count(F.lit(1)).alias("scored_tasks"), F.count_distinct("OCC_CODE").alias("occupations"),
                 exact_ratio(F.sum(units("AI_EXPOSURE_SCORE", 4)), F.count("AI_EXPOSURE_SCORE") * 10000, 3)
                 .alias("avg_exposure"),
                 exact_ratio(F.sum(units("CONFIDENCE", 4)), F.count("CONFIDENCE") * 10000, 3).alias("avg_confidence"))


@query("group_triple", f"""
SELECT O_GROUP, CAST(SUM(TOT_EMP) AS BIGINT) AS TOTAL_EMP,
       {O.ratio(f"SUM(TOT_EMP * {O.units('AI_EXPOSURE')})",
                "SUM(CASE WHEN AI_EXPOSURE IS NOT NULL THEN TOT_EMP ELSE 0 END) * 10000")} AS AI_EXPOSURE,
       {O.ratio("SUM(CASE WHEN AI_EXPOSURE IS NOT NULL THEN TOT_EMP ELSE 0 END)", "SUM(TOT_EMP)", 3, zero='0.0')}
         AS EMP_COVERAGE
FROM ({O.occupation_index_sql()}) i GROUP BY O_GROUP""", ids=("A09", "A05"))
def q_group_triple(spark, sf_dir):
    """Mean, total and coverage per occupation group, with the report's
    rounding (4 digits for the mean, 3 for coverage)."""
    idx = occupation_index_df(spark, sf_dir)
    g = weighted_rollup(idx, ["O_GROUP"], "TOT_EMP", ["AI_EXPOSURE"], coverage_metric="AI_EXPOSURE",
                        digits=4, coverage_digits=3)
    return g.select("O_GROUP", "TOTAL_EMP", "AI_EXPOSURE", "EMP_COVERAGE")


@query("pilot", f"""
SELECT TASK_ID, ONET_SOC_CODE FROM (SELECT {TASK_ID_SQL} AS TASK_ID, CAST(l_partkey AS VARCHAR) AS ONET_SOC_CODE FROM ({ONE_LINE_SQL}) d) w
ORDER BY TASK_ID, ONET_SOC_CODE LIMIT 20""", ids=("T05",))
def q_pilot(spark, sf_dir):
    """First-N pilot of the work-list without repeats of a task: a total order on the task key (file
    order is not stable in Spark), then LIMIT."""
    w = one_line_per_task(spark, sf_dir).select(task_id().alias("TASK_ID"), F.col("l_partkey").cast("string").alias("ONET_SOC_CODE"))
    return w.orderBy("TASK_ID", "ONET_SOC_CODE").limit(20)


@query("vw_occupation_national", f"""
SELECT OCC_CODE, OCC_TITLE, O_GROUP, TOT_EMP, A_MEAN, A_MEDIAN, WAGE_PERCENTILE, WAGE_BAND, EXPOSURE_MODE,
       SCORE_STATUS, AI_EXPOSURE, AUTOMATION, AUGMENTATION, EXPOSURE_CONFIDENCE, WEIGHTED_EXPOSURE, EXPOSURE_RANK,
       IMPORTANCE_WEIGHT_COVERAGE, TASK_COUNT_COVERAGE, PLACEHOLDER_EXPOSURE
FROM ({O.occupation_index_sql()}) i""", ids=("D24", "S12"))
def q_vw_occupation_national(spark, sf_dir):
    return occupation_index_df(spark, sf_dir).drop("rated_task_count", "scored_task_count")


@query("vw_region_occupation", f"""
SELECT GRANULARITY, AREA, AREA_TITLE, STATE, OCC_CODE, p_name AS OCC_TITLE, AREA_OCC_EMP, AI_EXPOSURE, AUTOMATION,
       AUGMENTATION, SCORE_STATUS, EXPOSURE_MODE
FROM ({O.region_drill_sql()}) d JOIN part ON p_partkey = OCC_CODE""", ids=("D25", "D20", "J05"))
def q_vw_region_occupation(spark, sf_dir):
    idx = occupation_index_df(spark, sf_dir)
    d = ix.drill_fact(S.region_slice(spark, sf_dir), idx, "AREA_OCC_EMP", ["GRANULARITY", "AREA", "AREA_TITLE", "STATE"])
    titles = S.base_occupations(spark, sf_dir).select("OCC_CODE", "OCC_TITLE")
    return d.join(titles, "OCC_CODE").select(
        "GRANULARITY", "AREA", "AREA_TITLE", "STATE", "OCC_CODE", "OCC_TITLE", "AREA_OCC_EMP", "AI_EXPOSURE",
        "AUTOMATION", "AUGMENTATION", "SCORE_STATUS", "EXPOSURE_MODE")


@query("vw_industry_occupation", f"""
SELECT NAICS, INDUSTRY_TITLE, OCC_CODE, p_name AS OCC_TITLE, SECTOR_OCC_EMP, AI_EXPOSURE, AUTOMATION, AUGMENTATION,
       SCORE_STATUS, EXPOSURE_MODE
FROM ({O.industry_drill_sql()}) d JOIN part ON p_partkey = OCC_CODE""", ids=("D26", "D18", "J05"))
def q_vw_industry_occupation(spark, sf_dir):
    idx = occupation_index_df(spark, sf_dir)
    d = ix.drill_fact(S.industry_slice(spark, sf_dir), idx, "SECTOR_OCC_EMP", ["NAICS", "INDUSTRY_TITLE"])
    titles = S.base_occupations(spark, sf_dir).select("OCC_CODE", "OCC_TITLE")
    return d.join(titles, "OCC_CODE").select("NAICS", "INDUSTRY_TITLE", "OCC_CODE", "OCC_TITLE", "SECTOR_OCC_EMP",
                                             "AI_EXPOSURE", "AUTOMATION", "AUGMENTATION", "SCORE_STATUS", "EXPOSURE_MODE")


@query("dim_industry", """
SELECT NAICS, arg_max(INDUSTRY_TITLE, y) AS INDUSTRY_TITLE FROM (
  SELECT DISTINCT year(o_orderdate) AS y, c_mktsegment AS NAICS,
         lower(c_mktsegment) || ' (' || year(o_orderdate) || ')' AS INDUSTRY_TITLE
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment IS NOT NULL)
GROUP BY NAICS""", ids=("D14", "W05"))
def q_dim_industry(spark, sf_dir):
    """One row per industry, titled as in its newest year."""
    o = S.read(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("DATA_YEAR"))
    c = S.read(spark, sf_dir, "customer").filter("c_mktsegment IS NOT NULL").select("c_custkey", F.col("c_mktsegment").alias("NAICS"))
    seen = o.join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        "DATA_YEAR", "NAICS", F.format_string("%s (%d)", F.lower("NAICS"), F.col("DATA_YEAR")).alias("INDUSTRY_TITLE")).distinct()
    return REL.latest_per_key(seen, ["NAICS"], [F.col("DATA_YEAR").desc(), F.col("INDUSTRY_TITLE")], ["INDUSTRY_TITLE"])


def _land_oews(spark, sf_dir, root=None):
    """Line items exported as 32-column OEWS-shaped text, one folder per
    year, with thousands separators, '#' wages and the '00-0000' total row;
    landed with one glob read and the year taken from the path."""
    from indexkit.functions.clean import OEWS_NULL_TOKENS
    from indexkit.schemas import OEWS_COLUMNS, OEWS_SCHEMA
    root = root or I.work_dir(spark, "oews")
    li = S.read(spark, sf_dir, "lineitem")
    o = S.read(spark, sf_dir, "orders")
    c = S.read(spark, sf_dir, "customer")
    # lines are joined last: the larger side is shuffled once
    j = li.join(o.join(c, F.col("o_custkey") == c.c_custkey), li.l_orderkey == o.o_orderkey)
    vals = {
        "AREA": F.col("c_nationkey").cast("string"), "AREA_TITLE": F.lit("area"),
        "AREA_TYPE": F.left(F.col("o_orderpriority"), F.lit(1)), "PRIM_STATE": F.lit("XX"),
        "NAICS": F.col("c_mktsegment"), "NAICS_TITLE": F.lower("c_mktsegment"),
        "I_GROUP": F.when(F.col("o_orderstatus") == "F", F.lit("Cross-Industry")).otherwise(F.lit("sector")),
        "OWN_CODE": F.when(F.col("l_returnflag") == "N", F.lit("1235")).otherwise(F.lit("5")),
        "OCC_CODE": F.when(F.col("l_partkey") == 0, F.lit("00-0000"))
                     .otherwise(F.lpad(F.col("l_partkey").cast("string"), 7, "0")),
        "OCC_TITLE": F.lit("title, with comma"),
        "O_GROUP": F.when(F.col("l_linestatus") == "O", F.lit("broad")).otherwise(F.lit("Detailed")),
        "TOT_EMP": F.format_number(F.col("l_quantity") * 1000, 0),
        "A_MEDIAN": F.when(F.col("l_returnflag") == "R", F.lit("#")).otherwise(F.format_number("l_extendedprice", 2)),
    }
    text = j.select(*[(vals[n] if n in vals else F.lit("*")).alias(n) for n in OEWS_COLUMNS],
                    F.year("o_orderdate").alias("yr"))
    with open_files(spark):
        text.write.mode("overwrite").partitionBy("yr").option("header", True).option("compression", "gzip").csv(root)
    raw = I.read_delimited(spark, os.path.join(root, "yr=*", "*.csv.gz"), OEWS_SCHEMA, tokens=OEWS_NULL_TOKENS,
                           keep_corrupt=False)
    return I.tag_year_from_file(raw, source="file_path", pattern=r"yr=(\d{4})")


@query("staging_oews", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS DATA_YEAR, lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS OCC_CODE,
       left(o_orderpriority, 1) AS AREA_TYPE,
       CASE WHEN o_orderstatus = 'F' THEN 'cross-industry' ELSE 'sector' END AS I_GROUP,
       CASE WHEN l_returnflag = 'N' THEN '1235' ELSE '5' END AS OWN_CODE,
       CASE WHEN l_linestatus = 'O' THEN 'broad' ELSE 'detailed' END AS O_GROUP,
       CAST(c_nationkey AS VARCHAR) AS AREA, c_mktsegment AS NAICS,
       CAST(l_quantity * 1000 AS BIGINT) AS TOT_EMP,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS A_MEDIAN, 'title, with comma' AS OCC_TITLE,
       'area' AS AREA_TITLE, 'XX' AS STATE, lower(c_mktsegment) AS INDUSTRY_TITLE,
       """ + ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in ("A_MEAN", "H_MEAN", "H_MEDIAN", "A_PCT10", "A_PCT25", "A_PCT75", "A_PCT90")) + """
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE l_partkey <> 0""", ids=("D01", "S01", "S03", "S04", "P01", "P04", "P09", "U03"))
def q_staging_oews(spark, sf_dir):
    return P.stg_oews(_land_oews(spark, sf_dir))


SLICE_COLUMNS = ["OCC_CODE", "OCC_TITLE", "O_GROUP", "AREA", "AREA_TITLE", "AREA_TYPE", "STATE", "NAICS", "INDUSTRY_TITLE",
                 "I_GROUP", "OWN_CODE", "TOT_EMP", "A_MEDIAN"]


@query("newest_slice", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS DATA_YEAR, lpad(CAST(l_partkey AS VARCHAR), 7, '0') AS OCC_CODE, 'title, with comma' AS OCC_TITLE,
       CASE WHEN l_linestatus = 'O' THEN 'broad' ELSE 'detailed' END AS O_GROUP, CAST(c_nationkey AS VARCHAR) AS AREA,
       'area' AS AREA_TITLE, left(o_orderpriority, 1) AS AREA_TYPE, 'XX' AS STATE, c_mktsegment AS NAICS,
       lower(c_mktsegment) AS INDUSTRY_TITLE, CASE WHEN o_orderstatus = 'F' THEN 'cross-industry' ELSE 'sector' END AS I_GROUP,
       CASE WHEN l_returnflag = 'N' THEN '1235' ELSE '5' END AS OWN_CODE, CAST(l_quantity * 1000 AS BIGINT) AS TOT_EMP,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice END AS A_MEDIAN
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE l_partkey <> 0 AND year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey WHERE l_partkey <> 0)""", ids=("S16", "P11"))
def q_newest_slice(spark, sf_dir):
    """13 columns of the newest year of the staged table, which is partitioned
    by year on disk; the year comes from the folder listing."""
    root = I.work_dir(spark, "staged")
    staged = P.stg_oews(_land_oews(spark, sf_dir))
    with open_files(spark):
        staged.write.partitionBy("DATA_YEAR").parquet(root)
    return REL.newest_partition(spark, root, "DATA_YEAR", SLICE_COLUMNS)
