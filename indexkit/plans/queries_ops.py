"""Registered queries: cleaning, slices, joins, bands, rollups, ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexkit.functions import clean as C
from indexkit.functions.bands import WAGE_BANDS, band_case, cut_band
from indexkit.operators import ranking as R
from indexkit.operators import relational as REL
from indexkit.operators import rollup as RU
from indexkit.operators.quality import range_guard, violations
from indexkit.plans import oracle as O
from indexkit.plans import standins as S
from indexkit.plans.queries import occupation_index_df
from indexkit.plans.registry import query

PAT = C.NUMERIC_PATTERN


def numtext_sql(x: str) -> str:
    t = f"replace(trim({x}), ',', '')"
    return f"(CASE WHEN regexp_matches({t}, '{PAT}') THEN {t} END)"


def parse_number_sql(x: str) -> str:
    return f"TRY_CAST({numtext_sql(x)} AS DOUBLE)"


def parse_int_sql(x: str) -> str:
    return f"TRY_CAST(TRY_CAST({numtext_sql(x)} AS DECIMAL(38,0)) AS BIGINT)"


# ------------------------------------------------------------ cleaning

@query("clean_parse", f"""
SELECT c_custkey, lower(trim(c_mktsegment)) AS segment, left(trim(c_name), 8) AS name_code,
       {parse_int_sql("substr(c_name, 10, 20)")} AS name_number,
       {parse_number_sql("format('{:,.2f}', c_acctbal)")} AS acctbal,
       {parse_int_sql("format('{:,.2f}', c_acctbal)")} AS acctbal_int,
       {parse_number_sql("c_name")} AS bad_number,
       coalesce(nullif(trim(CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE ' ' END), ''), 'unknown')
         AS segment_or_default
FROM customer""", ids=("P01", "P02", "P04", "P05", "P06"))
def q_clean_parse(spark, sf_dir):
    c = S.read(spark, sf_dir, "customer")
    return c.select(
        "c_custkey",
        C.lower_trim("c_mktsegment").alias("segment"),
        C.standardize_code("c_name", 8).alias("name_code"),
        C.parse_int(F.substring("c_name", 10, 20)).alias("name_number"),
        C.parse_number(F.format_number("c_acctbal", 2)).alias("acctbal"),
        C.parse_int(F.format_number("c_acctbal", 2)).alias("acctbal_int"),
        C.parse_number("c_name").alias("bad_number"),
        C.default_if_blank(F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).otherwise(F.lit(" ")),
                           "unknown").alias("segment_or_default"),
    )


@query("label_case", """
SELECT o_orderkey, left(o_orderpriority, 1) AS AREA_TYPE,
       CASE left(o_orderpriority, 1) WHEN '1' THEN 'National' WHEN '2' THEN 'State'
            WHEN '3' THEN 'Territory' WHEN '4' THEN 'Metropolitan' WHEN '6' THEN 'Nonmetropolitan'
            ELSE 'Other' END AS AREA_TYPE_LABEL,
       CASE left(o_orderpriority, 1) WHEN '2' THEN 'State' WHEN '4' THEN 'Metropolitan'
            WHEN '6' THEN 'Nonmetropolitan' END AS GRANULARITY,
       'REGION ' || CASE left(o_orderpriority, 1) WHEN '2' THEN 'State' WHEN '4' THEN 'Metropolitan'
            WHEN '6' THEN 'Nonmetropolitan' END AS SLICE_NAME
FROM orders""", ids=("P07", "P20"))
def q_label_case(spark, sf_dir):
    o = S.read(spark, sf_dir, "orders")
    at = F.left(F.col("o_orderpriority"), F.lit(1))
    gran = C.label_case(at, C.GRANULARITY_LABELS)
    return o.select("o_orderkey", at.alias("AREA_TYPE"),
                    C.label_case(at, C.AREA_TYPE_LABELS, C.AREA_TYPE_OTHER).alias("AREA_TYPE_LABEL"),
                    gran.alias("GRANULARITY"),
                    F.concat(F.lit("REGION "), gran).alias("SLICE_NAME"))


@query("major_group", """
SELECT CASE WHEN length(CAST(p_partkey AS VARCHAR)) >= 2 THEN substr(CAST(p_partkey AS VARCHAR), 1, 2)
            ELSE '??' END AS MAJOR_GROUP, COUNT(*) AS n
FROM part GROUP BY 1""", ids=("P03",))
def q_major_group(spark, sf_dir):
    p = S.read(spark, sf_dir, "part")
    return p.groupBy(C.major_group(F.col("p_partkey").cast("string")).alias("MAJOR_GROUP")).agg(
        F.count(F.lit(1)).alias("n"))


@query("null_tokens", """
SELECT o_orderkey,
       CASE WHEN trim(o_orderpriority) IN ('', '4-NOT SPECIFIED', '5-LOW') THEN NULL ELSE trim(o_orderpriority) END
         AS priority,
       CASE WHEN trim(o_orderstatus) IN ('', 'P') THEN NULL ELSE trim(o_orderstatus) END AS status
FROM orders""", ids=("S03",))
def q_null_tokens(spark, sf_dir):
    o = S.read(spark, sf_dir, "orders")
    return o.select("o_orderkey", C.null_tokens("o_orderpriority", ("4-NOT SPECIFIED", "5-LOW")).alias("priority"),
                    C.null_tokens("o_orderstatus", ("P",)).alias("status"))


@query("range_guard", """
SELECT event_id, event_type, value FROM events WHERE value BETWEEN 0 AND 50""", ids=("P13",))
def q_range_guard(spark, sf_dir):
    e = S.read(spark, sf_dir, "events")
    return range_guard(e, ["value"], 0, 50).select("event_id", "event_type", "value")


@query("violations", """
SELECT event_type, COUNT(*) AS violations FROM events WHERE NOT (value BETWEEN 0 AND 50)
GROUP BY event_type""", ids=("P21",))
def q_violations(spark, sf_dir):
    e = S.read(spark, sf_dir, "events")
    return violations(e, "value", 0, 50).groupBy("event_type").agg(F.count(F.lit(1)).alias("violations"))


@query("error_filter", """
SELECT event_id, event_type FROM events
WHERE (CASE WHEN event_type = 'error' THEN props END) IS NULL
   OR trim(CASE WHEN event_type = 'error' THEN props END) = ''""", ids=("P14",))
def q_error_filter(spark, sf_dir):
    e = S.read(spark, sf_dir, "events").withColumn(
        "ERROR_MESSAGE", F.when(F.col("event_type") == "error", F.col("props")))
    return e.filter(C.is_blank("ERROR_MESSAGE")).select("event_id", "event_type")


# ------------------------------------------------------------ slices

OEWS_SQL = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS DATA_YEAR, left(o_orderpriority, 1) AS AREA_TYPE,
       CASE WHEN o_orderstatus = 'F' THEN 'cross-industry' ELSE 'sector' END AS I_GROUP,
       CASE WHEN l_returnflag = 'N' THEN '1235' ELSE '5' END AS OWN_CODE,
       CASE WHEN l_linestatus = 'O' THEN 'broad' ELSE 'detailed' END AS O_GROUP,
       c_nationkey AS AREA, c_mktsegment AS NAICS, l_partkey AS OCC_CODE,
       CAST(l_quantity AS BIGINT) AS TOT_EMP, l_extendedprice AS A_MEDIAN
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""

LATEST = f"(SELECT * FROM ({OEWS_SQL}) b WHERE DATA_YEAR = (SELECT max(DATA_YEAR) FROM ({OEWS_SQL}) m))"


@query("latest_slice", f"""
SELECT DATA_YEAR, AREA_TYPE, COUNT(*) AS n, CAST(SUM(TOT_EMP) AS BIGINT) AS emp FROM {LATEST} l
GROUP BY DATA_YEAR, AREA_TYPE""", ids=("P11",))
def q_latest_slice(spark, sf_dir):
    d = S.newest_oews(spark, sf_dir)
    return d.groupBy("DATA_YEAR", "AREA_TYPE").agg(F.count(F.lit(1)).alias("n"),
                                                   F.sum("TOT_EMP").alias("emp"))


@query("slice_national", f"""
SELECT OCC_CODE, CAST(SUM(TOT_EMP) AS BIGINT) AS TOT_EMP, MAX(A_MEDIAN) AS A_MEDIAN FROM {LATEST} l
WHERE AREA_TYPE = '1' AND I_GROUP = 'cross-industry' AND OWN_CODE = '1235' AND O_GROUP = 'detailed'
  AND OCC_CODE IS NOT NULL
GROUP BY OCC_CODE""", ids=("P12", "P09", "D02"))
def q_slice_national(spark, sf_dir):
    d = S.newest_oews(spark, sf_dir)
    d = REL.slice_where(d, AREA_TYPE="1", I_GROUP="cross-industry", OWN_CODE="1235", O_GROUP="detailed")
    return d.filter(F.col("OCC_CODE").isNotNull()).groupBy("OCC_CODE").agg(
        F.sum("TOT_EMP").alias("TOT_EMP"), F.max("A_MEDIAN").alias("A_MEDIAN"))


@query("slice_industry", f"""
SELECT NAICS, OCC_CODE, CAST(SUM(TOT_EMP) AS BIGINT) AS TOT_EMP FROM {LATEST} l
WHERE AREA_TYPE = '1' AND I_GROUP = 'sector' AND OWN_CODE = '5' AND O_GROUP = 'detailed'
GROUP BY NAICS, OCC_CODE""", ids=("P12", "D03"))
def q_slice_industry(spark, sf_dir):
    d = S.newest_oews(spark, sf_dir)
    d = REL.slice_where(d, AREA_TYPE="1", I_GROUP="sector", OWN_CODE="5", O_GROUP="detailed")
    return d.groupBy("NAICS", "OCC_CODE").agg(F.sum("TOT_EMP").alias("TOT_EMP"))


@query("slice_region", f"""
SELECT CASE AREA_TYPE WHEN '2' THEN 'State' WHEN '4' THEN 'Metropolitan' WHEN '6' THEN 'Nonmetropolitan' END
         AS GRANULARITY, AREA, OCC_CODE, CAST(SUM(TOT_EMP) AS BIGINT) AS TOT_EMP FROM {LATEST} l
WHERE AREA_TYPE IN ('2', '4', '6') AND I_GROUP = 'cross-industry' AND OWN_CODE = '1235'
  AND O_GROUP = 'detailed'
GROUP BY 1, AREA, OCC_CODE""", ids=("P12", "P07", "D04"))
def q_slice_region(spark, sf_dir):
    d = S.newest_oews(spark, sf_dir)
    d = REL.slice_where(d, AREA_TYPE=["2", "4", "6"], I_GROUP="cross-industry", OWN_CODE="1235",
                        O_GROUP="detailed")
    d = d.withColumn("GRANULARITY", C.label_case("AREA_TYPE", C.GRANULARITY_LABELS))
    return d.groupBy("GRANULARITY", "AREA", "OCC_CODE").agg(F.sum("TOT_EMP").alias("TOT_EMP"))


# ------------------------------------------------------------ task joins

LI_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus", "l_shipdate"]

DEDUP_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {', '.join(c + ' NULLS FIRST' for c in LI_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1"""

def _dedup(spark, sf_dir):
    li = S.read(spark, sf_dir, "lineitem")
    return REL.dedupe_one(li, ["l_orderkey", "l_linenumber"], LI_ORDER)


def _tasks(spark, sf_dir, how: str, scored: bool = False) -> DataFrame:
    """Statements joined with their importance (and scores) on the task key."""
    keys = list(S.TASK_KEYS)
    im = S.importance(spark, sf_dir).withColumn("IMPORTANCE_NORM", C.normalize("IMPORTANCE_RAW", *S.NORM_RANGE))
    out = S.statements(spark, sf_dir).join(im, keys, how)
    return out.join(S.task_scores(spark, sf_dir), keys, "left") if scored else out


@query("dedupe_one", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount FROM ({DEDUP_SQL}) d""", ids=("W09",))
def q_dedupe_one(spark, sf_dir):
    return _dedup(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount")


@query("tasks_left", f"""
SELECT l_orderkey AS TASK_ID, l_linenumber AS TASK_LINE, l_partkey AS OCC_CODE,
       CASE WHEN {O.RATED} THEN l_quantity END AS IMPORTANCE_RAW,
       CASE WHEN {O.RATED} THEN (l_quantity - 1) / 49.0 END AS IMPORTANCE_NORM
FROM lineitem""", ids=("J01", "P08", "D08"))
def q_tasks_left(spark, sf_dir):
    return _tasks(spark, sf_dir, "left").select("TASK_ID", "TASK_LINE", "OCC_CODE", "IMPORTANCE_RAW", "IMPORTANCE_NORM")


@query("tasks_inner", f"""
SELECT l_orderkey AS TASK_ID, l_linenumber AS TASK_LINE, l_partkey AS OCC_CODE, l_quantity AS IMPORTANCE_RAW
FROM lineitem WHERE {O.RATED}""", ids=("J02",))
def q_tasks_inner(spark, sf_dir):
    return _tasks(spark, sf_dir, "inner").select("TASK_ID", "TASK_LINE", "OCC_CODE", "IMPORTANCE_RAW")


@query("tasks_scored", f"""
SELECT l_orderkey AS TASK_ID, l_linenumber AS TASK_LINE, l_partkey AS OCC_CODE, l_quantity AS IMPORTANCE_RAW,
       CASE WHEN {O.SCORED} THEN l_discount * 10 END AS AI_EXPOSURE_SCORE
FROM lineitem WHERE {O.RATED}""", ids=("J03",))
def q_tasks_scored(spark, sf_dir):
    return _tasks(spark, sf_dir, "inner", scored=True).select(
        "TASK_ID", "TASK_LINE", "OCC_CODE", "IMPORTANCE_RAW", "AI_EXPOSURE_SCORE")


# ------------------------------------------------------------ key sets

@query("semi_match", """
SELECT p_partkey, p_name FROM part WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)""",
       ids=("J08",))
def q_semi_match(spark, sf_dir):
    p = S.read(spark, sf_dir, "part").select("p_partkey", "p_name")
    li = S.read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("p_partkey"))
    return REL.semi(p, li, "p_partkey")


@query("missing_ids", """
SELECT COUNT(DISTINCT k) AS listed, COUNT(DISTINCT CASE WHEN k IN (SELECT c_custkey FROM customer) THEN k END) AS found,
       COUNT(DISTINCT CASE WHEN k NOT IN (SELECT c_custkey FROM customer) THEN k END) AS missing
FROM (SELECT o_custkey + l_linenumber AS k FROM orders JOIN lineitem ON l_orderkey = o_orderkey)""", ids=("J16",))
def q_missing_ids(spark, sf_dir):
    """How many of a list of ids exist, and how many don't."""
    li = S.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    o = S.read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    wanted = o.join(li, F.col("o_orderkey") == F.col("l_orderkey")).select((F.col("o_custkey") + F.col("l_linenumber")).alias("k"))
    known = S.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return REL.membership(wanted, known, "k")


@query("anti_left", """
SELECT DISTINCT c_custkey FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
       ids=("J09", "J17"))
def q_anti_left(spark, sf_dir):
    c = S.read(spark, sf_dir, "customer").select("c_custkey")
    o = S.read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return REL.anti(c, o, "c_custkey").distinct()


@query("anti_right", """
SELECT 'rated' AS side, k FROM (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'R')
WHERE k NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)
UNION ALL
SELECT 'part', p_partkey FROM part
WHERE p_size > 10 AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_linestatus = 'F' AND l_returnflag = 'R')""",
       ids=("J09",))
def q_anti_right(spark, sf_dir):
    """Keys on one side only, both ways: rated parts and large parts."""
    p = S.read(spark, sf_dir, "part").filter("p_size > 10").select(F.col("p_partkey").alias("k"))
    rated = S.importance(spark, sf_dir).select(F.col("OCC_CODE").alias("k"))
    only_rated, only_part = REL.key_diff(rated, p, "k")
    return only_rated.select(F.lit("rated").alias("side"), "k").unionByName(only_part.select(F.lit("part").alias("side"), "k"))


@query("intersect_keys", """
SELECT l_suppkey AS s_suppkey FROM lineitem INTERSECT SELECT s_suppkey FROM supplier""", ids=("U04",))
def q_intersect_keys(spark, sf_dir):
    s = S.read(spark, sf_dir, "supplier").select("s_suppkey")
    li = S.read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"))
    return li.intersect(s)


@query("except_keys", """
SELECT 'left' AS side, k FROM (SELECT c_custkey AS k FROM customer
                              EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
UNION ALL
SELECT 'right', k FROM (SELECT o_custkey AS k FROM orders WHERE o_orderpriority = '1-URGENT'
                        EXCEPT SELECT c_custkey FROM customer WHERE c_acctbal > 0)""", ids=("U05",))
def q_except_keys(spark, sf_dir):
    c = S.read(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "k")
    o = S.read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("k"))
    left, right = c.select("k").subtract(o), o.subtract(c.filter("c_acctbal > 0").select("k"))
    return left.select(F.lit("left").alias("side"), "k").unionByName(right.select(F.lit("right").alias("side"), "k"))


# ------------------------------------------------------------ bands

PART_PCT_SQL = """
SELECT p_partkey, p_retailprice, PERCENT_RANK() OVER (ORDER BY p_retailprice) AS pct,
       (RANK() OVER (ORDER BY p_retailprice) + (COUNT(*) OVER (PARTITION BY p_retailprice) - 1) / 2.0)
         / COUNT(*) OVER () AS avg_pct
FROM part"""


@query("band_join", f"""
SELECT p.p_partkey, p.pct, b.WAGE_BAND
FROM ({PART_PCT_SQL}) p
LEFT JOIN (VALUES ('Low', 0.00, 0.3333), ('Middle', 0.3333, 0.6667), ('High', 0.6667, 1.01)) b(WAGE_BAND, lo, hi)
  ON p.pct >= b.lo AND p.pct < b.hi""", ids=("J06", "S13", "D15"))
def q_band_join(spark, sf_dir):
    p = S.read(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    p = R.rank_scaled(p, "p_retailprice", "pct", kind="percent_rank", scan=True)
    return REL.band_join(p, "pct", WAGE_BANDS).select("p_partkey", "pct", "WAGE_BAND")


@query("band_case", f"""
SELECT p_partkey,
       CASE WHEN pct >= 0.0 AND pct < 0.3333 THEN 'Low' WHEN pct >= 0.3333 AND pct < 0.6667 THEN 'Middle'
            WHEN pct >= 0.6667 AND pct < 1.01 THEN 'High' END AS WAGE_BAND,
       CASE WHEN pct IS NULL THEN NULL WHEN pct < 0.3333 THEN 'Low' WHEN pct < 0.6667 THEN 'Mid'
            ELSE 'High' END AS SCORE_BAND,
       CASE WHEN avg_pct IS NULL THEN NULL WHEN avg_pct < 1.0 / 3 THEN 'Low' WHEN avg_pct < 2.0 / 3 THEN 'Middle'
            ELSE 'High' END AS THIRDS_BAND
FROM ({PART_PCT_SQL}) p""", ids=("P15", "P16"))
def q_band_case(spark, sf_dir):
    p = S.read(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    p = R.rank_many(p, "p_retailprice", {"pct": {"kind": "percent_rank"}, "avg_pct": {"kind": "average_share"}}, scan=True)
    return p.select("p_partkey", band_case("pct").alias("WAGE_BAND"),
                    cut_band("pct").alias("SCORE_BAND"),
                    cut_band("avg_pct", (1.0 / 3, 2.0 / 3), ("Low", "Middle", "High")).alias("THIRDS_BAND"))


# ------------------------------------------------------------ rollups

@query("placeholder_index", f"""
SELECT OCC_CODE, COALESCE({O.ratio("SUM(CAST(IMPORTANCE_RAW AS BIGINT)) - COUNT(IMPORTANCE_RAW)",
                                    "COUNT(IMPORTANCE_RAW) * 49")}, 0.0) AS AI_EXPOSURE,
       COUNT(*) AS task_count, COUNT(IMPORTANCE_RAW) AS rated_task_count,
       'PLACEHOLDER_ONET_IMPORTANCE_PROXY' AS SCORE_SOURCE
FROM ({O.TASKS}) t GROUP BY OCC_CODE""", ids=("A01", "D10"))
def q_placeholder_index(spark, sf_dir):
    return RU.placeholder_index(S.task_statements(spark, sf_dir), weight_scale=S.WEIGHT_SCALE,
                                norm_range=S.NORM_RANGE)


def _wm_sql(w: str) -> str:
    w = f"({w})"
    u = lambda e: O.units(e, 4)
    return f"""
SELECT OCC_CODE,
       {O.ratio(f"SUM({w} * {u('AI_EXPOSURE_SCORE')})",
                f"SUM(CASE WHEN AI_EXPOSURE_SCORE IS NOT NULL THEN {w} ELSE 0 END) * 10000")} AS occ_exposure,
       {O.ratio(f"SUM({w} * {u('AUTOMATION_SCORE')})",
                f"SUM(CASE WHEN AUTOMATION_SCORE IS NOT NULL THEN {w} ELSE 0 END) * 10000")} AS occ_automation,
       {O.ratio(f"SUM({w} * {u('AUGMENTATION_SCORE')})",
                f"SUM(CASE WHEN AUGMENTATION_SCORE IS NOT NULL THEN {w} ELSE 0 END) * 10000")} AS occ_augmentation,
       {O.ratio(f"SUM({u('CONFIDENCE')})", "COUNT(CONFIDENCE) * 10000")} AS occ_confidence,
       {O.ratio("COUNT(AI_EXPOSURE_SCORE)", "COUNT(*)", zero='0.0')} AS task_count_coverage,
       {O.ratio(f"SUM(CASE WHEN AI_EXPOSURE_SCORE IS NOT NULL THEN {w} ELSE 0 END)", f"SUM({w})",
                zero='0.0')} AS importance_weight_coverage
FROM ({O.TASKS}) t WHERE IMPORTANCE_RAW IS NOT NULL GROUP BY OCC_CODE"""


@query("weighted_mean", _wm_sql("CAST(IMPORTANCE_RAW AS BIGINT)"), ids=("A02", "A03", "A04"))
def q_weighted_mean(spark, sf_dir):
    t = S.task_statements(spark, sf_dir).filter(F.col("IMPORTANCE_RAW").isNotNull())
    r = RU.task_rollup(t, weight_scale=S.WEIGHT_SCALE, norm_range=S.NORM_RANGE)
    from indexkit.functions.numeric import div0
    return r.select("OCC_CODE", F.col("occ_AI_EXPOSURE_SCORE").alias("occ_exposure"),
                    F.col("occ_AUTOMATION_SCORE").alias("occ_automation"),
                    F.col("occ_AUGMENTATION_SCORE").alias("occ_augmentation"), "occ_confidence",
                    div0("scored_task_count", "rated_task_count").alias("task_count_coverage"),
                    div0("imp_scored_u", "imp_total_u").alias("importance_weight_coverage"))


@query("weight_sensitivity", f"""
WITH a AS ({_wm_sql("CAST(IMPORTANCE_RAW AS BIGINT)")}), b AS ({_wm_sql("CAST(IMPORTANCE_RAW AS BIGINT) - 1")})
SELECT {O.ratio("SUM(abs(CAST(ROUND(a.occ_exposure * 10000) AS BIGINT) - CAST(ROUND(b.occ_exposure * 10000) AS BIGINT)))",
                "COUNT(*) * 10000", 6)} AS mean_abs_diff, COUNT(*) AS n
FROM a JOIN b ON a.OCC_CODE = b.OCC_CODE
WHERE a.occ_exposure IS NOT NULL AND b.occ_exposure IS NOT NULL""", ids=("A28",))
def q_weight_sensitivity(spark, sf_dir):
    t = S.task_statements(spark, sf_dir).filter(F.col("IMPORTANCE_RAW").isNotNull())
    raw = RU.task_rollup(t, weight_scale=0, norm_range=S.NORM_RANGE)
    normed = RU.task_rollup(t.withColumn("IMPORTANCE_RAW", F.col("IMPORTANCE_RAW") - 1),
                            weight_scale=0, norm_range=S.NORM_RANGE)
    return RU.mean_abs_diff(raw, normed, "OCC_CODE", "occ_AI_EXPOSURE_SCORE", "occ_AI_EXPOSURE_SCORE")


IDX = f"({O.occupation_index_sql()})"


@query("band_ratio", f"""
SELECT WAGE_BAND, COUNT(*) AS occupations, CAST(SUM(TOT_EMP) AS BIGINT) AS total_employment,
       {O.ratio(f"SUM({O.units('AI_EXPOSURE', 4)} * TOT_EMP)", "SUM(TOT_EMP) * 10000")} AS emp_weighted_exposure
FROM {IDX} i GROUP BY WAGE_BAND""", ids=("A08", "T03"))
def q_band_ratio(spark, sf_dir):
    idx = occupation_index_df(spark, sf_dir)
    return RU.ratio_of_sums(idx, ["WAGE_BAND"], "AI_EXPOSURE", "TOT_EMP", order_by="WAGE_PERCENTILE") \
        .orderBy("_ord").drop("_ord")


@query("top_n", f"""
SELECT OCC_CODE, OCC_TITLE, TOT_EMP, A_MEDIAN, WAGE_BAND, AI_EXPOSURE, WEIGHTED_EXPOSURE, EXPOSURE_RANK
FROM {IDX} i ORDER BY AI_EXPOSURE DESC NULLS LAST, OCC_CODE LIMIT 15""", ids=("T01",))
def q_top_n(spark, sf_dir):
    idx = occupation_index_df(spark, sf_dir)
    return R.top_n(idx, 15, [F.col("AI_EXPOSURE").desc_nulls_last()], ["OCC_CODE"]).select(
        "OCC_CODE", "OCC_TITLE", "TOT_EMP", "A_MEDIAN", "WAGE_BAND", "AI_EXPOSURE",
        "WEIGHTED_EXPOSURE", "EXPOSURE_RANK")


@query("search_facet", f"""
SELECT OCC_CODE, OCC_TITLE, WAGE_BAND, AI_EXPOSURE FROM {IDX} i
WHERE contains(lower(OCC_TITLE), 'ring') AND WAGE_BAND = 'High'""", ids=("P22",))
def q_search_facet(spark, sf_dir):
    idx = occupation_index_df(spark, sf_dir)
    return idx.filter(F.lower("OCC_TITLE").contains("ring") & (F.col("WAGE_BAND") == "High")).select(
        "OCC_CODE", "OCC_TITLE", "WAGE_BAND", "AI_EXPOSURE")


# ------------------------------------------------------------ latest / newest

@query("latest_per_key", """
SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""", ids=("W05", "D13", "D14"))
def q_latest_per_key(spark, sf_dir):
    o = S.read(spark, sf_dir, "orders")
    return REL.latest_per_key(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey")],
                              ["o_orderkey", "o_orderpriority", "o_totalprice"])


@query("newest_row", """
SELECT event_id, event_type, value FROM events ORDER BY ts DESC, event_id LIMIT 1""", ids=("W06", "T04"))
def q_newest_row(spark, sf_dir):
    e = S.read(spark, sf_dir, "events")
    return REL.newest_row(e, [F.col("ts").desc(), F.col("event_id")]).select("event_id", "event_type", "value")


RUNS_SQL = "SELECT event_type AS SCORING_RUN_ID, ts AS LOADED_AT FROM events"
APPROVED_SQL = "SELECT event_type AS SCORING_RUN_ID, ts AS APPROVED_AT FROM events WHERE value > 99"


@query("choose_run", f"""
SELECT COALESCE(
  (SELECT SCORING_RUN_ID FROM ({APPROVED_SQL}) a ORDER BY APPROVED_AT DESC NULLS LAST, SCORING_RUN_ID DESC LIMIT 1),
  (SELECT SCORING_RUN_ID FROM ({RUNS_SQL}) r GROUP BY SCORING_RUN_ID
   ORDER BY max(LOADED_AT) DESC NULLS LAST, SCORING_RUN_ID DESC LIMIT 1)) AS SCORING_RUN_ID""", ids=("J11",))
def q_choose_run(spark, sf_dir):
    e = S.read(spark, sf_dir, "events")
    runs = e.select(F.col("event_type").alias("SCORING_RUN_ID"), F.col("ts").alias("LOADED_AT"))
    # approvals are rare: events above 99 stand in for the approval rows
    appr = e.filter(F.col("value") > 99).select(F.col("event_type").alias("SCORING_RUN_ID"),
                                                F.col("ts").alias("APPROVED_AT"))
    return REL.choose_run(runs, appr)


# ------------------------------------------------------------ ranks

@query("rank_nulls", f"""
SELECT TASK_ID, TASK_LINE, AI_EXPOSURE_SCORE,
       RANK() OVER (ORDER BY AI_EXPOSURE_SCORE DESC NULLS FIRST) AS rank_nulls_first,
       RANK() OVER (ORDER BY AI_EXPOSURE_SCORE DESC NULLS LAST) AS rank_nulls_last,
       RANK() OVER (ORDER BY AI_EXPOSURE_SCORE ASC NULLS FIRST) AS rank_asc
FROM ({O.TASKS}) t""", ids=("W02", "W03"))
def q_rank_nulls(spark, sf_dir):
    t = S.task_statements(spark, sf_dir).select("TASK_ID", "TASK_LINE", "AI_EXPOSURE_SCORE")
    return R.rank_many(t, "AI_EXPOSURE_SCORE", {
        "rank_nulls_first": {"descending": True, "nulls_first": True},
        "rank_nulls_last": {"descending": True, "nulls_first": False},
        "rank_asc": {"nulls_first": True}})


@query("percent_rank_scaled", """
SELECT l_orderkey, l_linenumber, l_extendedprice,
       PERCENT_RANK() OVER (ORDER BY l_extendedprice) AS pct
FROM lineitem""", ids=("W01",))
def q_percent_rank_scaled(spark, sf_dir):
    li = S.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return R.percent_rank_scaled(li, "l_extendedprice", "pct", scan=True)


@query("average_rank", """
SELECT l_orderkey, l_linenumber, l_quantity,
       RANK() OVER (ORDER BY l_quantity) + (COUNT(*) OVER (PARTITION BY l_quantity) - 1) / 2.0 AS avg_rank
FROM lineitem""", ids=("W07",))
def q_average_rank(spark, sf_dir):
    li = S.read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return R.average_rank_scaled(li, "l_quantity", "avg_rank", scan=True)


@query("pct_rank_average", """
SELECT p_partkey, (RANK() OVER (ORDER BY p_size) + (COUNT(*) OVER (PARTITION BY p_size) - 1) / 2.0)
                  / COUNT(*) OVER () AS pct_avg
FROM part""", ids=("W08",))
def q_pct_rank_average(spark, sf_dir):
    p = S.read(spark, sf_dir, "part").select("p_partkey", "p_size")
    return R.rank_scaled(p, "p_size", "pct_avg", kind="average_share", scan=True).select("p_partkey", "pct_avg")


@query("coverage", f"""
SELECT OCC_CODE,
       CASE WHEN COUNT(IMPORTANCE_RAW) > 0 THEN COUNT(IMPORTANCE_RAW) END AS rated_task_count,
       CASE WHEN COUNT(IMPORTANCE_RAW) > 0 THEN COUNT(CASE WHEN IMPORTANCE_RAW IS NOT NULL THEN AI_EXPOSURE_SCORE END) END
         AS scored_task_count,
       CASE WHEN COUNT(IMPORTANCE_RAW) > 0 THEN
         {O.ratio("COUNT(CASE WHEN IMPORTANCE_RAW IS NOT NULL THEN AI_EXPOSURE_SCORE END)", "COUNT(IMPORTANCE_RAW)",
                  zero="0.0")} END AS TASK_COUNT_COVERAGE,
       CASE WHEN COUNT(IMPORTANCE_RAW) > 0 THEN
         {O.ratio("SUM(CASE WHEN AI_EXPOSURE_SCORE IS NULL THEN 0 ELSE CAST(IMPORTANCE_RAW AS BIGINT) END)",
                  "SUM(CAST(IMPORTANCE_RAW AS BIGINT))", zero="0.0")} END AS IMPORTANCE_WEIGHT_COVERAGE
FROM ({O.TASKS}) t GROUP BY OCC_CODE""", ids=("A03", "A11"))
def q_coverage(spark, sf_dir):
    """Count and weight coverage per occupation (DIV0: 0 on a zero
    denominator, NULL when the occupation has no rated statement)."""
    from indexkit.functions.numeric import div0
    r = RU.task_rollup(S.task_statements(spark, sf_dir), weight_scale=S.WEIGHT_SCALE, norm_range=S.NORM_RANGE)
    return r.select("OCC_CODE", "rated_task_count", "scored_task_count",
                    div0("scored_task_count", "rated_task_count").alias("TASK_COUNT_COVERAGE"),
                    div0("imp_scored_u", "imp_total_u").alias("IMPORTANCE_WEIGHT_COVERAGE"))
