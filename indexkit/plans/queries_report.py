"""Registered queries: report data layer (profiles, funnel, KPIs) and
calibration agreement statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from indexkit.operators import agreement as AG
from indexkit.operators import profile as PR
from indexkit.operators import quality as Q
from indexkit.operators import relational as REL
from indexkit.plans import index as ix
from indexkit.plans import oracle as O
from indexkit.plans import standins as S
from indexkit.plans.queries import axes, occupation_index_df
from indexkit.plans.queries_ops import OEWS_SQL
from indexkit.plans.queries_quality import BASE_RULES_SQL, INDEX_RULES_SQL, base_rules, index_rules, published_tables
from indexkit.plans.registry import query

U = O.units
IDX = f"({O.occupation_index_sql()})"


# ------------------------------------------------------------ profiles

@query("value_counts", "SELECT p_brand, COUNT(*) AS n FROM part GROUP BY p_brand", ids=("A17", "D27"))
def q_value_counts(spark, sf_dir):
    return PR.value_counts(S.read(spark, sf_dir, "part"), "p_brand")


_RULES_SQL = f"{BASE_RULES_SQL} UNION ALL {INDEX_RULES_SQL}"
GROUP_ORDER = ("total", "major", "minor", "broad", "detailed")
GROUP_LABELS = {"total": "All occupations", "major": "Major groups", "minor": "Minor groups", "broad": "Broad occupations",
                "detailed": "Detailed occupations"}


@query("ordered_counts", f"""
SELECT CASE l_linestatus WHEN 'O' THEN 4 ELSE 5 END AS place, CASE l_linestatus WHEN 'O' THEN 'broad' ELSE 'detailed' END AS value,
       CASE l_linestatus WHEN 'O' THEN 'Broad occupations' ELSE 'Detailed occupations' END AS label, COUNT(*) AS n
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                           JOIN customer ON o_custkey = c_custkey) GROUP BY 1, 2, 3""", ids=("A17", "D27"))
def q_ordered_counts(spark, sf_dir):
    """Occupation levels of the newest year, in their fixed order and with labels."""
    return PR.ordered_counts(S.newest_oews(spark, sf_dir), F.lower("O_GROUP"), GROUP_ORDER, GROUP_LABELS)


@query("share", f"""
SELECT p_type, COUNT(*) AS n, {O.ratio("COUNT(*) * 100", "SUM(COUNT(*)) OVER ()", 2)} AS pct
FROM part GROUP BY p_type""", ids=("A19",))
def q_share(spark, sf_dir):
    return PR.share_of_total(PR.value_counts(S.read(spark, sf_dir, "part"), "p_type"), "n", "pct", 2)


@query("histogram", """
WITH v AS (SELECT CAST(l_extendedprice AS DOUBLE) AS v FROM lineitem
           WHERE l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice)),
mm AS (SELECT min(v) AS lo, CASE WHEN max(v) = min(v) THEN min(v) + 1 ELSE max(v) END AS hi FROM v),
w AS (SELECT lo, hi, (hi - lo) / 20.0 AS w FROM mm),
b AS (SELECT least(CAST(floor((v - lo) / w) AS INTEGER), 19) AS bin FROM v, w),
c AS (SELECT bin, COUNT(*) AS n FROM b GROUP BY bin)
SELECT r.bin, w.lo + r.bin * w.w AS bin_lo, CAST(coalesce(c.n, 0) AS BIGINT) AS n
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) r CROSS JOIN w LEFT JOIN c ON r.bin = c.bin""",
       ids=("A18", "D27"))
def q_histogram(spark, sf_dir):
    return PR.histogram(S.read(spark, sf_dir, "lineitem"), "l_extendedprice", 20)


def _funnel_steps(mx):
    return [("latest year", F.col("DATA_YEAR") == F.lit(mx)),
            ("national only", F.col("AREA_TYPE") == "1"),
            ("cross-industry, all owners", (F.lower("I_GROUP") == "cross-industry") & (F.col("OWN_CODE") == "1235")),
            ("detailed occupations", F.lower("O_GROUP") == "detailed")]


FUNNEL_SQL = f"""
WITH o AS ({OEWS_SQL}), mx AS (SELECT max(DATA_YEAR) AS y FROM o),
c AS (
  SELECT COUNT(*) AS s0,
         COUNT_IF(DATA_YEAR = (SELECT y FROM mx)) AS s1,
         COUNT_IF(DATA_YEAR = (SELECT y FROM mx) AND AREA_TYPE = '1') AS s2,
         COUNT_IF(DATA_YEAR = (SELECT y FROM mx) AND AREA_TYPE = '1' AND lower(I_GROUP) = 'cross-industry'
                  AND OWN_CODE = '1235') AS s3,
         COUNT_IF(DATA_YEAR = (SELECT y FROM mx) AND AREA_TYPE = '1' AND lower(I_GROUP) = 'cross-industry'
                  AND OWN_CODE = '1235' AND lower(O_GROUP) = 'detailed') AS s4
  FROM o)
SELECT step, label, CAST(rows AS BIGINT) AS rows, CASE WHEN s0 = 0 THEN NULL ELSE {O.ratio("rows * 100", "s0", 1)} END AS pct_of_start
FROM (
  SELECT 0 AS step, 'all rows' AS label, s0 AS rows, s0 FROM c UNION ALL
  SELECT 1, 'latest year', s1, s0 FROM c UNION ALL
  SELECT 2, 'national only', s2, s0 FROM c UNION ALL
  SELECT 3, 'cross-industry, all owners', s3, s0 FROM c UNION ALL
  SELECT 4, 'detailed occupations', s4, s0 FROM c)"""


@query("funnel", FUNNEL_SQL, ids=("A20", "D27"))
def q_funnel(spark, sf_dir):
    o = S.oews_like(spark, sf_dir)
    years = S.newest_oews(spark, sf_dir).select("DATA_YEAR").limit(1).collect()
    return PR.funnel(o, _funnel_steps(years[0][0] if years else None))


@query("kpis", f"""
SELECT (SELECT COUNT(DISTINCT OCC_CODE) FROM ({OEWS_SQL}) o
        WHERE AREA_TYPE = '1' AND I_GROUP = 'cross-industry' AND OWN_CODE = '1235' AND O_GROUP = 'detailed')
         AS detailed_occupations,
       (SELECT CAST(SUM(TOT_EMP) AS BIGINT) FROM {IDX} i) AS total_employment,
       (SELECT COUNT(*) FROM lineitem) AS task_statements,
       (SELECT {O.ratio("COUNT_IF(EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey)) * 100",
                        "COUNT(*)", 0)} FROM part) AS match_pct,
       (SELECT COUNT_IF(STATUS = 'PASS') || '/' || COUNT(*) || ' pass' FROM ({_RULES_SQL}) r) AS quality_checks,
       (SELECT COUNT(DISTINCT year(o_orderdate)) FROM orders) AS data_years""", ids=("A29", "J12", "D27"))
def q_kpis(spark, sf_dir):
    o = S.oews_like(spark, sf_dir)
    det = REL.slice_where(o, AREA_TYPE="1", I_GROUP="cross-industry", OWN_CODE="1235", O_GROUP="detailed")
    a = det.agg(F.count_distinct("OCC_CODE").alias("detailed_occupations"))
    tables = published_tables(spark, sf_dir)
    b = tables["index"].agg(F.sum(F.col("TOT_EMP").cast("bigint")).alias("total_employment"))
    rules = Q.union_results(base_rules(spark, sf_dir, tables), index_rules(spark, sf_dir, tables))
    q = rules.agg(F.concat(F.count_if(F.col("STATUS") == "PASS").cast("string"), F.lit("/"),
                           F.count(F.lit(1)).cast("string"), F.lit(" pass")).alias("quality_checks"))
    li = S.read(spark, sf_dir, "lineitem")
    c = li.agg(F.count(F.lit(1)).alias("task_statements"))
    p = S.read(spark, sf_dir, "part").select("p_partkey")
    matched = REL.semi(p, li.select(F.col("l_partkey").alias("p_partkey")), "p_partkey")
    d = matched.agg(F.count(F.lit(1)).alias("_m")).crossJoin(p.agg(F.count(F.lit(1)).alias("_t"))).select(
        F.when(F.col("_t") == 0, F.lit(None).cast("double"))
         .otherwise(F.round(F.col("_m").cast("decimal(20,0)") * 100 / F.col("_t").cast("decimal(20,0)"), 0)
                    .cast("double")).alias("match_pct"))
    e = S.read(spark, sf_dir, "orders").agg(F.count_distinct(F.year("o_orderdate")).alias("data_years"))
    return a.crossJoin(b).crossJoin(c).crossJoin(d).crossJoin(q).crossJoin(e)


@query("load_summary", """
SELECT 'lineitem' AS table_name, CAST(NULL AS INTEGER) AS DATA_YEAR, COUNT(*) AS rows FROM lineitem UNION ALL
SELECT 'orders', NULL, COUNT(*) FROM orders UNION ALL
SELECT 'customer', NULL, COUNT(*) FROM customer UNION ALL
SELECT 'part', NULL, COUNT(*) FROM part UNION ALL
SELECT 'orders', CAST(year(o_orderdate) AS INTEGER), COUNT(*) FROM orders GROUP BY year(o_orderdate) UNION ALL
SELECT 'distinct years', NULL, COUNT(DISTINCT year(o_orderdate)) FROM orders""", ids=("S19", "U02", "A12"))
def q_load_summary(spark, sf_dir):
    t = {n: S.read(spark, sf_dir, n) for n in ("lineitem", "orders", "customer", "part")}
    totals = PR.count_rows(t).select("table_name", F.lit(None).cast("int").alias("DATA_YEAR"), "rows")
    o = t["orders"].withColumn("DATA_YEAR", F.year("o_orderdate"))
    per_year = o.groupBy("DATA_YEAR").agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit("orders").alias("table_name"), "DATA_YEAR", "rows")
    years = o.agg(F.count_distinct("DATA_YEAR").alias("rows")).select(
        F.lit("distinct years").alias("table_name"), F.lit(None).cast("int").alias("DATA_YEAR"), "rows")
    return totals.unionByName(per_year).unionByName(years)


@query("breakdown", f"""
SELECT EXPOSURE_MODE, SCORE_STATUS, COUNT(*) AS occupations FROM {IDX} i
GROUP BY EXPOSURE_MODE, SCORE_STATUS""", ids=("A16",))
def q_breakdown(spark, sf_dir):
    return occupation_index_df(spark, sf_dir).groupBy("EXPOSURE_MODE", "SCORE_STATUS").agg(
        F.count(F.lit(1)).alias("occupations"))


@query("axis_cells", f"""
SELECT AXIS_TYPE, GRANULARITY, COUNT(*) AS cells,
       {O.ratio(f"SUM({U('AI_EXPOSURE')})", "COUNT(AI_EXPOSURE) * 10000")} AS avg_exposure
FROM ({O.axis_long_sql()}) a GROUP BY AXIS_TYPE, GRANULARITY""", ids=("A30", "A16"))
def q_axis_cells(spark, sf_dir):
    from indexkit.functions.numeric import exact_ratio
    from indexkit.operators.rollup import units
    idx, ind, reg = axes(spark, sf_dir)
    long = ix.axis_long(ind, reg, ix.axis_wage_band(idx))
    return long.groupBy("AXIS_TYPE", "GRANULARITY").agg(
        F.count(F.lit(1)).alias("cells"),
        exact_ratio(F.sum(units("AI_EXPOSURE", 4)), F.count("AI_EXPOSURE") * F.lit(10000)).alias("avg_exposure"))


# ------------------------------------------------------------ agreement

PAIRS = {"ai_exposure": ("l_discount * 10", "l_tax * 12.5"),
         "automation": ("l_tax * 10", "l_discount * 10"),
         "augmentation": ("1 - l_discount * 10", "1 - l_tax * 12.5")}


def _pairs_df(spark, sf_dir):
    li = S.read(spark, sf_dir, "lineitem")
    cols = {}
    for m, (a, b) in PAIRS.items():
        cols[f"{m}_x"] = F.expr(a)
        cols[f"{m}_y"] = F.expr(b)
    d = li.select(F.col("l_returnflag").alias("comparison"), *[c.alias(k) for k, c in cols.items()])
    return AG.long_pairs(d, ["comparison"], {m: (f"{m}_x", f"{m}_y") for m in PAIRS})


PAIRS_SQL = " UNION ALL ".join(
    f"SELECT l_returnflag AS comparison, '{m}' AS metric, CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y "
    f"FROM lineitem" for m, (a, b) in PAIRS.items())


def _band_sql(v):
    return f"CASE WHEN {v} IS NULL THEN NULL WHEN {v} < 0.3333 THEN 'Low' WHEN {v} < 0.6667 THEN 'Mid' ELSE 'High' END"


def _pearson_sql(x, y):
    d = f"stddev_pop({x}) * stddev_pop({y})"
    return f"ROUND(covar_pop({x}, {y}) / CASE WHEN {d} != 0 THEN {d} END, 6)"


def agreement_sql(pairs_sql, group):
    g = ", ".join(group)
    return f"""
WITH p AS (SELECT * FROM ({pairs_sql}) q WHERE x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)),
r AS (SELECT *,
        RANK() OVER (PARTITION BY {g} ORDER BY x) + (COUNT(*) OVER (PARTITION BY {g}, x) - 1) / 2.0 AS rx,
        RANK() OVER (PARTITION BY {g} ORDER BY y) + (COUNT(*) OVER (PARTITION BY {g}, y) - 1) / 2.0 AS ry
      FROM p)
SELECT {g}, COUNT(*) AS n,
       {O.ratio(f"SUM(abs({U('x')} - {U('y')}))", "COUNT(*) * 10000", 6)} AS mae,
       {_pearson_sql('x', 'y')} AS pearson,
       {_pearson_sql('rx', 'ry')} AS spearman,
       {O.ratio(f"SUM(CASE WHEN {_band_sql('x')} = {_band_sql('y')} THEN 1 ELSE 0 END)", "COUNT(*)", 6)}
         AS band_agreement
FROM r GROUP BY {g}"""


@query("agreement", agreement_sql(PAIRS_SQL, ["comparison", "metric"]),
       ids=("A21", "A22", "A23", "A24", "A25"))
def q_agreement(spark, sf_dir):
    return AG.agreement_report(_pairs_df(spark, sf_dir), ["comparison", "metric"])


RATERS = {"r1": "l_discount * 10",
          "r2": "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_tax * 12.5 END",
          "r3": "CASE WHEN l_linestatus = 'O' THEN NULL ELSE 1 - l_discount * 10 END"}


@query("rater_mean", f"""
WITH r AS (SELECT l_orderkey, l_linenumber, {', '.join(f'{v} AS {k}' for k, v in RATERS.items())} FROM lineitem),
c AS (SELECT *, {' + '.join(f'(CASE WHEN {k} IS NOT NULL THEN 1 ELSE 0 END)' for k in RATERS)} AS raters_present,
             {' + '.join(f'coalesce({U(k)}, 0)' for k in RATERS)} AS tot FROM r)
SELECT l_orderkey, l_linenumber, raters_present,
       CASE WHEN raters_present > 0 THEN {O.ratio('tot', 'raters_present * 10000')} END AS rater_mean
FROM c""", ids=("A26",))
def q_rater_mean(spark, sf_dir):
    li = S.read(spark, sf_dir, "lineitem")
    d = li.select("l_orderkey", "l_linenumber", *[F.expr(v).alias(k) for k, v in RATERS.items()])
    return AG.rater_mean(d, list(RATERS)).select("l_orderkey", "l_linenumber", "raters_present", "rater_mean")


@query("swap_flags", f"""
WITH d AS (SELECT l_returnflag AS comparison,
                  {U('l_discount * 10')} - {U('l_tax * 12.5')} AS d1,
                  {U('l_tax * 10')} - {U('l_discount * 10')} AS d2 FROM lineitem),
f AS (SELECT comparison, coalesce((d1 > 2500 AND d2 < -2500) OR (d1 < -2500 AND d2 > 2500), false) AS swap FROM d)
SELECT comparison, COUNT(*) AS rows, CAST(COUNT_IF(swap) AS BIGINT) AS swaps,
       {O.ratio('COUNT_IF(swap)', 'COUNT(*)', 6)} AS swap_share
FROM f GROUP BY comparison""", ids=("A27",))
def q_swap_flags(spark, sf_dir):
    li = S.read(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("comparison"), (F.col("l_discount") * 10).alias("m1"),
        (F.col("l_tax") * 12.5).alias("r1"), (F.col("l_tax") * 10).alias("m2"),
        (F.col("l_discount") * 10).alias("r2"))
    return AG.swap_flags(li, ("m1", "r1"), ("m2", "r2"), 0.25, ["comparison"])


RUN_LATEST_SQL = """
SELECT event_type, user_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id) AS rn FROM events)
WHERE rn = 1"""


@query("retest", agreement_sql(f"""
SELECT 'click_vs_view' AS comparison, 'value' AS metric, a.value / 100.0 AS x, b.value / 100.0 AS y
FROM ({RUN_LATEST_SQL}) a JOIN ({RUN_LATEST_SQL}) b ON a.user_id = b.user_id
WHERE a.event_type = 'click' AND b.event_type = 'view'""", ["comparison", "metric"]), ids=("J15", "W05"))
def q_retest(spark, sf_dir):
    e = S.read(spark, sf_dir, "events")
    latest = REL.latest_per_key(e, ["event_type", "user_id"],
                                [F.col("ts").desc(), F.col("event_id")], ["value"])
    a = latest.filter(F.col("event_type") == "click").select("user_id", (F.col("value") / 100.0).alias("x"))
    b = latest.filter(F.col("event_type") == "view").select("user_id", (F.col("value") / 100.0).alias("y"))
    pairs = a.join(b, "user_id").select(F.lit("click_vs_view").alias("comparison"),
                                        F.lit("value").alias("metric"), "x", "y")
    return AG.agreement_report(pairs, ["comparison", "metric"])


@query("spearman", f"""
WITH p AS (SELECT * FROM ({PAIRS_SQL}) q WHERE x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)),
r AS (SELECT *,
        RANK() OVER (PARTITION BY comparison, metric ORDER BY x)
          + (COUNT(*) OVER (PARTITION BY comparison, metric, x) - 1) / 2.0 AS rx,
        RANK() OVER (PARTITION BY comparison, metric ORDER BY y)
          + (COUNT(*) OVER (PARTITION BY comparison, metric, y) - 1) / 2.0 AS ry
      FROM p)
SELECT comparison, metric, COUNT(*) AS n, {_pearson_sql('rx', 'ry')} AS spearman
FROM r GROUP BY comparison, metric""", ids=("A23", "W07"))
def q_spearman(spark, sf_dir):
    """Pearson over average ranks, ranks taken per (comparison, metric) after
    incomplete pairs are dropped; ranks are weighted ones of the joint table."""
    g = ["comparison", "metric"]
    d = AG.rank_correlation(AG.joint_table(_pairs_df(spark, sf_dir), g), g)
    return d.groupBy(*g).agg(F.sum("n").alias("n"), AG.spearman_expr().alias("spearman"))


# ------------------------------------------------------------ calibration

#: Two annotators of the closed lines, the second one on some; the model is the score table (errors on
#: unscored lines), the re-test a second run that failed on other lines.
HUMAN = {"ai_exposure_annot1": "l_discount * 10", "ai_exposure_annot2": "CASE WHEN l_tax <= 0.06 THEN l_tax * 12.5 END",
         "automation_annot1": "l_tax * 10", "automation_annot2": "CASE WHEN l_tax <= 0.06 THEN l_discount * 10 END",
         "augmentation_annot1": "1 - l_discount * 10"}
AGAIN = {"AI_EXPOSURE_SCORE": "l_tax * 12.5", "AUTOMATION_SCORE": "l_tax * 10", "AUGMENTATION_SCORE": "1 - l_tax * 12.5"}
CALIBRATED = {"ai_exposure": "AI_EXPOSURE_SCORE", "automation": "AUTOMATION_SCORE", "augmentation": "AUGMENTATION_SCORE"}
SECOND_RUN = "NOT (l_returnflag = 'N' AND l_tax <= 0.01)"


def _human(spark, sf_dir):
    li = S.read(spark, sf_dir, "lineitem").filter("l_linestatus = 'F'")
    return li.select(*S.task_key(), *[F.expr(v).alias(k) for k, v in HUMAN.items()])


def _model(spark, sf_dir):
    li = S.read(spark, sf_dir, "lineitem")
    ok = S.scored_flag()
    return li.select(*S.task_key(), F.when(ok, F.col("l_discount") * 10).alias("AI_EXPOSURE_SCORE"),
                     F.when(ok, F.col("l_tax") * 10).alias("AUTOMATION_SCORE"),
                     F.when(ok, 1 - F.col("l_discount") * 10).alias("AUGMENTATION_SCORE"),
                     F.when(~ok, F.lit("timeout")).alias("ERROR_MESSAGE"))


def _calibration_pairs_sql():
    k = "l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_partkey"
    human = f"SELECT {k}, {', '.join(f'{v} AS {n}' for n, v in HUMAN.items())} FROM lineitem WHERE l_linestatus = 'F'"
    model = (f"SELECT {k}, l_discount * 10 AS m_ai_exposure, l_tax * 10 AS m_automation, 1 - l_discount * 10 AS m_augmentation "
             f"FROM lineitem WHERE {O.SCORED}")
    again = (f"SELECT {k}, {', '.join(f'{v} AS r_{m}' for m, v in zip(CALIBRATED, AGAIN.values()))} "
             f"FROM lineitem WHERE {SECOND_RUN}")
    merged = f"SELECT * FROM ({human}) h JOIN ({model}) m USING ({k}) LEFT JOIN ({again}) a USING ({k})"
    rows = []
    for m in CALIBRATED:
        raters = [n for n in HUMAN if n.startswith(m)]
        mean = (f"CASE WHEN {' + '.join(f'({r} IS NOT NULL)::INT' for r in raters)} > 0 THEN "
                + O.quotient(" + ".join(f"coalesce({U(r)}, 0)" for r in raters),
                             f"({' + '.join(f'({r} IS NOT NULL)::INT' for r in raters)}) * 10000") + " END")
        rows.append(f"SELECT 'human_model' AS comparison, '{m}' AS metric, {mean} AS x, m_{m} AS y FROM merged")
        if len(raters) > 1:
            rows.append(f"SELECT 'annotators', '{m}', {raters[0]}, {raters[1]} FROM merged")
        rows.append(f"SELECT 'retest', '{m}', m_{m}, r_{m} FROM merged")
    return f"WITH merged AS ({merged}) " + " UNION ALL ".join(rows)


@query("calibration", agreement_sql(_calibration_pairs_sql(), ["comparison", "metric"]),
       ids=("J14", "C09", "A21", "A22", "A23", "A24", "A25", "A26", "J15"))
def q_calibration(spark, sf_dir):
    """Rater x model, annotator x annotator and run x run, each side from its own relation."""
    again = S.read(spark, sf_dir, "lineitem").filter(SECOND_RUN).select(
        *S.task_key(), *[F.expr(v).alias(k) for k, v in AGAIN.items()])
    return AG.calibration(_human(spark, sf_dir), _model(spark, sf_dir), again, S.TASK_KEYS, CALIBRATED)


@query("swap_examples", f"""
WITH d AS (SELECT l_returnflag AS comparison, l_orderkey AS TASK_ID, l_linenumber AS TASK_LINE, l_suppkey AS TASK_SOURCE,
                  l_shipdate AS TASK_DATE, l_partkey AS OCC_CODE, {U('l_discount * 10')} - {U('l_tax * 12.5')} AS d1,
                  {U('l_tax * 10')} - {U('l_discount * 10')} AS d2 FROM lineitem),
f AS (SELECT *, row_number() OVER (PARTITION BY comparison ORDER BY TASK_ID, TASK_LINE, TASK_SOURCE, TASK_DATE, OCC_CODE) AS place
      FROM d WHERE (d1 > 2500 AND d2 < -2500) OR (d1 < -2500 AND d2 > 2500))
SELECT comparison, TASK_ID, TASK_LINE, TASK_SOURCE, TASK_DATE, OCC_CODE, d1 / 10000.0 AS difference_1,
       d2 / 10000.0 AS difference_2, place::INTEGER AS place FROM f WHERE place <= 5""", ids=("A27",))
def q_swap_examples(spark, sf_dir):
    li = S.read(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("comparison"), *S.task_key(), (F.col("l_discount") * 10).alias("m1"),
        (F.col("l_tax") * 12.5).alias("r1"), (F.col("l_tax") * 10).alias("m2"), (F.col("l_discount") * 10).alias("r2"))
    return AG.swap_examples(li, ("m1", "r1"), ("m2", "r2"), S.TASK_KEYS, 5, 0.25, ["comparison"])
