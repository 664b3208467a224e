"""Registered queries: data-quality rules, verdict, refresh log, change
detection, dimensions and the star join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexkit.functions import clean as C
from indexkit.functions.bands import WAGE_BANDS, bands_frame
from indexkit.functions.numeric import exact_ratio
from indexkit.operators import quality as Q
from indexkit.operators import relational as REL
from indexkit.operators.rollup import units
from indexkit.plans import index as ix
from indexkit.plans import oracle as O
from indexkit.plans import standins as S
from indexkit.plans.queries import occupation_index_df
from indexkit.plans.registry import query
from indexkit.session import written
from indexkit.sources import ingest as I
from indexkit.streaming import incremental as INC

U = O.units
IDX = f"({O.occupation_index_sql()})"


# ------------------------------------------------------------ rules (Spark)

def published_tables(spark, sf_dir) -> dict[str, DataFrame]:
    """The index and its axes as written tables (shared folder), like the
    warehouse rules read materialised tables."""
    root = I.work_dir(spark, "published")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}")
    idx = kept(occupation_index_df(spark, sf_dir), "index")
    # both axis slices start from the same lineitem ⋈ orders ⋈ customer pass, written once
    enriched = written(S.enriched_lines(spark, sf_dir), "lines")
    ind = kept(ix.axis_industry(S.industry_slice(spark, sf_dir, enriched), idx), "industry")
    reg = kept(ix.axis_region(S.region_slice(spark, sf_dir, enriched), idx), "region")
    return {"index": idx, "industry": ind, "region": reg,
            "long": ix.axis_long(ind, reg, ix.axis_wage_band(idx))}


def _bad(c: str):
    return F.count_if(F.col(c).isNull() | (F.col(c) <= 0))


def base_rules(spark, sf_dir, tables=None) -> DataFrame:
    """Checks 1-10, one aggregate per table."""
    li, part = S.read(spark, sf_dir, "lineitem"), S.read(spark, sf_dir, "part")
    idx = (tables or published_tables(spark, sf_dir))["index"]
    # the priority stands in for a staged code that may be blank
    rules = [Q.run_rules(S.read(spark, sf_dir, "orders"), [
        Q.Rule(1, "missing code in staging", "rows", F.count_if(C.is_blank(F.substring("o_orderpriority", 3, 40))),
               Q.fail_if_positive)])]
    rules.append(Q.run_rules(part, [
        Q.Rule(2, "occupation code not standardised", "rows",
               F.count_if(F.col("p_name").isNull() | (F.length("p_name") != 7)), Q.fail_if_positive)]))
    # one pass over the key pairs of both sides gives 3, 9 and 10
    sides = part.select(F.col("p_partkey").alias("k"), F.lit(1).alias("p"), F.lit(0).alias("t")).unionByName(
        S.importance(spark, sf_dir).select(F.col("OCC_CODE").alias("k"), F.lit(0).alias("p"), F.lit(1).alias("t")))
    keys = sides.groupBy("k").agg(F.max("p").alias("p"), F.max("t").alias("t"))
    both, n = F.count_if((F.col("p") == 1) & (F.col("t") == 1)), F.sum("p")
    rules.append(Q.run_rules(keys, [
        Q.Rule(3, "occupations with tasks", "pct", exact_ratio(both * 100, n, 1), Q.pass_at_least(80.0),
               tested=F.try_divide(both * 100.0, n.cast("double"))),
        Q.Rule(9, "occupations without tasks", "keys", F.count_if((F.col("p") == 1) & (F.col("t") == 0)), Q.info),
        Q.Rule(10, "task codes without occupation", "keys", F.count_if((F.col("p") == 0) & (F.col("t") == 1)), Q.info)]))
    for name, df, cols in (("part", part, ["p_partkey"]),
                           ("supplier", S.read(spark, sf_dir, "supplier"), ["s_suppkey"]),
                           ("customer", S.read(spark, sf_dir, "customer"), ["c_custkey"]),
                           ("task", li, ["l_orderkey", "l_linenumber"])):
        rules.append(Q.run_rules(REL.duplicate_keys(df, cols), [
            Q.Rule(4, f"duplicate {name} keys", "keys", F.count(F.lit(1)), Q.fail_if_positive)]))
    before = part.agg(F.count(F.lit(1)).alias("n_base"))
    fact = idx.agg(_bad("TOT_EMP").alias("emp"), _bad("A_MEDIAN").alias("wage"),
                   F.count_if(~F.col("AI_EXPOSURE").between(0, 1)).alias("oor"), F.count(F.lit(1)).alias("n_fact"))
    one = fact.crossJoin(before)
    after, base = F.max("n_fact"), F.max("n_base")
    rules.append(Q.run_rules(one, [
        Q.Rule(5, "invalid employment in the fact", "rows", F.max("emp"), Q.warn_if_positive),
        Q.Rule(6, "invalid wage in the fact", "rows", F.max("wage"), Q.warn_if_positive),
        Q.Rule(7, "exposure out of range", "rows", F.max("oor"), Q.fail_if_positive),
        Q.Rule(8, "fact row retention", "pct", exact_ratio(after * 100, base, 1), Q.pass_at_least(90.0),
               tested=F.try_divide(after * 100.0, base.cast("double"))),
        Q.Rule(8, "rows before", "rows", base, Q.info),
        Q.Rule(8, "rows after", "rows", after, Q.info)]))
    return Q.union_results(*rules)


def index_rules(spark, sf_dir, tables=None) -> DataFrame:
    """Checks 20-28, one aggregate per table."""
    t_ = tables or published_tables(spark, sf_dir)
    idx, ind, reg, long = t_["index"], t_["industry"], t_["region"], t_["long"]
    def outside(cols):
        cond = F.lit(False)
        for m in cols:
            cond = cond | ~F.col(m).between(0, 1)
        return F.count_if(cond)
    rules = [Q.run_rules(S.task_scores(spark, sf_dir), [
        Q.Rule(20, "task scores out of range", "rows", outside(ix.METRICS), Q.fail_if_positive)])]
    scored = F.col("SCORE_STATUS") == "SCORED"
    cover = F.when(scored, units("IMPORTANCE_WEIGHT_COVERAGE", 4))
    mean, n_scored = F.sum(cover), F.count_if(scored)
    rules.append(Q.run_rules(idx, [
        Q.Rule(21, "scored rows missing a sub-score", "rows", F.count_if(
            scored & (F.col("AI_EXPOSURE").isNull() | F.col("AUTOMATION").isNull() | F.col("AUGMENTATION").isNull())),
            Q.fail_if_positive),
        Q.Rule(22, "exposure mode", "occupations", F.count(F.lit(1)),
               lambda m: F.when(m == 1, F.lit("INFO")).otherwise(F.lit("WARN")),
               tested=F.max(F.when(F.col("EXPOSURE_MODE") == ix.REAL, 1).otherwise(0))),
        Q.Rule(23, "low coverage occupations", "rows", F.count_if(F.col("SCORE_STATUS") == "LOW_COVERAGE"), Q.info),
        Q.Rule(24, "mean weight coverage of scored", "pct", exact_ratio(mean * 100, n_scored * 10000, 1),
               lambda m: F.when(m.isNull() | (m >= 0.8), F.lit("PASS")).otherwise(F.lit("WARN")),
               tested=F.try_divide(mean.cast("double"), n_scored * 10000.0))]))
    e = ind.agg(F.sum("TOTAL_EMP").alias("i")).crossJoin(idx.agg(F.sum("TOT_EMP").alias("n")))
    rules.append(Q.run_rules(e, [
        Q.Rule(25, "industry employment within the fact total", "pct", exact_ratio(F.max("i") * 100, F.max("n"), 1, zero=0),
               Q.fail_above(0.0), tested=F.max("i") - F.max("n"))]))
    rules.append(Q.run_rules(reg, [
        Q.Rule(26, "granularities present", "count", F.count_distinct("GRANULARITY"),
               lambda m: F.when(m == 3, F.lit("PASS")).otherwise(F.lit("WARN"))),
        Q.Rule(27, "state area count", "count", F.count_if(F.col("GRANULARITY") == "State"),
               lambda m: F.when(m.between(50, 56), F.lit("PASS")).otherwise(F.lit("WARN")))]))
    rules.append(Q.run_rules(long, [Q.Rule(28, "axis values out of range", "rows", outside(ix.AXIS_METRICS),
                                           Q.fail_if_positive)]))
    return Q.union_results(*rules)


# ------------------------------------------------------------ rules (SQL)

def _r(cid, name, metric, value, status, tested=None):
    return (f"SELECT {cid} AS CHECK_ID, '{name}' AS CHECK_NAME, '{metric}' AS METRIC, "
            f"CAST(v AS DOUBLE) AS METRIC_VALUE, {status} AS STATUS FROM (SELECT ({value}) AS v, ({tested or 'NULL'}) AS x) q")


FAILPOS = "CASE WHEN v > 0 THEN 'FAIL' ELSE 'PASS' END"
WARNPOS = "CASE WHEN v > 0 THEN 'WARN' ELSE 'PASS' END"
INFO = "'INFO'"


def _dups(table, keys):
    return f"(SELECT COUNT(*) FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING COUNT(*) > 1) d)"


RATED_KEYS = f"(SELECT l_partkey FROM lineitem WHERE {O.RATED})"
_MATCHED = f"(SELECT COUNT_IF(p_partkey IN {RATED_KEYS}) FROM part)"
_N_PART, _N_FACT = "(SELECT COUNT(*) FROM part)", f"(SELECT COUNT(*) FROM {IDX} i)"

BASE_RULES_SQL = " UNION ALL ".join([
    _r(1, "missing code in staging", "rows",
       "SELECT COUNT_IF(o_orderpriority IS NULL OR trim(substr(o_orderpriority, 3, 40)) = '') FROM orders", FAILPOS),
    _r(2, "occupation code not standardised", "rows",
       "SELECT COUNT_IF(p_name IS NULL OR length(p_name) <> 7) FROM part", FAILPOS),
    _r(3, "occupations with tasks", "pct", O.quotient(f"{_MATCHED} * 100", _N_PART, 1),
       "CASE WHEN x >= 80.0 THEN 'PASS' ELSE 'WARN' END", f"{_MATCHED} * 100.0::DOUBLE / {_N_PART}"),
    _r(4, "duplicate part keys", "keys", _dups("part", "p_partkey"), FAILPOS),
    _r(4, "duplicate supplier keys", "keys", _dups("supplier", "s_suppkey"), FAILPOS),
    _r(4, "duplicate customer keys", "keys", _dups("customer", "c_custkey"), FAILPOS),
    _r(4, "duplicate task keys", "keys", _dups("lineitem", "l_orderkey, l_linenumber"), FAILPOS),
    _r(5, "invalid employment in the fact", "rows",
       f"SELECT COUNT_IF(TOT_EMP IS NULL OR TOT_EMP <= 0) FROM {IDX} i", WARNPOS),
    _r(6, "invalid wage in the fact", "rows",
       f"SELECT COUNT_IF(A_MEDIAN IS NULL OR A_MEDIAN <= 0) FROM {IDX} i", WARNPOS),
    _r(7, "exposure out of range", "rows", f"SELECT COUNT_IF(NOT (AI_EXPOSURE BETWEEN 0 AND 1)) FROM {IDX} i",
       FAILPOS),
    _r(8, "fact row retention", "pct", O.quotient(f"{_N_FACT} * 100", _N_PART, 1),
       "CASE WHEN x >= 90.0 THEN 'PASS' ELSE 'WARN' END", f"{_N_FACT} * 100.0::DOUBLE / {_N_PART}"),
    _r(8, "rows before", "rows", _N_PART, INFO),
    _r(8, "rows after", "rows", _N_FACT, INFO),
    _r(9, "occupations without tasks", "keys",
       f"SELECT COUNT(DISTINCT p_partkey) FROM part WHERE p_partkey NOT IN {RATED_KEYS}", INFO),
    _r(10, "task codes without occupation", "keys",
       f"SELECT COUNT(DISTINCT l_partkey) FROM lineitem WHERE {O.RATED} AND l_partkey NOT IN (SELECT p_partkey FROM part)",
       INFO),
])

_OOR_T = " OR ".join(f"NOT ({m} BETWEEN 0 AND 1)" for m in ("AI_EXPOSURE_SCORE", "AUTOMATION_SCORE",
                                                           "AUGMENTATION_SCORE"))
_OOR_A = " OR ".join(f"NOT ({m} BETWEEN 0 AND 1)" for m in ("AI_EXPOSURE", "AUTOMATION", "AUGMENTATION"))
_SC = "SCORE_STATUS = 'SCORED'"
_COV_U = U("IMPORTANCE_WEIGHT_COVERAGE")
_COV = f"(SELECT SUM({_COV_U}) FILTER ({_SC}) FROM {IDX} i)"
_N_SC = f"(SELECT COUNT_IF({_SC}) FROM {IDX} i)"
_IND = f"(SELECT SUM(TOTAL_EMP) FROM ({O.axis_industry_sql()}) a)"
_NAT = f"(SELECT SUM(TOT_EMP) FROM {IDX} i)"

INDEX_RULES_SQL = " UNION ALL ".join([
    _r(20, "task scores out of range", "rows", f"SELECT COUNT_IF({_OOR_T}) FROM ({O.TASKS}) t", FAILPOS),
    _r(21, "scored rows missing a sub-score", "rows",
       f"SELECT COUNT_IF({_SC} AND (AI_EXPOSURE IS NULL OR AUTOMATION IS NULL OR AUGMENTATION IS NULL)) FROM {IDX} i",
       FAILPOS),
    _r(22, "exposure mode", "occupations", _N_FACT, "CASE WHEN x THEN 'INFO' ELSE 'WARN' END",
       f"SELECT bool_or(EXPOSURE_MODE = 'REAL_TASK_SCORE') FROM {IDX} i"),
    _r(23, "low coverage occupations", "rows", f"SELECT COUNT_IF(SCORE_STATUS = 'LOW_COVERAGE') FROM {IDX} i", INFO),
    _r(24, "mean weight coverage of scored", "pct", O.quotient(f"{_COV} * 100", f"{_N_SC} * 10000", 1),
       "CASE WHEN x IS NULL OR x >= 0.8 THEN 'PASS' ELSE 'WARN' END", f"{_COV}::DOUBLE / nullif({_N_SC} * 10000, 0)"),
    _r(25, "industry employment within the fact total", "pct",
       f"coalesce({O.quotient(f'{_IND} * 100', _NAT, 1)}, 0.0)", "CASE WHEN x > 0 THEN 'FAIL' ELSE 'PASS' END",
       f"{_IND} - {_NAT}"),
    _r(26, "granularities present", "count", f"SELECT COUNT(DISTINCT GRANULARITY) FROM ({O.axis_region_sql()}) r",
       "CASE WHEN v = 3 THEN 'PASS' ELSE 'WARN' END"),
    _r(27, "state area count", "count", f"SELECT COUNT_IF(GRANULARITY = 'State') FROM ({O.axis_region_sql()}) r",
       "CASE WHEN v BETWEEN 50 AND 56 THEN 'PASS' ELSE 'WARN' END"),
    _r(28, "axis values out of range", "rows", f"SELECT COUNT_IF({_OOR_A}) FROM ({O.axis_long_sql()}) x", FAILPOS),
])


@query("dq_rules", f"{BASE_RULES_SQL} UNION ALL {INDEX_RULES_SQL}",
       ids=("Q00", "Q01", "Q02", "Q03", "Q04", "Q05", "Q06", "Q07", "Q08", "Q09", "Q10", "Q20", "Q21",
            "Q22", "Q23", "Q24", "Q25", "Q26", "Q27", "Q28", "C10", "A14"))
def q_dq_rules(spark, sf_dir):
    tables = published_tables(spark, sf_dir)
    return Q.union_results(base_rules(spark, sf_dir, tables), index_rules(spark, sf_dir, tables))


VERDICT_SQL = f"""
SELECT COUNT_IF(STATUS = 'FAIL') AS QUALITY_FAILS, COUNT_IF(STATUS = 'WARN') AS QUALITY_WARNS,
       CASE WHEN COUNT_IF(STATUS = 'FAIL') = 0 THEN 'BUILD OK' ELSE 'BUILD HAS FAILURES' END AS VERDICT
FROM ({BASE_RULES_SQL} UNION ALL {INDEX_RULES_SQL}) r"""


@query("dq_verdict", VERDICT_SQL, ids=("Q30",))
def q_dq_verdict(spark, sf_dir):
    return Q.verdict(q_dq_rules(spark, sf_dir))


@query("dq_dashboard", f"""
SELECT CHECK_ID, CHECK_NAME, METRIC, METRIC_VALUE, STATUS FROM ({INDEX_RULES_SQL}) r WHERE CHECK_ID >= 20""",
       ids=("Q32", "T02"))
def q_dq_dashboard(spark, sf_dir):
    r = index_rules(spark, sf_dir, published_tables(spark, sf_dir)).filter(F.col("CHECK_ID") >= 20)
    return r.orderBy(*Q.dashboard_order())


@query("refresh_log", f"""
SELECT (SELECT max(year(o_orderdate)) FROM orders) AS BLS_LATEST_YEAR,
       (SELECT COUNT(*) FROM lineitem) AS BLS_RAW_ROWS,
       (SELECT COUNT(*) FROM lineitem) AS ONET_TASK_ROWS,
       (SELECT COUNT(*) FROM {IDX} i) AS FACT_ROWS,
       (SELECT COUNT(DISTINCT p_partkey) FROM part) AS OCCUPATIONS,
       v.QUALITY_FAILS, v.QUALITY_WARNS, v.VERDICT
FROM ({VERDICT_SQL}) v""", ids=("Q31", "J12", "T04"))
def q_refresh_log(spark, sf_dir):
    tables = published_tables(spark, sf_dir)
    o = S.read(spark, sf_dir, "orders").agg(F.max(F.year("o_orderdate")).alias("BLS_LATEST_YEAR"))
    li = S.read(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("BLS_RAW_ROWS"))
    tasks = S.task_statements(spark, sf_dir).agg(F.count(F.lit(1)).alias("ONET_TASK_ROWS"))
    # occupations are those of the dimension, not only those the fact kept
    idx = tables["index"].agg(F.count(F.lit(1)).alias("FACT_ROWS")).crossJoin(
        S.base_occupations(spark, sf_dir).agg(F.count_distinct("OCC_CODE").alias("OCCUPATIONS")))
    rules = Q.union_results(base_rules(spark, sf_dir, tables), index_rules(spark, sf_dir, tables))
    return o.crossJoin(li).crossJoin(tasks).crossJoin(idx).crossJoin(Q.verdict(rules))


@query("dup_keys", """
SELECT COUNT(*) AS duplicated_keys, CAST(SUM(n) AS BIGINT) AS rows_in_duplicates, CAST(MAX(n) AS BIGINT) AS max_copies
FROM (SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1)""",
       ids=("A14",))
def q_dup_keys(spark, sf_dir):
    d = REL.duplicate_keys(S.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    return d.agg(F.count(F.lit(1)).alias("duplicated_keys"), F.sum("n").alias("rows_in_duplicates"),
                 F.max("n").alias("max_copies"))


# ------------------------------------------------------------ change detection

def _snapshot_sql(where):
    return f"""
SELECT 'user/' || CAST(user_id AS VARCHAR) AS url, event_type AS etag,
       CAST(event_id AS VARCHAR) AS last_modified, CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS length
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM events WHERE {where}) WHERE rn = 1"""


CUT = "TIMESTAMP '2024-01-16 00:00:00'"
#: Snapshots of user pages: purchases and late sign-ups now, purchases and errors of the first half before.
#: Users differ by residence in either, so all four statuses occur.
CUR = f"event_type = 'purchase' AND value > 90 OR event_type = 'signup' AND value > 95 AND ts >= {CUT}"
PREV = f"event_type = 'purchase' AND value > 90 AND ts < TIMESTAMP '2024-01-28 00:00:00' OR event_type = 'error' AND value > 99"


def _snapshot(spark, sf_dir, cond):
    e = S.read(spark, sf_dir, "events").filter(cond)
    latest = REL.latest_per_key(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()],
                                ["event_type", "event_id", "value"])
    return latest.select(F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("url"),
                         F.col("event_type").alias("etag"), F.col("event_id").cast("string").alias("last_modified"),
                         F.floor("value").cast("bigint").cast("string").alias("length"))


@query("manifest_diff", f"""
WITH cur AS ({_snapshot_sql(CUR)}), prev AS ({_snapshot_sql(PREV)})
SELECT coalesce(c.url, p.url) AS url,
       CASE WHEN p.url IS NULL THEN 'new' WHEN c.url IS NULL THEN 'missing'
            WHEN c.etag IS NOT DISTINCT FROM p.etag AND c.last_modified IS NOT DISTINCT FROM p.last_modified
                 AND c.length IS NOT DISTINCT FROM p.length THEN 'unchanged' ELSE 'changed' END AS status,
       c.etag AS cur_etag, c.last_modified AS cur_last_modified, c.length AS cur_length,
       p.etag AS prev_etag, p.last_modified AS prev_last_modified, p.length AS prev_length
FROM cur c FULL OUTER JOIN prev p ON c.url = p.url""", ids=("S20",))
def q_manifest_diff(spark, sf_dir):
    # TIMESTAMP literals in Spark SQL are zoned; the event times are not
    cur, prev = (_snapshot(spark, sf_dir, F.expr(c.replace("TIMESTAMP", "TIMESTAMP_NTZ"))) for c in (CUR, PREV))
    return INC.manifest_diff(cur, prev, "url")


@query("latest_version", """
SELECT name, major, minor FROM (
  SELECT 'db_' || CAST(p_size AS VARCHAR) || '_' || CAST(p_partkey AS VARCHAR) || '_text.zip' AS name,
         p_size AS major, p_partkey AS minor FROM part)
ORDER BY major DESC, minor DESC LIMIT 1""", ids=("S21",))
def q_latest_version(spark, sf_dir):
    p = S.read(spark, sf_dir, "part")
    names = p.select(F.concat(F.lit("db_"), F.col("p_size").cast("string"), F.lit("_"),
                              F.col("p_partkey").cast("string"), F.lit("_text.zip")).alias("name"))
    r = INC.latest_version(names)
    return r.select("name", F.col("major").cast("int").alias("major"), "minor")


@query("year_window", """
SELECT CAST(y AS INTEGER) AS DATA_YEAR FROM (SELECT max(year(o_orderdate)) AS m FROM orders),
  range(m - 2, m + 2) t(y)""", ids=("S22",))
def q_year_window(spark, sf_dir):
    o = S.read(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("DATA_YEAR"))
    return INC.year_window(o, "DATA_YEAR")


# ------------------------------------------------------------ dimensions, star join

DIM_REGION_SQL = """
SELECT AREA, AREA_TITLE, STATE, AREA_TYPE_LABEL FROM (
  SELECT *, row_number() OVER (PARTITION BY AREA ORDER BY DATA_YEAR DESC, AREA_TITLE, STATE, AREA_TYPE_LABEL) AS rn
  FROM (SELECT DISTINCT year(o_orderdate) AS DATA_YEAR, c_nationkey AS AREA,
               n_name || ' (' || CAST(year(o_orderdate) AS VARCHAR) || ')' AS AREA_TITLE, r_name AS STATE,
               CASE left(o_orderpriority, 1) WHEN '1' THEN 'National' WHEN '2' THEN 'State'
                    WHEN '3' THEN 'Territory' WHEN '4' THEN 'Metropolitan' WHEN '6' THEN 'Nonmetropolitan'
                    ELSE 'Other' END AS AREA_TYPE_LABEL
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
             JOIN region ON n_regionkey = r_regionkey) c) WHERE rn = 1"""


@query("dim_region", DIM_REGION_SQL, ids=("D13", "W05", "A13", "P07"))
def q_dim_region(spark, sf_dir):
    o = S.read(spark, sf_dir, "orders")
    c = S.read(spark, sf_dir, "customer")
    n = S.read(spark, sf_dir, "nation")
    r = S.read(spark, sf_dir, "region")
    j = (o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey)
          .join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey))
    y = F.year("o_orderdate")
    cand = j.select(y.alias("DATA_YEAR"), F.col("c_nationkey").alias("AREA"),
                    F.concat(F.col("n_name"), F.lit(" ("), y.cast("string"), F.lit(")")).alias("AREA_TITLE"),
                    F.col("r_name").alias("STATE"),
                    C.label_case(F.left(F.col("o_orderpriority"), F.lit(1)), C.AREA_TYPE_LABELS,
                                 C.AREA_TYPE_OTHER).alias("AREA_TYPE_LABEL")).distinct()
    return REL.latest_per_key(cand, ["AREA"], [F.col("DATA_YEAR").desc(), F.col("AREA_TITLE"), F.col("STATE"),
                                               F.col("AREA_TYPE_LABEL")],
                              ["AREA_TITLE", "STATE", "AREA_TYPE_LABEL"])


@query("star_join", f"""
WITH drill AS ({O.industry_drill_sql()}),
dim_occ AS (SELECT DISTINCT p_partkey AS OCC_CODE, p_name AS OCC_TITLE, p_brand AS O_GROUP FROM part),
idx AS (SELECT OCC_CODE, WAGE_BAND FROM {IDX} i),
bands AS (SELECT * FROM (VALUES ('Low', 1), ('Middle', 2), ('High', 3)) b(WAGE_BAND, BAND_ORDER))
SELECT d.NAICS, d.INDUSTRY_TITLE, d.OCC_CODE, o.OCC_TITLE, o.O_GROUP, i.WAGE_BAND, b.BAND_ORDER,
       d.SECTOR_OCC_EMP, d.AI_EXPOSURE
FROM drill d LEFT JOIN dim_occ o ON d.OCC_CODE = o.OCC_CODE LEFT JOIN idx i ON d.OCC_CODE = i.OCC_CODE
     LEFT JOIN bands b ON i.WAGE_BAND = b.WAGE_BAND""", ids=("J18", "D11", "D15", "D18"))
def q_star_join(spark, sf_dir):
    idx = occupation_index_df(spark, sf_dir)
    drill = ix.drill_fact(S.industry_slice(spark, sf_dir), idx, "SECTOR_OCC_EMP", ["NAICS", "INDUSTRY_TITLE"])
    dim_occ = S.base_occupations(spark, sf_dir).select("OCC_CODE", "OCC_TITLE", "O_GROUP").distinct()
    bands = bands_frame(spark, WAGE_BANDS).select("WAGE_BAND", "BAND_ORDER")
    return (drill.join(dim_occ, "OCC_CODE", "left")
                 .join(idx.select("OCC_CODE", "WAGE_BAND"), "OCC_CODE", "left")
                 .join(F.broadcast(bands), "WAGE_BAND", "left")
                 .select("NAICS", "INDUSTRY_TITLE", "OCC_CODE", "OCC_TITLE", "O_GROUP", "WAGE_BAND",
                         "BAND_ORDER", "SECTOR_OCC_EMP", "AI_EXPOSURE"))


@query("placeholder_fact", f"""
WITH base AS ({O.BASE}),
ph AS (SELECT OCC_CODE, COALESCE({O.ratio("SUM(CAST(IMPORTANCE_RAW AS BIGINT)) - COUNT(IMPORTANCE_RAW)",
                                            "COUNT(IMPORTANCE_RAW) * 49")}, 0.0) AS AI_EXPOSURE
       FROM ({O.TASKS}) t GROUP BY OCC_CODE),
r AS (SELECT b.*, p.AI_EXPOSURE, PERCENT_RANK() OVER (ORDER BY A_MEDIAN) AS WAGE_PERCENTILE,
             RANK() OVER (ORDER BY p.AI_EXPOSURE DESC NULLS FIRST) AS EXPOSURE_RANK,
             p.AI_EXPOSURE * b.TOT_EMP AS WEIGHTED_EXPOSURE
      FROM base b LEFT JOIN ph p ON b.OCC_CODE = p.OCC_CODE WHERE A_MEDIAN IS NOT NULL)
SELECT OCC_CODE, OCC_TITLE, O_GROUP, TOT_EMP, A_MEAN, A_MEDIAN, WAGE_PERCENTILE,
       CASE WHEN WAGE_PERCENTILE >= 0.0 AND WAGE_PERCENTILE < 0.3333 THEN 'Low'
            WHEN WAGE_PERCENTILE >= 0.3333 AND WAGE_PERCENTILE < 0.6667 THEN 'Middle'
            WHEN WAGE_PERCENTILE >= 0.6667 AND WAGE_PERCENTILE < 1.01 THEN 'High' END AS WAGE_BAND,
       AI_EXPOSURE, WEIGHTED_EXPOSURE, EXPOSURE_RANK, '99' AS AREA, 'US' AS STATE, p_type AS NAICS, lower(p_type) AS INDUSTRY_TITLE,
       CASE WHEN AI_EXPOSURE IS NOT NULL THEN 'PLACEHOLDER_ONET_IMPORTANCE_PROXY' END AS EXPOSURE_SOURCE
FROM r JOIN part ON p_partkey = OCC_CODE""", ids=("D16", "W02", "J04", "J06"))
def q_placeholder_fact(spark, sf_dir):
    from indexkit.operators.rollup import placeholder_index
    ph = placeholder_index(S.task_statements(spark, sf_dir), weight_scale=S.WEIGHT_SCALE, norm_range=S.NORM_RANGE)
    base = S.base_occupations(spark, sf_dir)
    p = S.read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("OCC_CODE"), F.lit("99").alias("AREA"), F.lit("US").alias("STATE"),
        F.col("p_type").alias("NAICS"), F.lower("p_type").alias("INDUSTRY_TITLE"))
    return ix.build_placeholder_fact(base.join(p, "OCC_CODE"), ph, extra=("AREA", "STATE", "NAICS", "INDUSTRY_TITLE"))


# ------------------------------------------------------------ index validation

@query("index_invariants", f"""
WITH i AS ({O.occupation_index_sql()}), r AS ({O.axis_region_sql()}), l AS ({O.axis_long_sql()})
SELECT (SELECT COUNT(*) FROM i) AS occupations, (SELECT COUNT(DISTINCT OCC_CODE) FROM i) AS codes,
       (SELECT min(AI_EXPOSURE) FROM i) AS exposure_min, (SELECT max(AI_EXPOSURE) FROM i) AS exposure_max,
       (SELECT min(WAGE_PERCENTILE) FROM i) AS percentile_min, (SELECT max(WAGE_PERCENTILE) FROM i) AS percentile_max,
       (SELECT COUNT(*) FROM i WHERE (SCORE_STATUS = 'SCORED') <> (AI_EXPOSURE IS NOT NULL)) AS status_mismatches,
       (SELECT COUNT(DISTINCT t) FROM (SELECT SUM(TOTAL_EMP) AS t FROM r GROUP BY GRANULARITY)) AS granularity_totals,
       (SELECT COUNT_IF(NOT (AI_EXPOSURE BETWEEN 0 AND 1) OR NOT (EMP_COVERAGE BETWEEN 0 AND 1)) FROM l) AS axis_cells_out,
       (SELECT COUNT(*) FROM l) AS axis_cells""", ids=("C10", "Q07", "Q28"))
def q_index_invariants(spark, sf_dir):
    """What must hold of a published index and its axes, in one row."""
    t = published_tables(spark, sf_dir)
    i = t["index"].agg(
        F.count(F.lit(1)).alias("occupations"), F.count_distinct("OCC_CODE").alias("codes"),
        F.min("AI_EXPOSURE").alias("exposure_min"), F.max("AI_EXPOSURE").alias("exposure_max"),
        F.min("WAGE_PERCENTILE").alias("percentile_min"), F.max("WAGE_PERCENTILE").alias("percentile_max"),
        F.count_if((F.col("SCORE_STATUS") == "SCORED") != F.col("AI_EXPOSURE").isNotNull()).alias("status_mismatches"))
    r = t["region"].groupBy("GRANULARITY").agg(F.sum("TOTAL_EMP").alias("t")).agg(F.count_distinct("t").alias("granularity_totals"))
    out = ~F.col("AI_EXPOSURE").between(0, 1) | ~F.col("EMP_COVERAGE").between(0, 1)
    cells = t["long"].agg(F.count_if(out).alias("axis_cells_out"), F.count(F.lit(1)).alias("axis_cells"))
    return i.crossJoin(r).crossJoin(cells)
