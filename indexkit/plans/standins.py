"""Domain relations derived from the driver tables.

The driver ships TPC-H-like tables, not labour statistics; these functions
derive the domain shapes from them so every registered query reads the
whole tables and grows with them:

* occupation (fact grain)  = ``part``: code p_partkey, title p_name, group
  p_brand, employment p_size, wage p_retailprice.
* task statement           = one ``lineitem`` row of occupation l_partkey.
  Rated (has an importance) when l_linestatus = 'F' and l_returnflag = 'R',
  so some parts have no rated task; importance is l_quantity (1..50,
  normalised with (x-1)/49).  Statements, importance and scores are separate
  relations on the task key.  Scored unless
  l_returnflag = 'R' and l_tax <= 0.03; scores are l_discount*10,
  l_tax*10, 1 - l_discount*10, confidence 1 - l_tax*10 (all in [0, 1]).
* industry slice           = employment (Σ l_quantity) per customer market
  segment × part (lineitem ⋈ orders ⋈ customer).
* region slice             = employment per area × part at three area types:
  '2' supplier nation, '4' customer nation, '6' supplier region.
* data year                = year(o_orderdate).

Each relation is also written as DuckDB SQL in ``indexkit.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexkit.functions.clean import GRANULARITY_LABELS, label_case

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

NORM_RANGE = (1.0, 50.0)   # l_quantity stands in for the 1..5 importance scale
WEIGHT_SCALE = 0           # quantities are integral
VALUE_SCALE = 4


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def base_occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("OCC_CODE"), F.col("p_name").alias("OCC_TITLE"),
                    F.col("p_brand").alias("O_GROUP"), F.col("p_size").alias("TOT_EMP"),
                    F.col("p_retailprice").alias("A_MEAN"), F.col("p_retailprice").alias("A_MEDIAN"))


def scored_flag():
    return ~((F.col("l_returnflag") == "R") & (F.col("l_tax") <= 0.03))


TASK_KEYS = ("TASK_ID", "TASK_LINE", "TASK_SOURCE", "TASK_DATE", "OCC_CODE")


def task_key() -> list:
    """Order, line, supplier, ship date and part name one line item (order and line
    don't)."""
    return [F.col(c).alias(k) for c, k in zip(("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_partkey"), TASK_KEYS)]


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All task statements: the task key with its occupation."""
    return read(spark, sf_dir, "lineitem").select(*task_key())


def importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of the rated statements: returned lines of closed orders."""
    li = read(spark, sf_dir, "lineitem").filter((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "R"))
    return li.select(*task_key(), F.col("l_quantity").alias("IMPORTANCE_RAW"))


def task_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score table: one row per scored statement."""
    disc10, tax10 = F.col("l_discount") * 10, F.col("l_tax") * 10
    return read(spark, sf_dir, "lineitem").filter(scored_flag()).select(
        *task_key(), disc10.alias("AI_EXPOSURE_SCORE"), tax10.alias("AUTOMATION_SCORE"),
        (1 - disc10).alias("AUGMENTATION_SCORE"), (1 - tax10).alias("CONFIDENCE"))


def task_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """statements ⟕ importance ⟕ scores."""
    tasks = statements(spark, sf_dir)
    for more in (importance(spark, sf_dir), task_scores(spark, sf_dir)):
        tasks = tasks.join(more, list(TASK_KEYS), "left")
    return tasks


def enriched_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ orders ⋈ customer, narrowed to what both axis slices need
    (callers that build both may materialise it once and pass it in)."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # lines are joined last: the largest table is shuffled once
    return (li.join(o.join(c, F.col("o_custkey") == c.c_custkey), li.l_orderkey == o.o_orderkey)
              .select("l_partkey", "l_suppkey", "l_quantity", "c_nationkey", "c_mktsegment"))


def industry_slice(spark: SparkSession, sf_dir: str, enriched: DataFrame | None = None) -> DataFrame:
    """STG_BLS_OEWS_INDUSTRY stand-in: (NAICS, INDUSTRY_TITLE, OCC_CODE, TOT_EMP)."""
    e = enriched if enriched is not None else enriched_lines(spark, sf_dir)
    g = e.groupBy(F.col("c_mktsegment").alias("NAICS"), F.col("l_partkey").alias("OCC_CODE")).agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("TOT_EMP"))
    return g.select("NAICS", F.lower("NAICS").alias("INDUSTRY_TITLE"), "OCC_CODE", "TOT_EMP")


def region_slice(spark: SparkSession, sf_dir: str, enriched: DataFrame | None = None) -> DataFrame:
    """STG_BLS_OEWS_REGION stand-in: (GRANULARITY, AREA, AREA_TITLE, STATE,
    OCC_CODE, TOT_EMP).  Each line counts once per area type; one pass,
    partial aggregation right after the explode."""
    e = enriched if enriched is not None else enriched_lines(spark, sf_dir)
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = read(spark, sf_dir, "nation")
    sn = F.broadcast(n.select(F.col("n_nationkey").alias("sn_key"),
                              F.col("n_regionkey").alias("sn_region")))
    e = e.join(s, e.l_suppkey == s.s_suppkey).join(sn, F.col("s_nationkey") == F.col("sn_key"))
    areas = F.array(
        F.struct(F.lit("2").alias("AREA_TYPE"), F.col("s_nationkey").cast("int").alias("AREA")),
        F.struct(F.lit("4").alias("AREA_TYPE"), F.col("c_nationkey").cast("int").alias("AREA")),
        F.struct(F.lit("6").alias("AREA_TYPE"), F.col("sn_region").cast("int").alias("AREA")),
    )
    x = e.select(F.col("l_partkey").alias("OCC_CODE"), F.col("l_quantity"), F.inline(areas))
    g = x.groupBy("AREA_TYPE", "AREA", "OCC_CODE").agg(
        F.sum(F.col("l_quantity").cast("bigint")).alias("TOT_EMP"))
    return attach_area_titles(spark, sf_dir, g).select(
        label_case("AREA_TYPE", GRANULARITY_LABELS).alias("GRANULARITY"), "AREA", "AREA_TITLE",
        "STATE", "OCC_CODE", "TOT_EMP")


def attach_area_titles(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Area title and 'state' (parent region name) for (AREA_TYPE, AREA);
    nation (25 rows) and region (5 rows) are fixed-size dimensions."""
    n = read(spark, sf_dir, "nation")
    r = read(spark, sf_dir, "region")
    nat = n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("_k"), F.col("n_name").alias("_t"), F.col("r_name").alias("_s"))
    reg = r.select(F.col("r_regionkey").alias("_k"), F.col("r_name").alias("_t"),
                   F.col("r_name").alias("_s"))
    dims = (nat.select(F.lit("2").alias("_ty"), "*").unionByName(nat.select(F.lit("4").alias("_ty"), "*"))
            .unionByName(reg.select(F.lit("6").alias("_ty"), "*")))
    j = df.join(F.broadcast(dims), (df.AREA_TYPE == dims._ty) & (df.AREA == dims._k), "left")
    return j.withColumnRenamed("_t", "AREA_TITLE").withColumnRenamed("_s", "STATE").drop("_ty", "_k")


def newest_oews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``oews_like`` of its newest year.  The year is taken from ``orders`` alone
    and becomes a date range on that scan; a year whose orders join nothing is
    passed over."""
    dates = read(spark, sf_dir, "orders").select("o_orderdate")
    newest = dates.agg(F.max("o_orderdate")).first()[0]
    while newest is not None:
        year = newest.year
        df = oews_like(spark, sf_dir, year)
        if not df.isEmpty():
            return df
        newest = dates.filter(F.col("o_orderdate") < F.lit(f"{year}-01-01").cast("date")).agg(F.max("o_orderdate")).first()[0]
    return oews_like(spark, sf_dir).limit(0)


def oews_like(spark: SparkSession, sf_dir: str, year: int | None = None) -> DataFrame:
    """A typed OEWS-shaped relation (one row per line item) used by the slice
    and funnel operators: DATA_YEAR, AREA_TYPE, I_GROUP, OWN_CODE, O_GROUP,
    AREA, NAICS, OCC_CODE, TOT_EMP, A_MEDIAN.

    AREA_TYPE is the first character of o_orderpriority, I_GROUP is
    'cross-industry' for order status 'F', 'sector' otherwise, OWN_CODE is
    '1235' for return flag 'N', '5' otherwise; O_GROUP is 'detailed' unless
    the line status is 'O' ('broad')."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity",
                                                "l_returnflag", "l_linestatus", "l_extendedprice")
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate",
                                             "o_orderpriority", "o_orderstatus")
    if year is not None:
        o = o.filter((F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("date"))
                     & (F.col("o_orderdate") < F.lit(f"{year + 1}-01-01").cast("date")))
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(c, F.col("o_custkey") == c.c_custkey)
    return j.select(
        F.year("o_orderdate").alias("DATA_YEAR"),
        F.left(F.col("o_orderpriority"), F.lit(1)).alias("AREA_TYPE"),
        F.when(F.col("o_orderstatus") == "F", F.lit("cross-industry")).otherwise(F.lit("sector")).alias("I_GROUP"),
        F.when(F.col("l_returnflag") == "N", F.lit("1235")).otherwise(F.lit("5")).alias("OWN_CODE"),
        F.when(F.col("l_linestatus") == "O", F.lit("broad")).otherwise(F.lit("detailed")).alias("O_GROUP"),
        F.col("c_nationkey").alias("AREA"),
        F.col("c_mktsegment").alias("NAICS"),
        F.col("l_partkey").alias("OCC_CODE"),
        F.col("l_quantity").cast("bigint").alias("TOT_EMP"),
        F.col("l_extendedprice").alias("A_MEDIAN"),
    )
