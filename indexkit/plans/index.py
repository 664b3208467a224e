"""The occupation index and its axes (entry B of the blueprint).

``build_index`` is the flagship: statements with importance and scores are
rolled up per occupation (one partial+final hash aggregate), joined to the
national occupation slice, gated by coverage, ranked globally and banded.
Statements, importance and scores are three tables joined on the task key and
the occupation code.  All ranks are the one-exchange rank of
``operators.ranking``; axis ranks are taken on unrounded means.  The ranked
relation, one row per occupation, is written once, so the joins above it run
once and every axis reads the finished index.
``axis_*`` re-weight the national index by the employment of each industry /
area / wage band.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexkit.functions.bands import WAGE_BANDS, band_case, band_order_case
from indexkit.functions.numeric import div0
from indexkit.operators.ranking import rank_scaled
from indexkit.operators.rollup import task_rollup, weighted_rollup

REAL = "REAL_TASK_SCORE"
PLACEHOLDER = "PLACEHOLDER"
DEFAULT_MIN_COVERAGE = 0.80

METRICS = ("AI_EXPOSURE_SCORE", "AUTOMATION_SCORE", "AUGMENTATION_SCORE")

INDEX_COLUMNS = [
    "OCC_CODE", "OCC_TITLE", "O_GROUP", "TOT_EMP", "A_MEAN", "A_MEDIAN",
    "WAGE_PERCENTILE", "WAGE_BAND", "EXPOSURE_MODE", "SCORE_STATUS",
    "AI_EXPOSURE", "AUTOMATION", "AUGMENTATION", "EXPOSURE_CONFIDENCE",
    "WEIGHTED_EXPOSURE", "EXPOSURE_RANK", "rated_task_count", "scored_task_count",
    "TASK_COUNT_COVERAGE", "IMPORTANCE_WEIGHT_COVERAGE", "PLACEHOLDER_EXPOSURE",
]


def exposure_mode(scores: DataFrame, col: str = "AI_EXPOSURE_SCORE") -> DataFrame:
    """One row with the dataset-wide EXPOSURE_MODE: real as soon as the score
    table itself holds a score, whether or not it matches a task.  Lazy: a
    bounded probe (LIMIT 1 under the filter), no job while the plan is built."""
    probe = scores.filter(F.col(col).isNotNull()).select(col).limit(1).agg(F.count(F.lit(1)).alias("n"))
    return probe.select(F.when(F.col("n") > 0, REAL).otherwise(PLACEHOLDER).alias("EXPOSURE_MODE"))


def joined_tasks(statements: DataFrame, importance: DataFrame, scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """statements ⟕ importance ⟕ scores on the task key and occupation code:
    one row per statement, unrated and unscored ones included.  The three
    tables are shuffled on the same keys once."""
    return statements.join(importance, list(keys), "left").join(scores, list(keys), "left")


def build_index(base: DataFrame, tasks: DataFrame, min_coverage: float = DEFAULT_MIN_COVERAGE,
                mode: str | DataFrame | None = None, bands: Sequence = WAGE_BANDS,
                weight_scale: int = 2, value_scale: int = 6, norm_range=(1.0, 5.0)) -> DataFrame:
    """OCCUPATION_EXPOSURE_FACT (index form, 21 columns).

    base  : OCC_CODE, OCC_TITLE, O_GROUP, TOT_EMP, A_MEAN, A_MEDIAN (one row
            per occupation, the fact grain).
    tasks : one row per task statement: OCC_CODE, IMPORTANCE_RAW (NULL when
            unrated), AI_EXPOSURE_SCORE, AUTOMATION_SCORE, AUGMENTATION_SCORE,
            CONFIDENCE (NULL when unscored).
    mode  : 'REAL_TASK_SCORE' / 'PLACEHOLDER', a one-row frame with
            EXPOSURE_MODE (``exposure_mode`` of the score table), or None when
            the tasks are the only place scores are kept.
    """
    roll = task_rollup(tasks, "OCC_CODE", "IMPORTANCE_RAW", METRICS, "CONFIDENCE",
                       weight_scale, value_scale, norm_range)
    a = base.join(roll, "OCC_CODE", "left")
    if mode is None:
        mode = exposure_mode(tasks)
    if isinstance(mode, DataFrame):
        a = a.crossJoin(F.broadcast(mode.select("EXPOSURE_MODE").limit(1)))
    else:
        a = a.withColumn("EXPOSURE_MODE", F.lit(mode))

    rated = F.col("rated_task_count")
    real = F.col("EXPOSURE_MODE") == F.lit(REAL)
    # coverage compared unrounded, by cross-multiplication (exact); no weight
    # at all is no coverage
    low = (F.col("imp_total_u") == 0) | (F.col("imp_scored_u").cast("decimal(30,6)")
           < F.lit(min_coverage).cast("decimal(8,6)") * F.col("imp_total_u").cast("decimal(20,0)"))
    status = (F.when(rated.isNull() | (rated == 0), F.lit("NO_ONET"))
              .when(real & low, F.lit("LOW_COVERAGE"))
              .otherwise(F.lit("SCORED")))
    a = a.withColumn("SCORE_STATUS", status)
    scored = (F.col("SCORE_STATUS") == "SCORED") & real
    ph = F.col("placeholder_exposure")
    a = a.select(
        "OCC_CODE", "OCC_TITLE", "O_GROUP", "TOT_EMP", "A_MEAN", "A_MEDIAN",
        "EXPOSURE_MODE", "SCORE_STATUS", "rated_task_count", "scored_task_count",
        div0("scored_task_count", "rated_task_count").alias("TASK_COUNT_COVERAGE"),
        div0("imp_scored_u", "imp_total_u").alias("IMPORTANCE_WEIGHT_COVERAGE"),
        F.when(~real, ph).when(F.col("SCORE_STATUS") == "SCORED",
                               F.col("occ_AI_EXPOSURE_SCORE")).alias("AI_EXPOSURE"),
        F.when(scored, F.col("occ_AUTOMATION_SCORE")).alias("AUTOMATION"),
        F.when(scored, F.col("occ_AUGMENTATION_SCORE")).alias("AUGMENTATION"),
        F.when(scored, F.col("occ_confidence")).alias("EXPOSURE_CONFIDENCE"),
        F.col("placeholder_exposure").alias("PLACEHOLDER_EXPOSURE"),
    )
    r = a.filter(F.col("A_MEDIAN").isNotNull())
    r = rank_scaled(r, "A_MEDIAN", "WAGE_PERCENTILE", kind="percent_rank")
    # what a rank gives back reads written rows, so the second one samples them directly
    r = rank_scaled(r, "AI_EXPOSURE", "EXPOSURE_RANK", descending=True, nulls_first=False, scan=True)
    r = r.withColumn("WEIGHTED_EXPOSURE", F.col("AI_EXPOSURE") * F.col("TOT_EMP"))
    r = r.withColumn("WAGE_BAND", band_case("WAGE_PERCENTILE", bands))
    return r.select(*INDEX_COLUMNS)


def build_placeholder_fact(base: DataFrame, placeholder: DataFrame, bands: Sequence = WAGE_BANDS,
                           extra: Sequence[str] = ()) -> DataFrame:
    """OCCUPATION_EXPOSURE_FACT, placeholder form: national occupations with
    the importance proxy, wage percentile, band and exposure rank.  The rank
    puts NULL exposures first (DESC without NULLS, as the warehouse script
    left it implicit; see the README)."""
    e = base.join(placeholder.select("OCC_CODE", "AI_EXPOSURE", "SCORE_SOURCE"), "OCC_CODE", "left")
    r = e.filter(F.col("A_MEDIAN").isNotNull())
    r = rank_scaled(r, "A_MEDIAN", "WAGE_PERCENTILE", kind="percent_rank")
    r = rank_scaled(r, "AI_EXPOSURE", "EXPOSURE_RANK", descending=True, nulls_first=True, scan=True)
    r = (r.withColumn("WEIGHTED_EXPOSURE", F.col("AI_EXPOSURE") * F.col("TOT_EMP"))
          .withColumn("WAGE_BAND", band_case("WAGE_PERCENTILE", bands)))
    return r.select("OCC_CODE", "OCC_TITLE", "O_GROUP", "TOT_EMP", "A_MEAN", "A_MEDIAN",
                    "WAGE_PERCENTILE", "WAGE_BAND", "AI_EXPOSURE", "WEIGHTED_EXPOSURE",
                    "EXPOSURE_RANK", *extra, F.col("SCORE_SOURCE").alias("EXPOSURE_SOURCE"))


AXIS_METRICS = ("AI_EXPOSURE", "AUTOMATION", "AUGMENTATION")


def drill_fact(slice_df: DataFrame, index: DataFrame, emp_name: str,
               keep: Sequence[str]) -> DataFrame:
    """slice ⋈ index on OCC_CODE (the national index applied to the
    slice's employment).  Inner join: occupations without a wage are absent
    from the index and therefore from the axes."""
    idx = index.select("OCC_CODE", *AXIS_METRICS, "SCORE_STATUS", "EXPOSURE_MODE")
    s = slice_df.select(*keep, "OCC_CODE", F.col("TOT_EMP").alias(emp_name))
    return s.join(idx, "OCC_CODE")


def axis_rollup(drill: DataFrame, keys: Sequence[str], emp: str, labels: Sequence[str] = (),
                rank_partition: Sequence[str] | None = (), rank: bool = True) -> DataFrame:
    """Employment-weighted rollup of the index along one axis + exposure rank.

    The rank is taken on the unrounded mean, exactly: means that agree in four
    decimals only are not ties, equal quotients always are."""
    g = weighted_rollup(drill, keys, emp, AXIS_METRICS, labels=(*labels, "EXPOSURE_MODE"),
                        coverage_metric="AI_EXPOSURE", unrounded="AI_EXPOSURE")
    if rank:
        g = rank_scaled(g, "_unrounded", "EXPOSURE_RANK", descending=True, nulls_first=False,
                        partition_by=tuple(rank_partition or ()))
    return g.drop("_unrounded")


def axis_industry(industry_slice: DataFrame, index: DataFrame) -> DataFrame:
    """INDUSTRY_EXPOSURE_FACT."""
    d = drill_fact(industry_slice, index, "SECTOR_OCC_EMP", ["NAICS", "INDUSTRY_TITLE"])
    g = axis_rollup(d, ["NAICS"], "SECTOR_OCC_EMP", ["INDUSTRY_TITLE"])
    return g.select("NAICS", "INDUSTRY_TITLE", "EXPOSURE_MODE", "TOTAL_EMP", "OCC_COUNT",
                    "EMP_COVERAGE", *AXIS_METRICS, "EXPOSURE_RANK")


def axis_region(region_slice: DataFrame, index: DataFrame) -> DataFrame:
    """REGION_EXPOSURE_FACT: one row per (GRANULARITY, AREA), ranked within
    the granularity."""
    d = drill_fact(region_slice, index, "AREA_OCC_EMP", ["GRANULARITY", "AREA", "AREA_TITLE", "STATE"])
    g = axis_rollup(d, ["GRANULARITY", "AREA"], "AREA_OCC_EMP", ["AREA_TITLE", "STATE"],
                    rank_partition=["GRANULARITY"])
    return g.select("GRANULARITY", "AREA", "AREA_TITLE", "STATE", "EXPOSURE_MODE", "TOTAL_EMP",
                    "OCC_COUNT", "EMP_COVERAGE", *AXIS_METRICS, "EXPOSURE_RANK")


def axis_wage_band(index: DataFrame, bands: Sequence = WAGE_BANDS) -> DataFrame:
    """WAGE_BAND_EXPOSURE_FACT: bands with NULL band excluded; no rank, the
    band order is joined from the static dimension."""
    d = index.filter(F.col("WAGE_BAND").isNotNull())
    g = axis_rollup(d, ["WAGE_BAND"], "TOT_EMP", rank=False)
    g = g.withColumn("BAND_ORDER", band_order_case("WAGE_BAND", bands))
    return g.select("WAGE_BAND", "EXPOSURE_MODE", "BAND_ORDER", "TOTAL_EMP", "OCC_COUNT",
                    "EMP_COVERAGE", *AXIS_METRICS)


def axis_long(industry: DataFrame, region: DataFrame, wage: DataFrame) -> DataFrame:
    """VW_EXPOSURE_AXIS: the three axes in one long shape (UNION ALL)."""
    cols = ["AXIS_TYPE", "GRANULARITY", "AXIS_KEY", "AXIS_LABEL", *AXIS_METRICS,
            "TOTAL_EMP", "EMP_COVERAGE", "EXPOSURE_RANK", "EXPOSURE_MODE"]
    i = industry.select(F.lit("INDUSTRY").alias("AXIS_TYPE"), F.lit("n/a").alias("GRANULARITY"),
                        F.col("NAICS").cast("string").alias("AXIS_KEY"),
                        F.col("INDUSTRY_TITLE").alias("AXIS_LABEL"), *AXIS_METRICS, "TOTAL_EMP",
                        "EMP_COVERAGE", "EXPOSURE_RANK",
                        "EXPOSURE_MODE")
    r = region.select(F.lit("REGION").alias("AXIS_TYPE"), "GRANULARITY",
                      F.col("AREA").cast("string").alias("AXIS_KEY"),
                      F.col("AREA_TITLE").alias("AXIS_LABEL"), *AXIS_METRICS, "TOTAL_EMP",
                      "EMP_COVERAGE", "EXPOSURE_RANK",
                      "EXPOSURE_MODE")
    w = wage.select(F.lit("WAGE_BAND").alias("AXIS_TYPE"), F.lit("n/a").alias("GRANULARITY"),
                    F.col("WAGE_BAND").alias("AXIS_KEY"), F.col("WAGE_BAND").alias("AXIS_LABEL"),
                    *AXIS_METRICS, "TOTAL_EMP", "EMP_COVERAGE",
                    F.col("BAND_ORDER").cast("bigint").alias("EXPOSURE_RANK"), "EXPOSURE_MODE")
    return i.select(*cols).unionByName(r.select(*cols)).unionByName(w.select(*cols))


def axis_explorer(long_df: DataFrame, axis: str, granularity: str | None = None,
                  n: int = 0) -> DataFrame:
    """Filter one axis (and granularity), sort by exposure desc, top n (0 = all)."""
    d = long_df.filter(F.col("AXIS_TYPE") == axis)
    if granularity:
        d = d.filter(F.col("GRANULARITY") == granularity)
    d = d.orderBy(F.col("AI_EXPOSURE").desc_nulls_last(), F.col("AXIS_KEY").asc())
    return d.limit(n) if n else d
