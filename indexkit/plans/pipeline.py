"""The domain pipeline: landed raw text -> staging -> star schema -> index ->
axes -> quality -> refresh log (D01-D28).

Staging functions are lazy DataFrame definitions (the warehouse's views);
``rebuild`` runs them as steps that write Parquet (which also cuts lineage):
only descendants of a changed input are written, and a build is published as a
whole, so a refresh never leaves the fact in the placeholder shape while the
axes expect the index shape.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexkit.functions import clean as C
from indexkit.functions.bands import WAGE_BANDS, bands_frame
from indexkit.functions.numeric import exact_ratio
from indexkit.operators import quality as Q
from indexkit.operators import relational as REL
from indexkit.operators.rollup import placeholder_index, units
from indexkit.plans import index as ix
from indexkit.session import build_time
from indexkit.sources.publish import Publication, Step, append_once, content_digest, run_steps

# ------------------------------------------------------------------ staging


def stg_oews(raw: DataFrame) -> DataFrame:
    """D01 STG_BLS_OEWS: typed, cleaned; drops the all-occupations row (the
    comparison happens before trimming, as in the warehouse view)."""
    d = raw.filter(F.col("OCC_CODE").isNotNull() & (F.col("OCC_CODE") != C.TOTAL_OCC_CODE))
    return d.select(
        "DATA_YEAR",
        F.trim("OCC_CODE").alias("OCC_CODE"), F.trim("OCC_TITLE").alias("OCC_TITLE"),
        C.lower_trim("O_GROUP").alias("O_GROUP"), F.trim("AREA").alias("AREA"),
        F.trim("AREA_TITLE").alias("AREA_TITLE"), F.trim("AREA_TYPE").alias("AREA_TYPE"),
        F.trim("PRIM_STATE").alias("STATE"), F.trim("NAICS").alias("NAICS"),
        F.trim("NAICS_TITLE").alias("INDUSTRY_TITLE"), C.lower_trim("I_GROUP").alias("I_GROUP"),
        F.trim("OWN_CODE").alias("OWN_CODE"),
        C.parse_number("TOT_EMP", "decimal(38,0)").cast("bigint").alias("TOT_EMP"),
        *[C.parse_number(c).alias(c) for c in ("H_MEAN", "A_MEAN", "H_MEDIAN", "A_MEDIAN", "A_PCT10",
                                               "A_PCT25", "A_PCT75", "A_PCT90")])


def stg_national(oews: DataFrame) -> DataFrame:
    """D02: latest year, national, cross-industry, all owners, detailed."""
    return REL.slice_where(REL.latest_slice(oews, "DATA_YEAR"), AREA_TYPE="1", I_GROUP="cross-industry",
                           OWN_CODE="1235", O_GROUP="detailed")


def stg_industry(oews: DataFrame) -> DataFrame:
    """D03: latest year, national, sector, private, detailed."""
    return REL.slice_where(REL.latest_slice(oews, "DATA_YEAR"), AREA_TYPE="1", I_GROUP="sector",
                           OWN_CODE="5", O_GROUP="detailed")


def stg_region(oews: DataFrame) -> DataFrame:
    """D04: latest year, state / metro / nonmetro, cross-industry, detailed."""
    d = REL.slice_where(REL.latest_slice(oews, "DATA_YEAR"), AREA_TYPE=["2", "4", "6"],
                        I_GROUP="cross-industry", OWN_CODE="1235", O_GROUP="detailed")
    return d.withColumn("GRANULARITY", C.label_case("AREA_TYPE", C.GRANULARITY_LABELS))


def stg_statements(raw: DataFrame) -> DataFrame:
    """D05: typed statements; TASK_ID typed with a guarded cast."""
    d = raw.filter(F.col("ONET_SOC_CODE").isNotNull() & F.col("TASK_ID").isNotNull())
    return d.select(F.trim("ONET_SOC_CODE").alias("ONET_SOC_CODE"),
                    C.standardize_code("ONET_SOC_CODE").alias("OCC_CODE"),
                    C.parse_int("TASK_ID").alias("TASK_ID"), F.trim("TASK").alias("TASK_STATEMENT"),
                    F.trim("TASK_TYPE").alias("TASK_TYPE"))


def stg_ratings(raw: DataFrame) -> DataFrame:
    """D06: typed ratings with a numeric value."""
    d = raw.filter(F.col("ONET_SOC_CODE").isNotNull() & F.col("TASK_ID").isNotNull()
                   & C.parse_number("DATA_VALUE").isNotNull())
    return d.select(F.trim("ONET_SOC_CODE").alias("ONET_SOC_CODE"),
                    C.standardize_code("ONET_SOC_CODE").alias("OCC_CODE"),
                    C.parse_int("TASK_ID").alias("TASK_ID"), F.trim("SCALE_ID").alias("SCALE_ID"),
                    C.parse_number("DATA_VALUE").alias("DATA_VALUE"), C.parse_int("N").alias("N"),
                    F.trim("RECOMMEND_SUPPRESS").alias("RECOMMEND_SUPPRESS"))


def stg_importance(ratings: DataFrame) -> DataFrame:
    """D07: importance scale only, raw 1..5 and normalised 0..1."""
    return ratings.filter(F.col("SCALE_ID") == "IM").select(
        "OCC_CODE", "ONET_SOC_CODE", "TASK_ID", F.col("DATA_VALUE").alias("IMPORTANCE_RAW"),
        C.normalize("DATA_VALUE", 1.0, 5.0).alias("IMPORTANCE_NORM"))


def stg_tasks(statements: DataFrame, importance: DataFrame) -> DataFrame:
    """D08: statements ⟕ importance on (TASK_ID, ONET_SOC_CODE)."""
    return statements.join(importance.drop("OCC_CODE"), ["TASK_ID", "ONET_SOC_CODE"], "left")


def stg_scores(raw_scores: DataFrame, approved: DataFrame | None) -> DataFrame:
    """D09: the chosen run (approved, else newest), typed, guarded, deduped."""
    run = REL.choose_run(raw_scores.select("SCORING_RUN_ID", "LOADED_AT"), approved)
    # a scalar: only the folder of that run is read, and only its rows are parsed
    d = raw_scores.filter(F.col("SCORING_RUN_ID") == run.scalar())
    d = d.filter(C.is_blank("ERROR_MESSAGE") & C.parse_int(F.trim("TASK_ID")).isNotNull())
    d = d.select(
        C.parse_int(F.trim("TASK_ID")).alias("TASK_ID"), F.trim("ONET_SOC_CODE").alias("ONET_SOC_CODE"),
        C.standardize_code("ONET_SOC_CODE").alias("OCC_CODE"),
        *[C.parse_number(c).alias(c) for c in ("AI_EXPOSURE_SCORE", "AUTOMATION_SCORE",
                                               "AUGMENTATION_SCORE", "CONFIDENCE")],
        "RATIONALE", C.default_if_blank("REVIEW_STATUS", "unreviewed").alias("REVIEW_STATUS"),
        "SCORING_RUN_ID", "RUBRIC_VERSION", "RUBRIC_HASH", "PROMPT_VERSION", "MODEL_ID")
    d = Q.range_guard(d, ["AI_EXPOSURE_SCORE", "AUTOMATION_SCORE", "AUGMENTATION_SCORE"], 0.0, 1.0)
    order = ["AI_EXPOSURE_SCORE", "AUTOMATION_SCORE", "AUGMENTATION_SCORE", "CONFIDENCE", "RATIONALE",
             "REVIEW_STATUS", "RUBRIC_VERSION", "RUBRIC_HASH", "PROMPT_VERSION", "MODEL_ID", "OCC_CODE",
             "SCORING_RUN_ID"]
    return REL.dedupe_one(d, ["TASK_ID", "ONET_SOC_CODE"], order)


# ------------------------------------------------------------------ star schema


def dim_occupation(national: DataFrame) -> DataFrame:
    return national.select("OCC_CODE", "OCC_TITLE", "O_GROUP").distinct()


def dim_task(tasks: DataFrame) -> DataFrame:
    return tasks.select("TASK_ID", "OCC_CODE", "ONET_SOC_CODE", "TASK_STATEMENT", "TASK_TYPE",
                        "IMPORTANCE_RAW", "IMPORTANCE_NORM")


def dim_region(oews: DataFrame) -> DataFrame:
    """Newest attributes per AREA (total-order tie-break)."""
    cand = oews.filter(F.col("AREA").isNotNull()).select(
        "DATA_YEAR", "AREA", "AREA_TITLE", "STATE",
        C.label_case("AREA_TYPE", C.AREA_TYPE_LABELS, C.AREA_TYPE_OTHER).alias("AREA_TYPE_LABEL")).distinct()
    return REL.latest_per_key(cand, ["AREA"], [F.col("DATA_YEAR").desc(), F.col("AREA_TITLE"), F.col("STATE"),
                                               F.col("AREA_TYPE_LABEL")],
                              ["AREA_TITLE", "STATE", "AREA_TYPE_LABEL"])


def dim_industry(oews: DataFrame) -> DataFrame:
    cand = oews.filter(F.col("NAICS").isNotNull()).select("DATA_YEAR", "NAICS", "INDUSTRY_TITLE").distinct()
    return REL.latest_per_key(cand, ["NAICS"], [F.col("DATA_YEAR").desc(), F.col("INDUSTRY_TITLE")],
                              ["INDUSTRY_TITLE"])


def index_tasks(tasks: DataFrame, scores: DataFrame) -> DataFrame:
    """One row per statement with its importance (NULL if unrated) and scores."""
    s = scores.select("TASK_ID", "ONET_SOC_CODE", "AI_EXPOSURE_SCORE", "AUTOMATION_SCORE",
                      "AUGMENTATION_SCORE", "CONFIDENCE")
    return tasks.select("TASK_ID", "ONET_SOC_CODE", "OCC_CODE", "IMPORTANCE_RAW").join(
        s, ["TASK_ID", "ONET_SOC_CODE"], "left")


# ------------------------------------------------------------------ quality


def base_rules(national: DataFrame, statements: DataFrame, tasks: DataFrame, oews: DataFrame,
               fact: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The base rule set on the domain tables (checks 1-10)."""
    r = [Q.run_rules(oews, [
        Q.Rule(1, "missing occupation code in staging", "rows",
               F.count_if(C.is_blank("OCC_CODE")), Q.fail_if_positive)]),
         Q.run_rules(statements, [
        Q.Rule(2, "occupation code not standardised", "rows",
               F.count_if(F.col("OCC_CODE").isNull() | (F.length("OCC_CODE") != 7)), Q.fail_if_positive)])]
    occ = national.select("OCC_CODE").distinct()
    matched = REL.semi(occ, tasks.select("OCC_CODE"), "OCC_CODE")
    m = matched.agg(F.count(F.lit(1)).alias("_m")).crossJoin(occ.agg(F.count(F.lit(1)).alias("_t")))
    r.append(Q.run_rules(m, [Q.Rule(3, "occupations with tasks", "pct",
                                    F.max(exact_ratio(F.col("_m") * 100, F.col("_t"), 1)), Q.pass_at_least(80.0),
                                    tested=F.max(F.try_divide(F.col("_m") * 100.0, F.col("_t").cast("double"))))]))
    for name, (df, keys) in dims.items():
        d = REL.duplicate_keys(df, keys)
        r.append(Q.run_rules(d, [Q.Rule(4, f"duplicate keys in {name}", "keys", F.count(F.lit(1)),
                                        Q.fail_if_positive)]))
    r.append(Q.run_rules(fact, [
        Q.Rule(5, "invalid employment", "rows", F.count_if(F.col("TOT_EMP").isNull() | (F.col("TOT_EMP") <= 0)),
               Q.warn_if_positive),
        Q.Rule(6, "invalid wage", "rows", F.count_if(F.col("A_MEDIAN").isNull() | (F.col("A_MEDIAN") <= 0)),
               Q.warn_if_positive)]))
    r.append(Q.run_rules(fact, [Q.Rule(7, "exposure out of range", "rows",
                                       F.count_if(~F.col("AI_EXPOSURE").between(0, 1)), Q.fail_if_positive)]))
    cnt = fact.agg(F.count(F.lit(1)).alias("_after")).crossJoin(national.agg(F.count(F.lit(1)).alias("_before")))
    r.append(Q.run_rules(cnt, [
        Q.Rule(8, "fact row retention", "pct", F.max(exact_ratio(F.col("_after") * 100, F.col("_before"), 1)),
               Q.pass_at_least(90.0), tested=F.max(F.try_divide(F.col("_after") * 100.0, F.col("_before").cast("double")))),
        Q.Rule(8, "rows before", "rows", F.max("_before"), Q.info),
        Q.Rule(8, "rows after", "rows", F.max("_after"), Q.info)]))
    left_only, right_only = REL.key_diff(occ, tasks.select("OCC_CODE"), "OCC_CODE")
    r.append(Q.run_rules(left_only, [Q.Rule(9, "occupations without tasks", "keys", F.count(F.lit(1)), Q.info)]))
    r.append(Q.run_rules(right_only, [Q.Rule(10, "task codes without occupation", "keys", F.count(F.lit(1)),
                                             Q.info)]))
    return Q.union_results(*r)


def index_rules(scores: DataFrame, fact: DataFrame, industry: DataFrame, region: DataFrame,
                long: DataFrame) -> DataFrame:
    """The index rule set (checks 20-28) on the staged scores of the chosen run."""
    oor = None
    for m in ("AI_EXPOSURE_SCORE", "AUTOMATION_SCORE", "AUGMENTATION_SCORE"):
        c = ~F.col(m).between(0, 1)
        oor = c if oor is None else (oor | c)
    r = [Q.run_rules(scores, [Q.Rule(20, "task scores out of range", "rows", F.count_if(oor),
                                         Q.fail_if_positive)])]
    scored = F.col("SCORE_STATUS") == "SCORED"
    covered = F.sum(F.when(scored, units("IMPORTANCE_WEIGHT_COVERAGE", 4)))
    r.append(Q.run_rules(fact, [
        Q.Rule(21, "scored rows missing a sub-score", "rows",
               F.count_if(scored & (F.col("AI_EXPOSURE").isNull() | F.col("AUTOMATION").isNull()
                                    | F.col("AUGMENTATION").isNull())), Q.fail_if_positive),
        Q.Rule(22, "exposure mode", "occupations", F.count(F.lit(1)),
               lambda m: F.when(m == 1, F.lit("INFO")).otherwise(F.lit("WARN")),
               tested=F.max(F.when(F.col("EXPOSURE_MODE") == ix.REAL, 1).otherwise(0))),
        Q.Rule(23, "low coverage occupations", "rows", F.count_if(F.col("SCORE_STATUS") == "LOW_COVERAGE"), Q.info),
        Q.Rule(24, "mean weight coverage of scored", "pct", exact_ratio(covered * 100, F.count_if(scored) * 10000, 1),
               lambda m: F.when(m.isNull() | (m >= 0.8), F.lit("PASS")).otherwise(F.lit("WARN")),
               tested=F.try_divide(covered.cast("double"), F.count_if(scored) * 10000.0))]))
    e = industry.agg(F.sum("TOTAL_EMP").alias("_i")).crossJoin(fact.agg(F.sum("TOT_EMP").alias("_n")))
    r.append(Q.run_rules(e, [Q.Rule(25, "industry employment within the fact total", "pct",
                                    F.max(exact_ratio(F.col("_i") * 100, F.col("_n"), 1, zero=0)), Q.fail_above(0.0),
                                    tested=F.max(F.col("_i") - F.col("_n")))]))
    r.append(Q.run_rules(region, [
        Q.Rule(26, "granularities present", "count", F.count_distinct("GRANULARITY"),
               lambda m: F.when(m == 3, F.lit("PASS")).otherwise(F.lit("WARN"))),
        Q.Rule(27, "state area count", "count", F.count_if(F.col("GRANULARITY") == "State"),
               lambda m: F.when(m.between(50, 56), F.lit("PASS")).otherwise(F.lit("WARN")))]))
    bad = None
    for m in ix.AXIS_METRICS:
        c = ~F.col(m).between(0, 1)
        bad = c if bad is None else (bad | c)
    r.append(Q.run_rules(long, [Q.Rule(28, "axis values out of range", "rows", F.count_if(bad),
                                       Q.fail_if_positive)]))
    return Q.union_results(*r)


# ------------------------------------------------------------------ rebuild


@dataclass
class RawTables:
    oews: DataFrame
    statements: DataFrame
    ratings: DataFrame
    scores: DataFrame | None = None
    approved: DataFrame | None = None
    extra: dict = field(default_factory=dict)


class QualityFailure(RuntimeError):
    """A rebuild whose quality rules FAIL; ``tables`` holds what was built."""

    def __init__(self, fails: int, tables: dict):
        super().__init__(f"{fails} quality rule(s) failed")
        self.tables = tables


#: Changes when a table's definition does, so tables of older code are rebuilt.
VERSION = "4"

NO_SCORES = ("TASK_ID bigint, ONET_SOC_CODE string, AI_EXPOSURE_SCORE double, AUTOMATION_SCORE double, "
             "AUGMENTATION_SCORE double, CONFIDENCE double")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def sources_of(spark: SparkSession, raw: RawTables) -> tuple[dict, list[int]]:
    """Raw inputs with the digests of their rows, OEWS year by year, and the years."""
    years = content_digest(raw.oews, "DATA_YEAR")
    out = {f"raw_oews@{y}": (raw.oews.filter(F.col("DATA_YEAR") == y), d) for y, d in years.items() if y is not None}
    for name, df in (("raw_statements", raw.statements), ("raw_ratings", raw.ratings), ("raw_scores", raw.scores),
                     ("approved", raw.approved)):
        out[name] = (df, "none" if df is None else content_digest(df).get(None, "empty"))
    return out, sorted(y for y in years if y is not None)


def steps_of(spark: SparkSession, years: list[int], min_coverage: float, mode: str | None) -> list[Step]:
    """D01-D28 as steps.  OEWS is staged year by year; the slices read the
    newest year's table only, the dimensions all of them."""
    staged = tuple(f"stg_oews@{y}" for y in years)
    newest = staged[-1:]

    def scores(f):
        return spark.createDataFrame([], NO_SCORES) if f["raw_scores"] is None else stg_scores(f["raw_scores"], f["approved"])

    def newest_slice(pick):
        return lambda f: pick(f[newest[0]])

    def fact(f):
        now = mode or (ix.PLACEHOLDER if f["stg_scores"].isEmpty() else ix.REAL)
        base = f["stg_national"].select("OCC_CODE", "OCC_TITLE", "O_GROUP", "TOT_EMP", "A_MEAN", "A_MEDIAN")
        # scores are doubles of a text file: twelve decimals, so none ends a build
        return ix.build_index(base, index_tasks(f["stg_tasks"], f["stg_scores"]), min_coverage, now, value_scale=12)

    def long(f):
        return ix.axis_long(f["industry_exposure_fact"], f["region_exposure_fact"], f["wage_band_exposure_fact"])

    def quality(f):
        dims = {"dim_occupation": (f["dim_occupation"], ["OCC_CODE"]), "dim_region": (f["dim_region"], ["AREA"]),
                "dim_industry": (f["dim_industry"], ["NAICS"]), "dim_task": (f["dim_task"], ["TASK_ID", "ONET_SOC_CODE"])}
        dq = base_rules(f["stg_national"], stg_statements(f["raw_statements"]), f["stg_tasks"],
                        _union([f[s] for s in staged]), f["occupation_exposure_fact"], dims)
        # in placeholder mode too: the mode rule then warns
        dq = dq.unionByName(index_rules(f["stg_scores"], f["occupation_exposure_fact"], f["industry_exposure_fact"],
                                        f["region_exposure_fact"], f["vw_exposure_axis"]))
        return dq.withColumn("CHECKED_AT", build_time(spark))
    tasks = ("raw_statements", "raw_ratings")
    axes = ("industry_exposure_fact", "region_exposure_fact", "wage_band_exposure_fact")
    out = [Step(f"stg_oews@{y}", (f"raw_oews@{y}",), lambda f, y=y: stg_oews(f[f"raw_oews@{y}"])) for y in years]
    out += [
        Step("stg_national", newest, newest_slice(stg_national)),
        Step("stg_tasks", tasks, lambda f: stg_tasks(stg_statements(f["raw_statements"]), stg_importance(stg_ratings(f["raw_ratings"])))),
        Step("stg_scores", ("raw_scores", "approved"), scores),
        Step("dim_occupation", ("stg_national",), lambda f: dim_occupation(f["stg_national"])),
        Step("dim_task", ("stg_tasks",), lambda f: dim_task(f["stg_tasks"])),
        Step("dim_region", staged, lambda f: dim_region(_union([f[s] for s in staged]))),
        Step("dim_industry", staged, lambda f: dim_industry(_union([f[s] for s in staged]))),
        Step("dim_wage_band", (), lambda f: bands_frame(spark, WAGE_BANDS), str(WAGE_BANDS)),
        Step("ai_exposure_placeholder", ("stg_tasks",), lambda f: placeholder_index(f["stg_tasks"], weight_scale=2)),
        Step("occupation_exposure_fact", ("stg_national", "stg_tasks", "stg_scores"), fact, f"{min_coverage} {mode}"),
        Step("industry_occupation_exposure_fact", (*newest, "occupation_exposure_fact"), lambda f: ix.drill_fact(
            stg_industry(f[newest[0]]), f["occupation_exposure_fact"], "SECTOR_OCC_EMP", ["NAICS", "INDUSTRY_TITLE", "OCC_TITLE"])),
        Step("region_occupation_exposure_fact", (*newest, "occupation_exposure_fact"), lambda f: ix.drill_fact(
            stg_region(f[newest[0]]), f["occupation_exposure_fact"], "AREA_OCC_EMP",
            ["GRANULARITY", "AREA", "AREA_TITLE", "STATE", "OCC_TITLE"])),
        Step("industry_exposure_fact", ("industry_occupation_exposure_fact",), lambda f: ix.axis_rollup(
            f["industry_occupation_exposure_fact"], ["NAICS"], "SECTOR_OCC_EMP", ["INDUSTRY_TITLE"])),
        Step("region_exposure_fact", ("region_occupation_exposure_fact",), lambda f: ix.axis_rollup(
            f["region_occupation_exposure_fact"], ["GRANULARITY", "AREA"], "AREA_OCC_EMP", ["AREA_TITLE", "STATE"],
            rank_partition=["GRANULARITY"])),
        Step("wage_band_exposure_fact", ("occupation_exposure_fact",), lambda f: ix.axis_wage_band(f["occupation_exposure_fact"])),
        Step("vw_exposure_axis", axes, long),
        Step("dq_results", ("stg_national", "raw_statements", "stg_tasks", "stg_scores", *staged, "occupation_exposure_fact", *axes,
                            "dim_occupation", "dim_task", "dim_region", "dim_industry"), quality),
    ]
    return [Step(s.name, s.inputs, s.make, f"{VERSION} {s.params}") for s in out]


def rebuild(spark: SparkSession, raw: RawTables, out: str, min_coverage: float = ix.DEFAULT_MIN_COVERAGE,
            mode: str | None = None, build: str | None = None, publish_failed: bool = False) -> dict[str, DataFrame]:
    """D28: staging -> star -> index -> axes -> quality -> log, in order.

    Only tables whose inputs changed since the published build are written, and
    all become visible at once (``Publication(spark, out).table(name)``).  When
    a rule FAILs, results and log are kept, the old version stays published
    (unless ``publish_failed``) and ``QualityFailure`` carries the tables built.
    ``written`` among the returned names lists what this build wrote."""
    home = Publication(spark, out)
    b = home.begin(build)
    sources, years = sources_of(spark, raw)
    if not years:
        raise ValueError("no OEWS rows with a year")
    try:
        t = run_steps(b, sources, steps_of(spark, years, min_coverage, mode))
        t["placeholder"] = t["ai_exposure_placeholder"]
        t["verdict"] = v = Q.verdict(t["dq_results"])
        verdict_row = v.first()
        append_once(spark, os.path.join(out, "quality_history"), t["dq_results"], b.id)
        log = (spark.range(1).select(F.lit(years[-1]).alias("BLS_LATEST_YEAR"))
               .crossJoin(raw.oews.agg(F.count(F.lit(1)).alias("BLS_RAW_ROWS")))
               .crossJoin(raw.statements.agg(F.count(F.lit(1)).alias("ONET_TASK_ROWS")))
               .crossJoin(t["occupation_exposure_fact"].agg(F.count(F.lit(1)).alias("FACT_ROWS")))
               .crossJoin(t["dim_occupation"].agg(F.count_distinct("OCC_CODE").alias("OCCUPATIONS")))
               .crossJoin(v).withColumn("REFRESHED_AT", build_time(spark)))
        append_once(spark, os.path.join(out, "refresh_log"), log, b.id)
    except Exception:
        b.abandon()
        raise
    t["refresh_log"] = spark.read.parquet(os.path.join(out, "refresh_log"))
    t["written"] = spark.createDataFrame([(n,) for n in b.wrote], "TABLE_NAME string")
    if verdict_row["QUALITY_FAILS"] > 0 and not publish_failed:
        raise QualityFailure(verdict_row["QUALITY_FAILS"], t)
    if b.wrote:
        b.publish()
    if verdict_row["QUALITY_FAILS"] > 0:
        raise QualityFailure(verdict_row["QUALITY_FAILS"], t)
    return t
