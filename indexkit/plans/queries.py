"""Registered queries over the driver tables (one per operator group).

Every query reads the whole driver tables (or data Spark derives from them);
the matching DuckDB SQL lives next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from indexkit.plans import index as ix
from indexkit.plans import oracle as O
from indexkit.plans import standins as S
from indexkit.plans.registry import query
from indexkit.session import written


def occupation_index_df(spark: SparkSession, sf_dir: str, scores: DataFrame | None = None) -> DataFrame:
    scores = S.task_scores(spark, sf_dir) if scores is None else scores
    tasks = ix.joined_tasks(S.statements(spark, sf_dir), S.importance(spark, sf_dir), scores, S.TASK_KEYS)
    return ix.build_index(S.base_occupations(spark, sf_dir), tasks, mode=ix.exposure_mode(scores),
                          weight_scale=S.WEIGHT_SCALE, value_scale=S.VALUE_SCALE, norm_range=S.NORM_RANGE)


@query("occupation_index", O.occupation_index_sql(),
       ids=("D17", "P17", "P18", "P19", "W01", "W03", "J04", "J06", "J07", "J10", "A01", "A02", "A03", "A04"))
def q_occupation_index(spark, sf_dir):
    return occupation_index_df(spark, sf_dir)


@query("occupation_index_placeholder", O.occupation_index_sql(scores="l_discount < 0"),
       ids=("D17", "P17", "P18", "J10", "D10"))
def q_occupation_index_placeholder(spark, sf_dir):
    """The same index while the score table holds no score yet."""
    return occupation_index_df(spark, sf_dir, S.task_scores(spark, sf_dir).filter("AI_EXPOSURE_SCORE < 0"))


def axes(spark, sf_dir):
    """The index and both ranked axes.  Index and joined lines are written once
    and read by both."""
    idx = written(occupation_index_df(spark, sf_dir), "index")
    lines = written(S.enriched_lines(spark, sf_dir), "lines")
    return idx, ix.axis_industry(S.industry_slice(spark, sf_dir, lines), idx), \
        ix.axis_region(S.region_slice(spark, sf_dir, lines), idx)


@query("axis_industry", O.axis_industry_sql(), ids=("A05", "A10", "A11", "J05", "W03", "D18", "D19"))
def q_axis_industry(spark, sf_dir):
    return ix.axis_industry(S.industry_slice(spark, sf_dir), occupation_index_df(spark, sf_dir))


@query("axis_region", O.axis_region_sql(), ids=("A06", "W04", "J05", "P07", "D20", "D21"))
def q_axis_region(spark, sf_dir):
    return ix.axis_region(S.region_slice(spark, sf_dir), occupation_index_df(spark, sf_dir))


@query("axis_wage_band", O.axis_wage_band_sql(), ids=("A07", "J13", "D22"))
def q_axis_wage_band(spark, sf_dir):
    return ix.axis_wage_band(occupation_index_df(spark, sf_dir))


@query("axis_long", O.axis_long_sql(), ids=("U01", "D23"))
def q_axis_long(spark, sf_dir):
    idx, ind, reg = axes(spark, sf_dir)
    return ix.axis_long(ind, reg, ix.axis_wage_band(idx))


@query("axis_explorer", f"""
SELECT * FROM ({O.axis_long_sql()}) a WHERE AXIS_TYPE = 'REGION' AND GRANULARITY = 'State'
ORDER BY AI_EXPOSURE DESC NULLS LAST, AXIS_KEY LIMIT 10""", ids=("T06",))
def q_axis_explorer(spark, sf_dir):
    idx, ind, reg = axes(spark, sf_dir)
    return ix.axis_explorer(ix.axis_long(ind, reg, ix.axis_wage_band(idx)), "REGION", "State", 10)
