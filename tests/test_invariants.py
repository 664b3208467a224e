"""Invariants: permutation/partitioning independence and the offline
validator's checks, on the smallest driver data."""

from pyspark.sql import functions as F

from indexkit.operators.rollup import mean_abs_diff, task_rollup
from indexkit.plans import index as ix
from indexkit.plans import standins as S

SF = "/root/testdata/sf0.001"


def _index(spark, tasks, base):
    return ix.build_index(base, tasks, weight_scale=S.WEIGHT_SCALE, value_scale=S.VALUE_SCALE,
                          norm_range=S.NORM_RANGE)


def test_permutation_and_partitioning_do_not_change_results(spark):
    base = S.base_occupations(spark, SF)
    tasks = S.task_statements(spark, SF)
    a = _index(spark, tasks, base).collect()
    shuffled = tasks.withColumn("_r", F.rand(11)).orderBy("_r").drop("_r").repartition(13)
    b = _index(spark, shuffled, base.repartition(3)).collect()
    key = lambda r: r["OCC_CODE"]
    assert sorted(map(tuple, a), key=lambda t: t[0]) == sorted(map(tuple, b), key=lambda t: t[0])
    assert len(a) == len({key(r) for r in a})


def test_validator_invariants(spark):
    idx = ix.build_index(S.base_occupations(spark, SF), S.task_statements(spark, SF),
                         weight_scale=S.WEIGHT_SCALE, value_scale=S.VALUE_SCALE, norm_range=S.NORM_RANGE)
    r = idx.agg(F.min("AI_EXPOSURE").alias("lo"), F.max("AI_EXPOSURE").alias("hi"),
                F.min("WAGE_PERCENTILE").alias("plo"), F.max("WAGE_PERCENTILE").alias("phi")).first()
    assert 0 <= r["lo"] <= r["hi"] <= 1 and r["plo"] == 0.0 and r["phi"] == 1.0
    reg = ix.axis_region(S.region_slice(spark, SF), idx)
    assert {x[0] for x in reg.select("GRANULARITY").distinct().collect()} == {"State", "Metropolitan",
                                                                              "Nonmetropolitan"}
    long = ix.axis_long(ix.axis_industry(S.industry_slice(spark, SF), idx), reg, ix.axis_wage_band(idx))
    bad = long.filter(~F.col("AI_EXPOSURE").between(0, 1) | ~F.col("EMP_COVERAGE").between(0, 1)).count()
    assert bad == 0
    # each granularity partitions the same line items: equal employment totals
    tot = {g: t for g, t in reg.groupBy("GRANULARITY").agg(F.sum("TOTAL_EMP")).collect()}
    assert len(set(tot.values())) == 1


def test_raw_and_normalised_weights_differ(spark):
    t = S.task_statements(spark, SF).filter(F.col("IMPORTANCE_RAW").isNotNull())
    raw = task_rollup(t, weight_scale=0, norm_range=S.NORM_RANGE)
    norm = task_rollup(t.withColumn("IMPORTANCE_RAW", F.col("IMPORTANCE_RAW") - 1), weight_scale=0,
                       norm_range=S.NORM_RANGE)
    d = mean_abs_diff(raw, norm, "OCC_CODE", "occ_AI_EXPOSURE_SCORE", "occ_AI_EXPOSURE_SCORE").first()
    assert d["n"] > 0 and d["mean_abs_diff"] > 0
