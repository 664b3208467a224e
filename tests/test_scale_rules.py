"""Exactness and load rules that only show beyond the sizes of the test tables."""

import os

import pytest
from pyspark.sql.types import StringType, StructField, StructType

from indexkit.functions.numeric import exact_ratio
from indexkit.operators.rollup import weighted_rollup
from indexkit.session import _scratch
from indexkit.sources import ingest as I
from indexkit.streaming import incremental as INC


def test_huge_weight_sums_neither_overflow_nor_round(spark):
    df = spark.createDataFrame([("a", 10 ** 13, 0.25), ("a", 2 * 10 ** 13, 0.5), ("a", 10 ** 6, 0.123457)], "k string, w long, v double")
    r = weighted_rollup(df, ["k"], "w", ["v"]).first()
    assert r["TOTAL_EMP"] == 3 * 10 ** 13 + 10 ** 6 and r["v"] == 0.4167 and r["EMP_COVERAGE"] == 1.0


def test_fractional_weights_and_six_decimal_scores_count(spark):
    df = spark.createDataFrame([("a", 0.4, 0.000001), ("a", 0.4, 1.0), ("b", 0.5, None)], "k string, w double, v double")
    r = {x["k"]: x for x in weighted_rollup(df, ["k"], "w", ["v"], digits=6).collect()}
    assert r["a"]["TOTAL_EMP"] == 0.8 and r["a"]["v"] == 0.500001 and r["b"]["v"] is None and r["b"]["EMP_COVERAGE"] == 0.0


def test_more_decimals_than_kept_are_an_error(spark):
    df = spark.createDataFrame([("a", 1, 0.12345678)], "k string, w long, v double")
    with pytest.raises(Exception, match="more than 6 decimals"):
        weighted_rollup(df, ["k"], "w", ["v"]).collect()


def test_ranks_use_means_that_agree_when_rounded(spark):
    from indexkit.plans.index import axis_rollup
    df = spark.createDataFrame([("x", 100000, 0.50001, "R"), ("y", 100000, 0.50002, "R")],
                               "NAICS string, e long, AI_EXPOSURE double, EXPOSURE_MODE string")
    df = df.selectExpr("*", "AI_EXPOSURE AS AUTOMATION", "AI_EXPOSURE AS AUGMENTATION")
    got = {r["NAICS"]: (r["AI_EXPOSURE"], r["EXPOSURE_RANK"]) for r in axis_rollup(df, ["NAICS"], "e").collect()}
    assert got == {"x": (0.5, 2), "y": (0.5, 1)}


def test_exact_ratio_half_up(spark):
    rows = [(10 ** 15 * 3, 10 ** 19), (1, 8), (-1, 8), (5, 0), (20001, 20000)]
    got = spark.createDataFrame([(str(a), str(b)) for a, b in rows], "a string, b string").selectExpr(
        "cast(a as decimal(38,0)) a", "cast(b as decimal(38,0)) b").select(exact_ratio("a", "b", 2)).collect()
    assert [r[0] for r in got] == [0.0, 0.13, -0.13, None, 1.0]


def test_zero_importance_is_low_coverage(spark):
    from indexkit.plans import index as ix
    base = spark.createDataFrame([("a", "A", "g", 5, 1.0, 1.0)], "OCC_CODE string, OCC_TITLE string, O_GROUP string, TOT_EMP int, A_MEAN double, A_MEDIAN double")
    tasks = spark.createDataFrame([("a", 0.0, 0.5, 0.5, 0.5, 0.5)], "OCC_CODE string, IMPORTANCE_RAW double, AI_EXPOSURE_SCORE double, "
                                  "AUTOMATION_SCORE double, AUGMENTATION_SCORE double, CONFIDENCE double")
    r = ix.build_index(base, tasks).first()
    assert (r["SCORE_STATUS"], r["IMPORTANCE_WEIGHT_COVERAGE"], r["AI_EXPOSURE"]) == ("LOW_COVERAGE", 0.0, None)
    # the mode comes from the score table, also when no score meets a task
    other = spark.createDataFrame([(0.3,)], "AI_EXPOSURE_SCORE double")
    assert ix.exposure_mode(other).first()[0] == ix.REAL and ix.exposure_mode(other.limit(0)).first()[0] == ix.PLACEHOLDER


def _csv(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_a_second_file_of_a_year_adds_its_rows(spark, scratch):
    schema = StructType([StructField("y", StringType()), StructField("v", StringType())])
    load = lambda **kw: INC.load_new_files(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ledger", schema,
                                           options={"header": True}, partition_by=["y"], **kw)
    _csv(f"{scratch}/in/a.csv", ["y,v", *[f"2024,{k}" for k in range(5)]])
    load()
    _csv(f"{scratch}/in/b.csv", ["y,v", *[f"2024,{k}" for k in range(3)]])
    load()
    load()
    assert spark.read.parquet(f"{scratch}/out").count() == 8
    _csv(f"{scratch}/in2/c.csv", ["y,v", "2024,9"])
    INC.load_new_files(spark, f"{scratch}/in2", f"{scratch}/out2", f"{scratch}/ledger2", schema, options={"header": True},
                       partition_by=["y"], replace_partitions=True)
    assert spark.read.parquet(f"{scratch}/out2").count() == 1


def test_landing_a_bad_file_twice_quarantines_it_once(spark, scratch):
    schema = StructType([StructField("a", StringType()), StructField("b", StringType())])
    _csv(f"{scratch}/x.csv", ["a,b", "1,2", "3,4,5", "6,7"])
    for _ in range(2):
        got = I.land_delimited(spark, f"{scratch}/x.csv", schema, f"{scratch}/good", f"{scratch}/bad")
        assert got == {"rows": 2, "quarantined": 1}
    assert spark.read.parquet(f"{scratch}/bad").count() == 1


def test_a_cluster_needs_a_shared_folder():
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h", ""):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            _scratch(master)
    assert os.path.isdir(_scratch("local[2]"))
