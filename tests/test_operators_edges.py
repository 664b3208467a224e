"""Edge cases from the blueprint's test list: constant and empty inputs,
zero weights, all-NULL metrics, run choice."""

import datetime as dt

from pyspark.sql import functions as F

from indexkit.operators import profile as PR
from indexkit.operators import relational as REL
from indexkit.operators.rollup import weighted_rollup


def test_histogram_edges(spark):
    const = spark.createDataFrame([(5.0,), (5.0,), (None,), (float("nan"),)], "v double")
    h = {r["bin"]: (r["bin_lo"], r["n"]) for r in PR.histogram(const, "v", 4).collect()}
    assert h[0] == (5.0, 2) and sum(n for _, n in h.values()) == 2      # hi == lo -> hi = lo + 1
    vals = spark.createDataFrame([(0.0,), (0.5,), (1.0,)], "v double")
    h = {r["bin"]: r["n"] for r in PR.histogram(vals, "v", 2).collect()}
    assert h == {0: 1, 1: 2}                                              # the maximum lands in the last bin


def test_choose_run(spark):
    t = dt.datetime
    runs = spark.createDataFrame([("a", t(2024, 1, 1)), ("b", t(2024, 2, 1))], "SCORING_RUN_ID string, LOADED_AT timestamp")
    assert REL.choose_run(runs, None).first()[0] == "b"
    empty = spark.createDataFrame([], "SCORING_RUN_ID string, APPROVED_AT timestamp")
    assert REL.choose_run(runs, empty).first()[0] == "b"
    one = spark.createDataFrame([("a", t(2024, 3, 1))], "SCORING_RUN_ID string, APPROVED_AT timestamp")
    assert REL.choose_run(runs, one).first()[0] == "a"
    two = spark.createDataFrame([("a", t(2024, 3, 1)), ("b", t(2024, 4, 1))],
                                "SCORING_RUN_ID string, APPROVED_AT timestamp")
    assert REL.choose_run(runs, two).first()[0] == "b"


def test_weighted_rollup_zero_weight_and_all_null(spark):
    rows = [("z", 0, 0.5), ("z", 0, 0.7), ("n", 10, None), ("n", 5, None), ("m", 3, 0.2), ("m", 1, None)]
    df = spark.createDataFrame(rows, "k string, w long, v double")
    out = {r["k"]: r for r in weighted_rollup(df, ["k"], "w", ["v"]).collect()}
    assert out["z"]["v"] is None and out["z"]["EMP_COVERAGE"] == 0.0     # zero weight: NULLIF -> NULL, DIV0 -> 0
    assert out["n"]["v"] is None and out["n"]["EMP_COVERAGE"] == 0.0     # no scored rows
    assert out["m"]["v"] == 0.2 and out["m"]["EMP_COVERAGE"] == 0.75 and out["m"]["TOTAL_EMP"] == 4


def test_funnel_single_pass(spark):
    df = spark.createDataFrame([(i, i % 2 == 0, i % 3 == 0) for i in range(12)], "i long, a boolean, b boolean")
    r = {x["step"]: (x["rows"], x["pct_of_start"]) for x in
         PR.funnel(df, [("a", F.col("a")), ("a and b", F.col("b"))]).collect()}
    assert r == {0: (12, 100.0), 1: (6, 50.0), 2: (2, 16.7)}
