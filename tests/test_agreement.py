"""Agreement on joint tables against the plain formulas."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from indexkit.operators import agreement as AG
from indexkit.operators import ranking as R


def ranks(v):
    s = sorted(v)
    return [s.index(x) + (s.count(x) + 1) / 2 for x in v]


def pearson(x, y):
    mx, my = statistics.fmean(x), statistics.fmean(y)
    d = (sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)) ** 0.5
    return None if d == 0 else round(sum((a - mx) * (b - my) for a, b in zip(x, y)) / d, 6)


def test_report_equals_formulas(spark):
    rng = random.Random(3)
    data = [(g, rng.choice([0.1, 0.3333, 0.5, 0.6667, 1.0]), rng.choice([0.0, 0.25, 0.3333, 0.9])) for g in "abc" for _ in range(150)]
    data += [("one", 0.5, 0.2), ("flat", 0.5, 0.1), ("flat", 0.5, 0.7)]
    df = spark.createDataFrame(data, "metric string, x double, y double").repartition(5)
    got = {r.metric: r for r in AG.agreement_report(df, ["metric"]).collect()}
    band = lambda v: (v >= 0.3333) + (v >= 0.6667)
    for g in {d[0] for d in data}:
        x, y = [d[1] for d in data if d[0] == g], [d[2] for d in data if d[0] == g]
        r = got[g]
        assert r.n == len(x) and abs(r.mae - sum(abs(a - b) for a, b in zip(x, y)) / len(x)) < 1e-6
        assert r.pearson == pearson(x, y) and r.spearman == pearson(ranks(x), ranks(y))
        assert abs(r.band_agreement - sum(band(a) == band(b) for a, b in zip(x, y)) / len(x)) < 1e-6


def test_joint_table_is_all_that_is_ranked(spark):
    """A million equal pairs are one row before any rank is taken."""
    df = spark.range(200_000).select(F.lit("m").alias("metric"), (F.col("id") % 3 / 10.0).alias("x"), (F.col("id") % 2 / 10.0).alias("y"))
    assert AG.joint_table(df).count() == 6
    plan = AG.rank_correlation(AG.joint_table(df), ["metric"])._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan            # the pairs are behind written tables


@pytest.mark.parametrize("buckets", [1, 5])
def test_weighted_counts_equal_repeated_rows(spark, buckets):
    rng = random.Random(1)
    data = [(rng.choice("ab"), rng.choice([None, 1, 2, 3, 7]), rng.randint(1, 9), k) for k in range(80)]
    df = spark.createDataFrame(data, "g string, v int, n long, k int").repartition(4)
    got = {r.k: (r._before, r._ties, r._n, r._nulls) for r in R.counted(df, "v", ["g"], buckets, weight="n").collect()}
    for g, v, _, k in data:
        own = [(w, m) for h, w, m, _ in data if h == g]
        low = lambda w: -1 if w is None else w
        assert got[k] == (sum(m for w, m in own if low(w) < low(v)), sum(m for w, m in own if w == v),
                          sum(m for _, m in own), sum(m for w, m in own if w is None))


def test_annotators_is_the_highest_present(spark):
    assert AG.annotators(["ai_annot1", "ai_annot3", "x"], "ai") == 3 and AG.annotators(["x"], "ai") == 0
    human = spark.createDataFrame([(1, 0.2, 0.4), (2, None, 0.5), (3, 0.1, None), (9, 0.3, 0.3)], "k int, ai_annot1 double, ai_annot3 double")
    model = spark.createDataFrame([(1, 0.3, None), (2, 0.5, ""), (3, 0.2, "timeout"), (4, 0.1, None)], "k int, s double, ERROR_MESSAGE string")
    got = {r.comparison: r for r in AG.calibration(human, model, model, ["k"], {"ai": "s"}).collect()}
    assert got["human_model"].n == 2 and got["human_model"].mae == 0.0
    assert got["retest"].n == 2 and "annotators" not in got
