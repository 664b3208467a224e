"""Distributed ranks equal the plain window on every row (ties, NULLs, skew)."""

import random

import pytest
from pyspark.sql import functions as F

from indexkit.operators import ranking as R


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        v = None if rnd.random() < 0.1 else float(rnd.randint(0, 60))
        if rnd.random() < 0.3:
            v = 42.0                                    # one hot value: a third of the rows
        rows.append((i, rnd.choice(["a", "b", "c"]), v))
    return spark.createDataFrame(rows, "id long, g string, v double").repartition(5)


def _cmp(a, b, col):
    x = {r["id"]: r[col] for r in a.select("id", col).collect()}
    y = {r["id"]: r[col] for r in b.select("id", col).collect()}
    assert x == y


@pytest.mark.parametrize("descending,nulls_first", [(False, True), (False, False), (True, True), (True, False)])
def test_rank_matches_window(data, descending, nulls_first):
    a = R.rank_scaled(data, "v", "r", descending=descending, nulls_first=nulls_first, buckets=7)
    b = R.rank_window(data, "v", "r", descending=descending, nulls_first=nulls_first)
    _cmp(a, b, "r")


@pytest.mark.parametrize("kind", ["percent_rank", "average"])
def test_other_kinds(data, kind):
    a = R.rank_scaled(data, "v", "r", kind=kind, buckets=5)
    b = R.rank_window(data, "v", "r", kind=kind, nulls_first=True)
    _cmp(a, b, "r")


def test_partitioned(data):
    a = R.rank_scaled(data, "v", "r", kind="average", partition_by=["g"], buckets=4)
    b = R.rank_window(data, "v", "r", kind="average", partition_by=["g"], nulls_first=True)
    _cmp(a, b, "r")


def test_single_row_percent_rank_is_zero(spark):
    df = spark.createDataFrame([(1, 5.0)], "id long, v double")
    assert R.rank_scaled(df, "v", "p", kind="percent_rank").first()["p"] == 0.0


def test_scaled_plan_has_no_single_partition(data):
    a = R.rank_scaled(data, "v", "r")
    lines = a._jdf.queryExecution().executedPlan().toString().splitlines()
    # every single-partition exchange carries aggregated rows (global totals,
    # percentile bounds, per-bucket totals) - never the ranked rows themselves
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in lines[i + 1], lines[i:i + 3]
    b = R.rank_window(data, "v", "r")
    blines = b._jdf.queryExecution().executedPlan().toString().splitlines()
    assert any("Exchange SinglePartition" in x and "Aggregate" not in blines[i + 1]
               for i, x in enumerate(blines[:-1]))


def test_null_partition_key_is_a_partition(spark):
    rows = [(None, 3.0), (None, 1.0), ("a", 2.0), ("a", None), (None, 1.0), ("b", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for kind in ("rank", "percent_rank", "average"):
        a = R.rank_scaled(df, "v", "r", kind=kind, partition_by=["g"], nulls_first=True)
        b = R.rank_window(df, "v", "r", kind=kind, partition_by=["g"], nulls_first=True)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_ranks_are_bigint_and_buckets_follow_shuffle_partitions(spark, data):
    assert dict(R.rank_scaled(data, "v", "r").dtypes)["r"] == "bigint"
    assert R.range_buckets(data) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_index_ranks_equal_window(spark):
    from indexkit.plans.queries import occupation_index_df
    df = occupation_index_df(spark, "/root/testdata/sf0.001").select("OCC_CODE", "A_MEDIAN", "AI_EXPOSURE", "EXPOSURE_RANK", "WAGE_PERCENTILE")
    df = R.rank_window(df, "AI_EXPOSURE", "r", descending=True, nulls_first=False)
    df = R.rank_window(df, "A_MEDIAN", "p", kind="percent_rank", nulls_first=True)
    rows = df.collect()
    assert rows and all(r["r"] == r["EXPOSURE_RANK"] and r["p"] == r["WAGE_PERCENTILE"] for r in rows)


def test_latest_per_key_hot_key(spark):
    """A key with most of the rows: the salted two-pass row_number keeps the
    same row a single window would."""
    from indexkit.operators import relational as REL
    rows = [(0 if i % 3 else i, i % 97, float(i % 13)) for i in range(6000)]
    df = spark.createDataFrame(rows, "k long, a long, b double")
    got = {r["k"]: (r["a"], r["b"]) for r in REL.latest_per_key(df, ["k"], [F.col("b").desc()], ["a", "b"]).collect()}
    want = {}
    for k, a, b in rows:
        cand = (-b, a)
        if k not in want or cand < want[k][0]:
            want[k] = (cand, (a, b))
    assert got == {k: v[1] for k, v in want.items()}


@pytest.mark.parametrize("buckets", [1, 3, 40])
@pytest.mark.parametrize("kind", ["rank", "percent_rank", "average"])
def test_runs_and_partitions_that_cross_ranges(spark, buckets, kind):
    """One value and one partition key with most rows, NaN, NULL keys and
    values: every count crosses range borders."""
    rnd = random.Random(buckets)
    rows = [(i, rnd.choice(["hot"] * 6 + ["b", None]), rnd.choice([5.0] * 8 + [None, float("nan"), -1.0, 0.0, 9.5])) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, g string, v double").repartition(6)
    for parts in ([], ["g"]):
        for descending in (False, True):
            for nulls_first in (False, True):
                if kind != "rank" and (descending or not nulls_first):
                    continue
                a = R.rank_scaled(df, "v", "r", descending, nulls_first, kind, buckets, parts)
                b = R.rank_window(df, "v", "r", descending, nulls_first, parts, kind)
                _cmp(a, b, "r")


def test_text_and_decimal_values_and_an_empty_table(spark):
    rnd = random.Random(2)
    rows = [(i, rnd.choice(["ä", "b", "", None, "bb"]), rnd.choice([1, 2, None, 10])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, s string, n int").withColumn("d", F.col("n").cast("decimal(30,4)"))
    for c in ("s", "d"):
        _cmp(R.rank_scaled(df, c, "r", buckets=9), R.rank_window(df, c, "r"), "r")
    assert R.rank_scaled(df.limit(0), "s", "r").count() == 0
    assert R.rank_scaled(df.limit(0), "s", "r", partition_by=["n"]).count() == 0


def test_rank_plan_has_one_range_exchange_and_no_join_on_values(spark, data):
    """Reading the written rows back: one lookup by range number, no shuffle of rows."""
    plan = R.rank_scaled(data, "v", "r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_written_folders_are_removed(spark, data):
    import os

    from indexkit.session import _WRITTEN, discard_written
    R.rank_scaled(data, "v", "r").count()
    paths = list(_WRITTEN[spark.sparkContext.applicationId])
    assert discard_written(spark) == len(paths) and not any(os.path.exists(p) for p in paths)
