"""Run ledger: batches are committed once, whatever breaks in between."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from indexkit.operators import relational as REL
from indexkit.operators import scoring as SC
from indexkit.sources import publish as PB

SCHEMA = "k long, s double, ERROR_MESSAGE string"


def scorer(fail: str | None = None, errors=()):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if fail and os.path.exists(fail) and (pdf["k"] % 7 == 3).any():
            raise RuntimeError("model client lost")
        bad = pdf["k"].isin(list(errors))
        return pd.DataFrame({"k": pdf["k"], "s": pdf["k"] / 100.0, "ERROR_MESSAGE": ["timeout" if b else None for b in bad]})
    return run


def test_broken_run_is_resumed_without_doubles(spark, scratch):
    work = spark.range(40).withColumnRenamed("id", "k")
    flag = os.path.join(scratch, "down")
    open(flag, "w").close()
    ledger = SC.RunLedger(spark, os.path.join(scratch, "runs"), "r1", ["k"])
    with pytest.raises(Exception, match="model client lost"):
        ledger.score(work, scorer(flag), SCHEMA, batches=6)
    kept = ledger.rows()
    before = 0 if kept is None else kept.count()
    assert before < 40
    os.remove(flag)
    # the resumed attempt keeps its six batches, whatever is asked now
    ledger.score(work, scorer(flag), SCHEMA, batches=2)
    got = sorted(r.k for r in ledger.rows().collect())
    assert got == list(range(40))
    assert {n for _, n in ledger.committed()} == {6}
    assert ledger.score(work, scorer(flag), SCHEMA, batches=6) == 0


def test_error_rows_are_scored_again_in_a_new_attempt(spark, scratch):
    work = spark.range(10).withColumnRenamed("id", "k")
    ledger = SC.RunLedger(spark, os.path.join(scratch, "runs"), "r1", ["k"])
    assert ledger.score(work, scorer(errors=(2, 5)), SCHEMA, batches=3) == 3
    assert ledger.score(work, scorer(), SCHEMA, batches=3) == 3
    rows = ledger.rows().collect()
    assert sorted(r.k for r in rows) == sorted([*range(10), 2, 5])
    assert sorted(r.k for r in rows if r.ERROR_MESSAGE is None) == list(range(10))
    other = SC.RunLedger(spark, os.path.join(scratch, "runs"), "r2", ["k"])
    assert other.rows() is None


def test_late_writer_of_a_committed_batch_adds_nothing(spark, scratch):
    work = spark.range(6).withColumnRenamed("id", "k")
    ledger = SC.RunLedger(spark, os.path.join(scratch, "runs"), "r1", ["k"])
    ledger.score(work, scorer(), SCHEMA, batches=1)
    late = SC.score_worklist(work, scorer(), SC.StructType.fromDDL(SCHEMA))
    assert not PB.append_once(spark, ledger.path, late, "a0-b0of1", "BATCH_ID")
    assert ledger.rows().count() == 6


def test_newest_partition_is_pruned(spark, scratch):
    path = os.path.join(scratch, "t")
    spark.range(30).select((F.col("id") % 3 + 2021).cast("int").alias("DATA_YEAR"), F.col("id").alias("a"), F.lit("x").alias("b"),
                           F.lit(1).alias("c")).write.partitionBy("DATA_YEAR").parquet(path)
    df = REL.newest_partition(spark, path, "DATA_YEAR", ["a", "b"])
    assert {r.DATA_YEAR for r in df.collect()} == {2023} and df.count() == 10
    scan = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x][0]
    assert "PartitionFilters: [isnotnull(DATA_YEAR" in scan and "2023" in scan
    assert scan.rstrip().endswith("ReadSchema: struct<a:bigint,b:string>")
    empty = os.path.join(scratch, "none")
    spark.range(0).select(F.col("id").alias("a"), F.lit(1).alias("DATA_YEAR")).write.parquet(empty)
    assert REL.newest_partition(spark, empty, "DATA_YEAR").count() == 0


def test_least_per_group(spark):
    df = spark.range(500).select((F.col("id") % 2 * F.col("id") % 3).alias("g"), F.col("id").alias("k"))
    got = {}
    for r in REL.least_per_group(df, ["g"], ["k"], 4, salt_buckets=5).collect():
        got.setdefault(r.g, []).append((r["_place"], r.k))
    want = {}
    for r in df.collect():
        want.setdefault(r.g, []).append(r.k)
    assert {g: sorted(v) for g, v in got.items()} == {g: list(enumerate(sorted(v)[:4], 1)) for g, v in want.items()}
