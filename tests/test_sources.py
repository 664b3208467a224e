"""Landing, load-once ingestion, partition replacement, change detection."""

import os

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from indexkit.schemas import CONFIG_SCHEMA
from indexkit.sources import ingest as I
from indexkit.streaming import incremental as INC

SCHEMA = StructType([StructField("id", LongType()), StructField("year", LongType()), StructField("v", DoubleType())])


def test_load_once_is_idempotent(spark, scratch):
    src, dst, ck = (os.path.join(scratch, p) for p in ("src", "dst", "ck"))
    spark.createDataFrame([(1, 2023, 1.0), (2, 2023, 2.0)], SCHEMA).write.json(os.path.join(src, "a"))
    assert INC.load_new_files(spark, os.path.join(src, "*"), dst, ck, SCHEMA, fmt="json") == 1
    assert INC.load_new_files(spark, os.path.join(src, "*"), dst, ck, SCHEMA, fmt="json") == 0
    spark.createDataFrame([(3, 2024, 3.0)], SCHEMA).write.json(os.path.join(src, "b"))
    INC.load_new_files(spark, os.path.join(src, "*"), dst, ck, SCHEMA, fmt="json")
    assert sorted(r["id"] for r in spark.read.parquet(dst).collect()) == [1, 2, 3]


def test_republished_year_replaces_partition(spark, scratch):
    out = os.path.join(scratch, "t")
    df = spark.createDataFrame([(1, 2023, 1.0), (2, 2024, 2.0)], SCHEMA)
    I.land_to_parquet(df, out, ["year"])
    I.land_to_parquet(df, out, ["year"])                       # landing twice: no duplicates
    assert spark.read.parquet(out).count() == 2
    I.land_to_parquet(spark.createDataFrame([(9, 2024, 9.0)], SCHEMA), out, ["year"])
    got = sorted((r["id"], r["year"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, 2023), (9, 2024)]


def test_seed_if_empty(spark, scratch):
    p = os.path.join(scratch, "cfg")
    assert I.seed_if_empty(spark, p, [(0.8,)], CONFIG_SCHEMA).first()[0] == 0.8
    assert I.seed_if_empty(spark, p, [(0.5,)], CONFIG_SCHEMA).first()[0] == 0.8


def test_manifest_diff_states(spark):
    cols = "url string, etag string, last_modified string, length string"
    prev = spark.createDataFrame([("a", "1", "x", "10"), ("b", "1", "x", "10"), ("c", None, "x", "10"),
                                  ("gone", "1", "x", "1")], cols)
    cur = spark.createDataFrame([("a", "1", "x", "10"), ("b", "2", "x", "10"), ("c", None, "x", "10"),
                                 ("new", "1", "y", "2")], cols)
    got = {r["url"]: r["status"] for r in INC.manifest_diff(cur, prev).collect()}
    assert got == {"a": "unchanged", "b": "changed", "c": "unchanged", "gone": "missing", "new": "new"}


def test_latest_version_is_numeric(spark):
    names = spark.createDataFrame([("db_29_3_text.zip",), ("db_30_0_text.zip",), ("db_9_9_text.zip",),
                                   ("readme.txt",)], "name string")
    r = INC.latest_version(names).first()
    assert (r["name"], r["major"], r["minor"]) == ("db_30_0_text.zip", 30, 0)


def test_year_window(spark):
    ys = spark.createDataFrame([(2022,), (2024,)], "DATA_YEAR int")
    assert [r[0] for r in INC.year_window(ys).orderBy("DATA_YEAR").collect()] == [2022, 2023, 2024, 2025]


def test_tab_file_keeps_quotes(spark, scratch):
    p = os.path.join(scratch, "t.txt")
    with open(p, "w") as fh:
        fh.write('A\tB\n11-1011.00\tSay "hi", then n/a\n11-1011.00\tn/a\n')
    sch = StructType([StructField("A", StringType()), StructField("B", StringType())])
    r = I.read_delimited(spark, p, sch, sep="\t", quote=None, tokens=("n/a",), keep_corrupt=False).collect()
    assert r[0]["B"] == 'Say "hi", then n/a' and r[1]["B"] is None
