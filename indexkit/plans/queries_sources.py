"""Registered queries: landing round trips, quarantine, load-once ingestion,
run append/promotion and JSON export.

Each builder first writes text/Parquet derived from the driver tables into a
fresh folder under the shared checkpoint folder, then returns the lazy
read-back, so the check compares what landing produced with the source.
"""

from __future__ import annotations

import os

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from indexkit.functions import clean as C
from indexkit.operators import relational as REL
from indexkit.plans import index as ix
from indexkit.plans import oracle as O
from indexkit.plans import standins as S
from indexkit.plans.queries import axes
from indexkit.plans.registry import query
from indexkit.sources import ingest as I
from indexkit.streaming import incremental as INC

ORDERS_TEXT = StructType([StructField("o_orderkey", StringType()), StructField("o_orderpriority", StringType()),
                          StructField("o_totalprice", StringType())])


@query("landing_roundtrip", """
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey,
       CASE WHEN o_orderpriority IN ('5-LOW') THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS DATA_YEAR
FROM orders""", ids=("S01", "S03", "S04", "S17", "U03"))
def q_landing_roundtrip(spark, sf_dir):
    """Orders exported as one CSV folder per year (values padded with blanks,
    priority '5-LOW' used as a null token), landed back with one glob read:
    trimmed, tokens -> NULL, year from the file path, numbers parsed."""
    src = I.work_dir(spark, "csv")
    o = S.read(spark, sf_dir, "orders")
    text = o.select(F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(" ")).alias("o_orderkey"),
                    F.col("o_orderpriority"), F.format_number("o_totalprice", 2).alias("o_totalprice"),
                    F.year("o_orderdate").alias("yr"))
    text.write.mode("overwrite").partitionBy("yr").option("header", True).csv(src)
    landed = I.read_delimited(spark, os.path.join(src, "yr=*", "*.csv"), ORDERS_TEXT,
                              tokens=("5-LOW",), keep_corrupt=False)
    landed = I.tag_year_from_file(landed, source="file_path", pattern=r"yr=(\d{4})")
    return landed.select(C.parse_int("o_orderkey").alias("o_orderkey"), "o_orderpriority",
                         C.parse_number("o_totalprice").alias("o_totalprice"), "DATA_YEAR")


LINE_TEXT = StructType([StructField(c, StringType()) for c in
                        ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_returnflag")])


@query("quarantine", """
SELECT CASE WHEN l_returnflag = 'R' THEN 'quarantined' ELSE 'landed' END AS status, COUNT(*) AS rows
FROM lineitem GROUP BY 1""", ids=("S05",))
def q_quarantine(spark, sf_dir):
    """Line items exported as text where returned lines carry an extra
    field; PERMISSIVE landing keeps them in the corrupt-record column and the
    split sends them to quarantine instead of dropping them."""
    root = I.work_dir(spark, "quarantine")
    li = S.read(spark, sf_dir, "lineitem")
    fields = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
                                                "l_returnflag")]
    line = F.when(F.col("l_returnflag") == "R", F.concat_ws(",", *fields, F.lit("extra"))).otherwise(
        F.concat_ws(",", *fields))
    li.select(line.alias("value")).write.mode("overwrite").text(os.path.join(root, "text"))
    landed = I.read_delimited(spark, os.path.join(root, "text"), LINE_TEXT, header=False)
    landed.write.mode("overwrite").parquet(os.path.join(root, "landed"))
    good, bad = I.split_quarantine(spark.read.parquet(os.path.join(root, "landed")))
    return (good.select(F.lit("landed").alias("status")).unionByName(bad.select(F.lit("quarantined").alias("status")))
            .groupBy("status").agg(F.count(F.lit(1)).alias("rows")))


EVENT_TEXT = StructType([StructField("event_id", LongType()), StructField("event_type", StringType()),
                         StructField("value", DoubleType()), StructField("ts", StringType())])


@query("load_new_files", "SELECT event_id, event_type, value FROM events", ids=("S06", "S07"))
def q_load_new_files(spark, sf_dir):
    """Two drops of event files arrive; each load takes only unseen files
    (streaming file source, AvailableNow, checkpointed); a third call with
    nothing new is a no-op.  The landed table holds every event once."""
    root = I.work_dir(spark, "incremental")
    src, dst, ckpt = (os.path.join(root, p) for p in ("src", "dst", "ckpt"))
    e = S.read(spark, sf_dir, "events").select("event_id", "event_type", "value",
                                               F.col("ts").cast("string").alias("ts"))
    cut = F.col("ts") < F.lit("2024-01-16")
    e.filter(cut).write.mode("overwrite").json(os.path.join(src, "drop1"))
    INC.load_new_files(spark, os.path.join(src, "*"), dst, ckpt, EVENT_TEXT, fmt="json")
    e.filter(~cut).write.mode("overwrite").json(os.path.join(src, "drop2"))
    INC.load_new_files(spark, os.path.join(src, "*"), dst, ckpt, EVENT_TEXT, fmt="json")
    INC.load_new_files(spark, os.path.join(src, "*"), dst, ckpt, EVENT_TEXT, fmt="json")  # no-op
    return spark.read.parquet(dst).select("event_id", "event_type", "value")


@query("append_promote", """
SELECT 'view' AS SCORING_RUN_ID, COUNT(*) AS rows FROM events WHERE event_type = 'view'""",
       ids=("S09", "S10", "J11", "W06"))
def q_append_promote(spark, sf_dir):
    """Every event type is appended as its own scoring run (append-only,
    partitioned by run); the 'view' run is promoted; the chosen run's rows
    are what staging reads."""
    root = I.work_dir(spark, "runs")
    e = S.read(spark, sf_dir, "events").select(F.col("event_type").alias("SCORING_RUN_ID"), "event_id", "value")
    I.append_run(e.filter(F.col("SCORING_RUN_ID") != "view"), os.path.join(root, "raw"))
    I.append_run(e.filter(F.col("SCORING_RUN_ID") == "view"), os.path.join(root, "raw"))
    approved = I.promote_run(spark, os.path.join(root, "approved"), "view", "calibrated")
    raw = spark.read.parquet(os.path.join(root, "raw"))
    run = REL.choose_run(raw.select("SCORING_RUN_ID", "LOADED_AT"), approved)
    return raw.join(F.broadcast(run), "SCORING_RUN_ID").groupBy("SCORING_RUN_ID").agg(
        F.count(F.lit(1)).alias("rows"))


@query("json_export", O.axis_long_sql(), ids=("S18", "S12"))
def q_json_export(spark, sf_dir):
    """The long axis view written as JSON cells and read back."""
    path = I.work_dir(spark, "json")
    idx, ind, reg = axes(spark, sf_dir)
    long = ix.axis_long(ind, reg, ix.axis_wage_band(idx))
    I.write_json(long, path)
    return spark.read.schema(long.schema).json(path)
