"""One-command refresh: land raw delimited files, then rebuild every layer.

    python -m indexkit.cli refresh --raw DIR --out DIR [--min-coverage 0.8]

``DIR`` holds ``oews_<year>.csv`` files (comma separated, quoted), the task
catalogue as tab files (``task_statements*.txt``, ``task_ratings*.txt``) and
optionally ``task_ai_scores_*.csv`` runs.  Landing is incremental for the
OEWS years (a republished year replaces its partition); score runs are
appended; malformed rows go to ``<out>/quarantine``.  Tables are published as
one version (``indexkit.sources.publish``); those whose inputs are unchanged are
not written again.  Exit code 1 when a quality rule FAILs, like the warehouse
refresh; the version published before then stays.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import functions as F

from indexkit.functions.clean import OEWS_NULL_TOKENS, ONET_NULL_TOKENS, null_tokens
from indexkit.plans import pipeline as P
from indexkit.schemas import OEWS_SCHEMA, SCORE_SCHEMA, TASK_RATING_SCHEMA, TASK_STATEMENT_SCHEMA
from indexkit.session import build_time, discard_written, get_spark
from indexkit.sources import ingest as I
from indexkit.streaming import incremental as INC


def files(spark, pattern: str) -> list[str]:
    """Paths that match, from whatever file system the pattern names."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [])


def land_raw(spark, raw: str, out: str) -> P.RawTables:
    oews_files = files(spark, f"{raw}/oews_*.csv")
    if not oews_files:
        raise FileNotFoundError(f"no oews_<year>.csv under {raw}")
    I.land_delimited(spark, oews_files, OEWS_SCHEMA, os.path.join(out, "raw_oews"),
                     quarantine=os.path.join(out, "quarantine", "oews"), partition_by=["DATA_YEAR"],
                     tag_year=True, tokens=OEWS_NULL_TOKENS)
    tab = dict(sep="\t", quote=None, tokens=ONET_NULL_TOKENS)
    I.land_delimited(spark, files(spark, f"{raw}/task_statements*.txt"), TASK_STATEMENT_SCHEMA,
                     os.path.join(out, "raw_statements"), quarantine=os.path.join(out, "quarantine", "statements"),
                     **tab)
    I.land_delimited(spark, files(spark, f"{raw}/task_ratings*.txt"), TASK_RATING_SCHEMA,
                     os.path.join(out, "raw_ratings"), quarantine=os.path.join(out, "quarantine", "ratings"), **tab)
    scores = None
    if files(spark, f"{raw}/task_ai_scores_*.csv"):
        # append-only run history, each file loaded once (streaming ledger)
        runs_dir = os.path.join(out, "raw_scores")

        def stamp(df):
            return df.select(*[null_tokens(c).alias(c) for c in SCORE_SCHEMA.names],
                             build_time(spark).alias("LOADED_AT"))
        INC.load_new_files(spark, os.path.join(raw, "task_ai_scores_*.csv"), runs_dir,
                           os.path.join(out, "_ledger", "scores"), SCORE_SCHEMA, fmt="csv",
                           options={"header": True, "multiLine": True, "quote": '"', "escape": '"'},
                           partition_by=["SCORING_RUN_ID"], transform=stamp, replace_partitions=False)
        scores = spark.read.parquet(runs_dir)
    approved = None
    appr_dir = os.path.join(out, "approved_run")
    if files(spark, appr_dir):
        approved = spark.read.parquet(appr_dir)
    return P.RawTables(spark.read.parquet(os.path.join(out, "raw_oews")),
                       spark.read.parquet(os.path.join(out, "raw_statements")),
                       spark.read.parquet(os.path.join(out, "raw_ratings")), scores, approved)


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="indexkit")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="land raw files and rebuild all layers")
    r.add_argument("--raw", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--min-coverage", type=float, default=0.80)
    r.add_argument("--mode", choices=["REAL_TASK_SCORE", "PLACEHOLDER"], default=None)
    r.add_argument("--publish-failed", action="store_true", help="publish a build whose quality rules FAIL")
    p = sub.add_parser("promote", help="approve a scoring run")
    p.add_argument("--out", required=True)
    p.add_argument("--run", required=True)
    p.add_argument("--note", default="")
    args = ap.parse_args(argv)
    spark = get_spark("indexkit-refresh")
    if args.cmd == "promote":
        I.promote_run(spark, os.path.join(args.out, "approved_run"), args.run, args.note)
        return 0
    raw = land_raw(spark, args.raw, args.out)
    try:
        t = P.rebuild(spark, raw, args.out, args.min_coverage, args.mode, publish_failed=args.publish_failed)
    except P.QualityFailure as e:
        t = e.tables
    v = t["verdict"].first()
    discard_written(spark)
    print(f"{v['VERDICT']}: {v['QUALITY_FAILS']} FAIL, {v['QUALITY_WARNS']} WARN")
    return 1 if v["QUALITY_FAILS"] else 0


if __name__ == "__main__":
    sys.exit(main())
