"""Landing of delimited text into typed Parquet, run tables and sinks.

Reads are schema-declared (no inference), one read per glob of files;
malformed rows are kept in a corrupt-record column and split off to a
quarantine table rather than dropped (DROPMALFORMED gives different counts
depending on which columns a query prunes).
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from indexkit.functions.clean import null_tokens
from indexkit.session import build_time, ensure_checkpoint_dir, open_files

CORRUPT = "_corrupt_record"


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: StructType, sep: str = ",",
                   quote: str | None = '"', header: bool = True, tokens: Sequence[str] = (),
                   keep_corrupt: bool = True, multiline: bool = False) -> DataFrame:
    """Read delimited text with a declared all-text schema.

    ``quote=None`` turns quoting off (tab files whose statements contain
    quotes).  Every column is trimmed and the empty string and ``tokens``
    become NULL.  With ``keep_corrupt`` a ``_corrupt_record`` column holds the
    raw line of rows that do not fit the schema (PERMISSIVE mode)."""
    full = StructType(list(schema.fields) + ([StructField(CORRUPT, StringType())] if keep_corrupt else []))
    r = (spark.read.schema(full).option("header", header).option("sep", sep)
         .option("mode", "PERMISSIVE").option("enforceSchema", True)
         .option("encoding", "UTF-8").option("multiLine", multiline))
    if keep_corrupt:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    if quote is None:
        r = r.option("quote", "")
    else:
        r = r.option("quote", quote).option("escape", quote)
    df = r.csv(path)
    cols = [null_tokens(f.name, tokens).alias(f.name) if isinstance(f.dataType, StringType)
            else F.col(f.name) for f in schema.fields]
    if keep_corrupt:
        cols.append(F.col(CORRUPT))
    return df.select(*cols)


def tag_year_from_file(df: DataFrame, col: str = "DATA_YEAR", pattern: str = r"(\d{4})",
                       source: str = "file_name") -> DataFrame:
    """Stamp the year found in each row's source file name (or full path)."""
    return df.withColumn(col, F.regexp_extract(F.col(f"_metadata.{source}"), pattern, 1).cast("int"))


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, bad rows: raw line only).

    Call on a landed (Parquet) copy, or after ``cache()``: Spark refuses
    queries that reference only the corrupt column of a raw text scan."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull()).select(CORRUPT)
    return good, bad


def land_to_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                    replace_partitions: bool = True) -> None:
    """Write a landed table.  With ``partition_by`` and ``replace_partitions``
    only the partitions present in ``df`` are replaced (a republished year
    replaces its rows, other years stay)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
        if replace_partitions:
            w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


def land_delimited(spark: SparkSession, path, schema: StructType, out: str, quarantine: str | None = None,
                   partition_by: Sequence[str] = (), tag_year: bool = False, **read_opts) -> dict:
    """Land text as Parquet, bad rows apart.  The parsed rows are kept once
    (``persist``) for both writes.  Quarantined rows go to a folder per set of
    source paths that landing the same paths again replaces; the counts are
    those of this landing."""
    df = read_delimited(spark, path, schema, **read_opts)
    if tag_year:
        df = tag_year_from_file(df)
    df = df.persist()
    try:
        good, bad = split_quarantine(df)
        n_good, n_bad = good.count(), 0
        land_to_parquet(good, out, partition_by)
        if quarantine:
            paths = sorted([path] if isinstance(path, str) else path)
            load = hashlib.sha256("\n".join(paths).encode("utf-8")).hexdigest()[:16]
            bad.write.mode("overwrite").parquet(f"{quarantine.rstrip('/')}/load={load}")
            n_bad = bad.count()
    finally:
        df.unpersist()
    return {"rows": n_good, "quarantined": n_bad}


def append_run(df: DataFrame, path: str, run_col: str = "SCORING_RUN_ID", stamp: bool = True) -> None:
    """Append-only provenance table partitioned by run; LOADED_AT stamped."""
    if stamp:
        df = df.withColumn("LOADED_AT", build_time(df.sparkSession))
    with open_files(df.sparkSession):
        df.write.mode("append").partitionBy(run_col).parquet(path)


def promote_run(spark: SparkSession, path: str, run_id: str, note: str = "") -> DataFrame:
    """Replace the one-row approved-run table."""
    one = spark.createDataFrame([(run_id, note)], "SCORING_RUN_ID string, NOTE string").select(
        "SCORING_RUN_ID", build_time(spark).alias("APPROVED_AT"), "NOTE")
    one.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def seed_if_empty(spark: SparkSession, path: str, rows: list[tuple], schema: StructType) -> DataFrame:
    """Insert default rows only when the table is missing or empty."""
    try:
        cur = spark.read.parquet(path)
        empty = cur.isEmpty()
    except Exception:  # noqa: BLE001  (table does not exist yet)
        empty = True
    if empty:
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, compression: str = "none") -> None:
    df.write.mode("overwrite").option("header", header).option("quote", '"').option("escape", '"') \
      .option("compression", compression).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def work_dir(spark: SparkSession, name: str = "work") -> str:
    """A fresh folder under the shared checkpoint folder (never a
    machine-local temporary directory)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "indexkit", f"{name}-{uuid.uuid4().hex[:12]}")
