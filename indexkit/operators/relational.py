"""Slices, latest-per-key, dedupe, band joins, key-set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indexkit.functions.bands import WAGE_BANDS, bands_frame
from indexkit.operators.ranking import range_buckets
from indexkit.sources.publish import folders


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def max_value(df: DataFrame, col: str):
    """Scalar max of a column (one tiny job; a column statistic, not data)."""
    return df.agg(F.max(col)).first()[0]


def latest_slice(df: DataFrame, year_col: str = "DATA_YEAR", literal: bool = True) -> DataFrame:
    """Rows of the newest ``year_col``.

    ``literal=True`` fetches the max first and filters by a literal, so the
    predicate reaches the scan (partition pruning when the data is
    partitioned by year).  ``literal=False`` keeps it lazy: a broadcast
    one-row cross join, like the warehouse script."""
    if literal:
        mx = max_value(df, year_col)
        return df.filter(F.col(year_col) == F.lit(mx))
    latest = df.agg(F.max(year_col).alias("_max_year"))
    return (df.crossJoin(F.broadcast(latest))
              .filter(F.col(year_col) == F.col("_max_year")).drop("_max_year"))


def newest_partition(spark: SparkSession, path: str, col: str = "DATA_YEAR", columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of the newest ``col`` of a table partitioned by it on disk.  The value
    comes from the folder names: no data and no footer is read for it, and the
    scan is pruned to that one partition and to ``columns``."""
    names = [f.split("=", 1)[1] for f in folders(spark, path) if f.startswith(f"{col}=")]
    values = [int(n) for n in names if n.lstrip("-").isdigit()]
    df = spark.read.parquet(path)
    df = df.filter(F.col(col) == max(values)) if values else df.limit(0)
    return df if columns is None else df.select(col, *columns)


def slice_where(df: DataFrame, **predicates) -> DataFrame:
    """AND of equalities (scalar) and memberships (list/tuple/set)."""
    cond = F.lit(True)
    for k, v in predicates.items():
        cond = cond & (F.col(k).isin(list(v)) if isinstance(v, (list, tuple, set)) else (F.col(k) == F.lit(v)))
    return df.filter(cond)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column],
                   columns: Sequence[str], salt_buckets: int | None = None) -> DataFrame:
    """One row per key: the row that sorts first by ``order_by`` (Columns,
    with direction), ties broken by ``columns`` ascending (NULLs first), so
    the choice is total and deterministic.

    Two codegen'd row_number passes instead of one window over the key: the
    first ranks inside (key, salt) groups, the salt being a hash of the row,
    so a key holding a third of all rows is spread over ``salt_buckets``
    tasks; the second pass ranks at most ``salt_buckets`` survivors per key.
    """
    order = list(order_by) + [F.col(c).asc_nulls_first() for c in columns]
    salts = salt_buckets or range_buckets(df)
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in dict.fromkeys([*keys, *columns])]), F.lit(salts))
    d = df.withColumn("_salt", salt)
    d = d.withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
    d = d.filter(F.col("_r") == 1)
    d = d.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return d.filter(F.col("_r") == 1).select(*keys, *[c for c in columns if c not in keys])


def dedupe_one(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``order_cols`` (a total order when
    they cover every non-key column)."""
    others = [c for c in order_cols if c not in keys]
    return latest_per_key(df, keys, [], others)


def least_per_group(df: DataFrame, group: Sequence[str], order: Sequence, n: int, salt_buckets: int | None = None) -> DataFrame:
    """The ``n`` first rows of every group by ``order`` (a total order), with
    their ``_place``.  Map-side limits per (group, salt), then at most
    ``salt_buckets * n`` rows per group."""
    salts = salt_buckets or range_buckets(df)
    cols = [_col(c) for c in order]
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    d = df.withColumn("_salt", salt)
    d = d.withColumn("_place", F.row_number().over(Window.partitionBy(*group, "_salt").orderBy(*cols))).filter(F.col("_place") <= n)
    d = d.withColumn("_place", F.row_number().over(Window.partitionBy(*group).orderBy(*cols))).filter(F.col("_place") <= n)
    return d.drop("_salt")


def newest_row(df: DataFrame, order: Sequence[Column], n: int = 1) -> DataFrame:
    """ORDER BY ... LIMIT n (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def band_join(df: DataFrame, value_col: str, bands: DataFrame | Sequence = WAGE_BANDS,
              label: str = "WAGE_BAND", lo: str = "WAGE_PERCENTILE_MIN",
              hi: str = "WAGE_PERCENTILE_MAX") -> DataFrame:
    """Half-open range join ``lo <= v < hi`` (left).  The band table has a
    fixed handful of rows, so it is broadcast (BroadcastNestedLoopJoin)."""
    if not isinstance(bands, DataFrame):
        bands = bands_frame(df.sparkSession, bands)
    b = bands.select(F.col(label).alias(label), F.col(lo).alias("_lo"), F.col(hi).alias("_hi"))
    v = F.col(value_col)
    j = df.join(F.broadcast(b), (v >= F.col("_lo")) & (v < F.col("_hi")), "left")
    return j.drop("_lo", "_hi")


def membership(wanted: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """One row: distinct ids ``listed`` in ``wanted``, ``found`` among ``known`` and
    ``missing`` there."""
    ids = wanted.select(key).filter(F.col(key).isNotNull()).distinct()
    there = known.select(F.col(key).alias("_k")).distinct()
    j = ids.join(there, F.col(key) == F.col("_k"), "left")
    return j.agg(F.count(F.lit(1)).alias("listed"), F.count("_k").alias("found"), F.count_if(F.col("_k").isNull()).alias("missing"))


def semi(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left_semi")


def anti(left: DataFrame, right: DataFrame, on) -> DataFrame:
    return left.join(right, on, "left_anti")


def key_diff(left: DataFrame, right: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(keys only left, keys only right), distinct."""
    lk = left.select(key).distinct()
    rk = right.select(key).distinct()
    return lk.join(rk, key, "left_anti"), rk.join(lk, key, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def choose_run(runs: DataFrame, approved: DataFrame | None, run_col: str = "SCORING_RUN_ID",
               loaded_col: str = "LOADED_AT", approved_at: str = "APPROVED_AT") -> DataFrame:
    """One-row frame with the approved run (newest approval), else the most
    recently loaded run.  Ties broken by run id (descending)."""
    newest = (runs.groupBy(run_col).agg(F.max(loaded_col).alias("_t"))
                  .orderBy(F.col("_t").desc_nulls_last(), F.col(run_col).desc()).limit(1)
                  .select(F.col(run_col).alias("_newest")))
    if approved is None:
        return newest.select(F.col("_newest").alias(run_col))
    appr = (approved.orderBy(F.col(approved_at).desc_nulls_last(), F.col(run_col).desc()).limit(1)
                    .select(F.col(run_col).alias("_approved")))
    one = newest.join(appr, how="full")
    return one.select(F.coalesce("_approved", "_newest").alias(run_col))


def label_join(df: DataFrame, labels: Mapping[str, object], key: str, out: str) -> DataFrame:
    """Attach a value from a small static mapping (broadcast)."""
    spark = df.sparkSession
    m = spark.createDataFrame([(k, v) for k, v in labels.items()], [key, out])
    return df.join(F.broadcast(m), key, "left")
