"""Profiling operators for the report data layer: value counts, shares,
equal-width histograms, single-pass funnels, KPI rows, load summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexkit.functions.numeric import exact_ratio


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def ordered_counts(df: DataFrame, value: Column, order: Sequence[str], labels: dict[str, str]) -> DataFrame:
    """Counts of the values named in ``order``, with their place there and their
    label; values that do not occur are absent, as are those not named."""
    places = F.create_map(*[F.lit(x) for k, v in enumerate(order, 1) for x in (v, k)])
    names = F.create_map(*[F.lit(x) for v in order for x in (v, labels.get(v, v))])
    counts = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("value").isin(list(order)))
    return counts.select(places[F.col("value")].alias("place"), "value", names[F.col("value")].alias("label"), "n").orderBy("place")


def share_of_total(counts: DataFrame, value: str = "n", out: str = "pct", digits: int = 2) -> DataFrame:
    """Percent of the column total, on an already aggregated (small) frame:
    the total comes from a one-row aggregate cross-joined back."""
    tot = counts.agg(F.sum(value).alias("_tot"))
    return counts.crossJoin(F.broadcast(tot)).withColumn(
        out, exact_ratio(F.col(value) * F.lit(100), F.col("_tot"), digits)).drop("_tot")


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram: lo/hi from one min/max pass (hi = lo + 1 when
    equal), bin = min(floor((v - lo) / width), bins - 1) so the maximum falls
    in the last bin.  NULL and NaN values are skipped.  Empty bins are kept
    (a fixed ``bins``-row frame is joined with the counts)."""
    v = F.col(col).cast("double")
    vals = df.select(v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    mm = vals.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi0"))
    mm = mm.select("_lo", F.when(F.col("_hi0") == F.col("_lo"), F.col("_lo") + 1)
                   .otherwise(F.col("_hi0")).alias("_hi"))
    mm = mm.withColumn("_w", (F.col("_hi") - F.col("_lo")) / F.lit(float(bins)))
    b = vals.crossJoin(F.broadcast(mm)).select(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / F.col("_w")).cast("int"),
                F.lit(bins - 1)).alias("bin"))
    counts = b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    spark = df.sparkSession
    all_bins = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(mm))
    out = all_bins.join(counts, "bin", "left")
    return out.select("bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_lo"),
                      F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def funnel(df: DataFrame, steps: Sequence[tuple[str, Column]], digits: int = 1) -> DataFrame:
    """Row count after each successive filter and its percent of the start,
    in ONE pass (cumulative conditional counts), unpivoted with ``stack``."""
    conds, acc = [], F.lit(True)
    for _label, pred in steps:
        acc = acc & pred
        conds.append(acc)
    aggs = [F.count(F.lit(1)).alias("_s0")] + [F.count_if(c).alias(f"_s{i + 1}") for i, c in enumerate(conds)]
    one = df.agg(*aggs)
    labels = ["all rows"] + [label for label, _ in steps]
    rows = [F.struct(F.lit(i).alias("step"), F.lit(lab).alias("label"), F.col(f"_s{i}").alias("rows"))
            for i, lab in enumerate(labels)]
    long = one.select(F.col("_s0").alias("_start"), F.inline(F.array(*rows)))
    return long.select("step", "label", "rows",
                       F.when(F.col("_start") == 0, F.lit(None).cast("double"))
                        .otherwise(exact_ratio(F.col("rows") * F.lit(100), F.col("_start"), digits))
                        .alias("pct_of_start"))


def count_rows(frames: dict[str, DataFrame], name_col: str = "table_name") -> DataFrame:
    """UNION ALL of one-row counts, one per named frame."""
    out = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias(name_col), "rows")
        out = c if out is None else out.unionByName(c)
    return out
