"""Agreement statistics between two scorings (rater vs model, re-test).

Pairs with a missing side are dropped, then each (comparison group, metric) is
reduced to its joint frequency table: the distinct (x, y) with the number of
pairs, a hash aggregate with map-side partial results.  Every statistic is a
weighted sum over that table; average ranks are weighted too and are taken on
the table (``ranking.counted``), so no rank is ever joined to pairs.

Values are expected to carry at most four decimals; sums are taken in whole
units (exact, order independent) and each statistic divides once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexkit.functions.bands import SCORE_CUTS, cut_band
from indexkit.functions.numeric import WHOLE, exact_ratio
from indexkit.operators.ranking import counted
from indexkit.operators.relational import least_per_group
from indexkit.operators.rollup import units


def pearson_expr(x: str, y: str, digits: int = 6) -> Column:
    """Population covariance over the product of population standard
    deviations; NULL for n < 2 or zero variance (F.corr raises under ANSI on
    zero variance)."""
    den = F.stddev_pop(x) * F.stddev_pop(y)
    return F.round(F.covar_pop(x, y) / F.when(den != 0, den), digits)


def long_pairs(df: DataFrame, keys: Sequence[str], pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """(keys..., metric, x, y) rows, one per metric, pairs with a NULL or
    NaN side dropped."""
    structs = [F.struct(F.lit(m).alias("metric"), F.col(a).cast("double").alias("x"),
                        F.col(b).cast("double").alias("y")) for m, (a, b) in pairs.items()]
    long = df.select(*keys, F.inline(F.array(*structs)))
    ok = F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y")
    return long.filter(ok)


def joint_table(pairs_long: DataFrame, group: Sequence[str] = ("metric",), value_scale: int = 4) -> DataFrame:
    """(group..., x, y, n): distinct pairs in whole units with their frequency."""
    return pairs_long.groupBy(*group, units("x", value_scale).alias("x"), units("y", value_scale).alias("y")) \
        .agg(F.count(F.lit(1)).alias("n"))


def _centred(joint: DataFrame, col: str, group: Sequence[str], out: str, scan: bool = False) -> DataFrame:
    """Twice the weighted average rank of ``col``, less its mean: a whole number
    whose weighted sum over a group is zero."""
    ranked = counted(joint, col, group, scan=scan, weight="n")
    return ranked.select(*joint.columns, (2 * F.col("_before") + F.col("_ties") - F.col("_n")).alias(out))


def _whole_sum(*factors: str) -> Column:
    product = F.col(factors[0]).cast(WHOLE)
    for f in factors[1:]:
        product = (product * F.col(f).cast("decimal(19,0)")).cast(WHOLE)
    return F.sum(product)


def _correlation(cov: Column, vx: Column, vy: Column, digits: int) -> Column:
    """NULL without variance on either side."""
    den = F.sqrt(vx.cast("double")) * F.sqrt(vy.cast("double"))
    return F.round(cov.cast("double") / F.when(den > 0, den), digits)


def rank_correlation(joint: DataFrame, group: Sequence[str]) -> DataFrame:
    """``joint`` plus centred ranks ``_rx`` and ``_ry``."""
    # what the first rank gives back reads written rows
    return _centred(_centred(joint, "x", group, "_rx"), "y", group, "_ry", scan=True)


def spearman_expr(digits: int = 6) -> Column:
    """Aggregate over ``rank_correlation``: the centred ranks' sums are zero, so
    their products alone give covariance and variances."""
    return _correlation(_whole_sum("n", "_rx", "_ry"), _whole_sum("n", "_rx", "_rx"), _whole_sum("n", "_ry", "_ry"), digits)


def agreement_report(pairs_long: DataFrame, group: Sequence[str] = ("metric",),
                     cuts: Sequence[float] = SCORE_CUTS, digits: int = 6) -> DataFrame:
    """Per group: n, MAE, Pearson, Spearman, band agreement."""
    g = list(group)
    d = rank_correlation(joint_table(pairs_long, g), g)
    n = F.sum("n").cast(WHOLE)
    sx, sy = _whole_sum("n", "x"), _whole_sum("n", "y")

    def moment(a: str, b: str, sa: Column, sb: Column) -> Column:
        return (n * _whole_sum("n", a, b)).cast(WHOLE) - (sa * sb).cast(WHOLE)
    same = F.when(cut_band(F.col("x") / 10000.0, cuts) == cut_band(F.col("y") / 10000.0, cuts), F.col("n")).otherwise(F.lit(0))
    return d.groupBy(*g).agg(
        F.sum("n").alias("n"),
        exact_ratio(F.sum(F.col("n") * F.abs(F.col("x") - F.col("y"))), F.sum("n") * F.lit(10000), digits).alias("mae"),
        _correlation(moment("x", "y", sx, sy), moment("x", "x", sx, sx), moment("y", "y", sy, sy), digits).alias("pearson"),
        spearman_expr(digits).alias("spearman"),
        exact_ratio(F.sum(same), F.sum("n"), digits).alias("band_agreement"),
    )


def annotators(columns: Sequence[str], first_metric: str, most: int = 4) -> int:
    """The highest numbered annotator with a column for the first metric."""
    return max((a for a in range(1, most + 1) if f"{first_metric}_annot{a}" in columns), default=0)


def calibration(human: DataFrame, model: DataFrame, retest: DataFrame | None, keys: Sequence[str],
                metrics: dict[str, str], error: str = "ERROR_MESSAGE", most: int = 4) -> DataFrame:
    """Rater against model, rater against rater and run against run.

    ``human`` has ``<metric>_annot<k>`` columns, ``model`` and ``retest`` one
    column per metric (``metrics``: name to column).  Model rows with an error
    don't count.  Rows are matched by ``keys`` (inner); a rater mean is taken
    over all annotators up to the highest one present, missing ones skipped.
    One row per (comparison, metric) with the statistics of ``agreement_report``."""
    count = annotators(human.columns, next(iter(metrics)), most)
    ok = model.filter(F.col(error).isNull() | (F.col(error) == ""))
    merged = human.join(ok.select(*keys, *[F.col(c).alias(f"_model_{m}") for m, c in metrics.items()]), list(keys))
    if retest is not None:
        merged = merged.join(retest.select(*keys, *[F.col(c).alias(f"_again_{m}") for m, c in metrics.items()]), list(keys), "left")
    structs = []
    for m in metrics:
        cols = [f"{m}_annot{a}" for a in range(1, count + 1) if f"{m}_annot{a}" in human.columns]
        if cols:
            merged = rater_mean(merged, cols, f"_human_{m}").drop("raters_present")
            structs.append(("human_model", m, f"_human_{m}", f"_model_{m}"))
        if count >= 2 and {f"{m}_annot1", f"{m}_annot2"} <= set(human.columns):
            structs.append(("annotators", m, f"{m}_annot1", f"{m}_annot2"))
        if retest is not None:
            structs.append(("retest", m, f"_model_{m}", f"_again_{m}"))
    rows = F.array(*[F.struct(F.lit(c).alias("comparison"), F.lit(m).alias("metric"), F.col(x).cast("double").alias("x"),
                              F.col(y).cast("double").alias("y")) for c, m, x, y in structs])
    pairs = merged.select(F.inline(rows)).filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    return agreement_report(pairs, ["comparison", "metric"])


def rater_mean(df: DataFrame, cols: Sequence[str], out: str = "rater_mean",
               digits: int = 4) -> DataFrame:
    """Row mean over the rater columns that are present (NULL/NaN skipped)
    and the number of present raters."""
    present = [F.when(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")), units(c, 4)) for c in cols]
    total = F.lit(0).cast("bigint")
    count = F.lit(0)
    for p in present:
        total = total + F.coalesce(p, F.lit(0))
        count = count + F.when(p.isNotNull(), 1).otherwise(0)
    n = F.col("raters_present")
    if digits <= 4:
        # round(total / n, digits) in whole numbers, half-up: no decimals a row
        low = n.cast("bigint") * F.lit(10 ** (4 - digits))
        half_up = F.call_function("div", F.abs(total) * F.lit(2) + low, low * F.lit(2))
        mean = (F.when(total < 0, -half_up).otherwise(half_up)).cast("double") / F.lit(float(10 ** digits))
    else:
        mean = exact_ratio(total, n * F.lit(10000), digits)
    return df.withColumn("raters_present", count).withColumn(out, F.when(n > 0, mean))


def swap_flags(df: DataFrame, m1: tuple[str, str], m2: tuple[str, str], threshold: float = 0.25,
               group: Sequence[str] = ()) -> DataFrame:
    """Opposite-direction errors on two dimensions: (model1 - rater1) beyond
    +threshold while (model2 - rater2) is beyond -threshold, or the reverse
    (strict).  Per group: rows, swaps and their share of all rows."""
    t = int(round(threshold * 10000))
    d1 = units(m1[0], 4) - units(m1[1], 4)
    d2 = units(m2[0], 4) - units(m2[1], 4)
    flag = ((d1 > t) & (d2 < -t)) | ((d1 < -t) & (d2 > t))
    d = df.withColumn("swap", F.coalesce(flag, F.lit(False)))
    agg = d.groupBy(*group) if group else d.groupBy()
    return agg.agg(F.count(F.lit(1)).alias("rows"), F.count_if("swap").alias("swaps"),
                   exact_ratio(F.count_if("swap"), F.count(F.lit(1)), 6).alias("swap_share"))


def swap_examples(df: DataFrame, m1: tuple[str, str], m2: tuple[str, str], keys: Sequence[str], n: int = 5,
                  threshold: float = 0.25, group: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` flagged rows of each group by key: only keys and differences
    are ranked, two bounded passes keep ``n`` rows per (group, salt) and group."""
    t = int(round(threshold * 10000))
    lean = df.select(*group, *keys, (units(m1[0], 4) - units(m1[1], 4)).alias("_d1"), (units(m2[0], 4) - units(m2[1], 4)).alias("_d2"))
    flagged = lean.filter(((F.col("_d1") > t) & (F.col("_d2") < -t)) | ((F.col("_d1") < -t) & (F.col("_d2") > t)))
    return least_per_group(flagged, group, keys, n).select(
        *group, *keys, (F.col("_d1") / 10000.0).alias("difference_1"), (F.col("_d2") / 10000.0).alias("difference_2"),
        F.col("_place").alias("place"))
