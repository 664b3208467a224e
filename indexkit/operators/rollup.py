"""Weighted rollups with coverage.

All sums run on scaled integers ("units"): a value with at most ``s``
decimals becomes ``v * 10**s`` as BIGINT (more decimals are an error; with twelve
decimals every double from 0 to 1 passes, as its own precision ends there).  Integer
sums are exact, order independent and stay in Spark's fast long-backed
aggregation buffers; product sums are kept in two parts, so large weights
don't overflow them (wide DECIMAL sums would fall back to BigDecimal objects).  Division happens once
per group, on exact decimals, with half-up rounding.

Every aggregate here is a plain hash aggregate: partial aggregation on the
map side, so a key holding a third of all rows still ships one partial row
per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexkit.functions.numeric import WHOLE, div0, exact_ratio, quotient_key, split_of, split_sums, split_total


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units(c, scale: int) -> Column:
    """v * 10**scale as BIGINT.  A value with more than ``scale`` decimals is
    an error, never silently rounded; integers never pass through a double."""
    if scale == 0:
        x = _col(c)
        whole = F.round(x, 0).cast("bigint")
    else:
        x = _col(c) * F.lit(10 ** scale)
        whole = F.round(x, 0).cast("bigint")
    off = F.abs(x.cast("double") - whole.cast("double")) > F.greatest(F.lit(1e-4), F.abs(x.cast("double")) * 1e-12)
    return F.when(off, F.raise_error(F.concat(F.lit(f"more than {scale} decimals: "), _col(c).cast("string"))).cast("bigint")) \
        .otherwise(whole)


def default_scale(df: DataFrame, column: str, scale: int | None) -> int:
    """Decimals kept of a weight: none for whole-number types, else four."""
    if scale is not None:
        return scale
    kind = df.schema[column].dataType.typeName()
    return 0 if kind in ("byte", "short", "integer", "long") else 4


def weighted_rollup(df: DataFrame, keys: Sequence[str], weight: str, metrics: Sequence[str],
                    labels: Sequence[str] = (), coverage_metric: str | None = None,
                    digits: int = 4, value_scale: int = 6, weight_scale: int | None = None,
                    total_name: str = "TOTAL_EMP", count_name: str = "OCC_COUNT",
                    coverage_name: str = "EMP_COVERAGE", coverage_digits: int | None = None,
                    unrounded: str | None = None) -> DataFrame:
    """Per key: total weight, row count, weighted coverage and one weighted
    mean per metric (Σ w·v / Σ w over rows where v is present).

    ``labels`` depend on the key; they join the first (hash-based) grouping,
    and the few resulting rows are reduced to the least label per key, so no
    buffer holds a set.  ``coverage_metric`` (default: the first metric)
    decides which rows count as scored.  ``unrounded`` names one metric whose
    mean is also given as ``_unrounded``, a text that sorts and compares like
    the exact quotient (what ranks are taken on).
    """
    cov_m = coverage_metric or metrics[0]
    weight_scale = default_scale(df, weight, weight_scale)
    w = units(weight, weight_scale)
    lean = df.select(*keys, *labels, w.alias("_w"), *[units(m, value_scale).alias(f"_v_{m}") for m in metrics])
    w = F.col("_w")
    aggs = [F.sum(w).alias("_wt"), F.count(F.lit(1)).alias(count_name),
            F.sum(F.when(F.col(f"_v_{cov_m}").isNotNull(), w).otherwise(F.lit(0))).alias("_ws")]
    for m in metrics:
        v = F.col(f"_v_{m}")
        aggs += split_sums(w, v, f"_n_{m}", split_of(value_scale))
        aggs.append(F.sum(F.when(v.isNotNull(), w).otherwise(F.lit(0))).alias(f"_d_{m}"))
    g = lean.groupBy(*keys, *labels).agg(*aggs)
    if labels:
        sums = [c for c in g.columns if c not in (*keys, *labels)]
        g = g.groupBy(*keys).agg(*[F.min(lab).alias(lab) for lab in labels], *[F.sum(c).alias(c) for c in sums])
    total = F.col("_wt")
    if weight_scale:
        total = exact_ratio(total, F.lit(10 ** weight_scale), weight_scale)
    scale = F.lit(10 ** value_scale).cast(WHOLE)
    out = [*keys, *labels, total.alias(total_name), F.col(count_name),
           div0("_ws", "_wt", digits if coverage_digits is None else coverage_digits).alias(coverage_name)]
    for m in metrics:
        out.append(exact_ratio(split_total(f"_n_{m}", split_of(value_scale)), F.col(f"_d_{m}").cast(WHOLE) * scale, digits).alias(m))
    if unrounded:
        out.append(quotient_key(split_total(f"_n_{unrounded}", split_of(value_scale)), F.col(f"_d_{unrounded}")).alias("_unrounded"))
    return g.select(*out)


def task_rollup(tasks: DataFrame, key: str = "OCC_CODE", weight: str = "IMPORTANCE_RAW",
                metrics: Sequence[str] = ("AI_EXPOSURE_SCORE", "AUTOMATION_SCORE",
                                          "AUGMENTATION_SCORE"),
                confidence: str | None = "CONFIDENCE",
                weight_scale: int = 2, value_scale: int = 6,
                norm_range: tuple[float, float] = (1.0, 5.0)) -> DataFrame:
    """Occupation rollup over one row per task statement.

    ``tasks`` has the key, the raw importance (NULL when the statement is not
    rated) and the scores (NULL when not scored).  Output per key, in exact
    units: statement count, rated/scored counts, importance totals, weighted
    numerators/denominators, confidence sums and the placeholder parts.
    Rated-only quantities are NULL when the key has no rated statement (the
    reference's inner join produces no row there).
    """
    lean = tasks.select(key, units(weight, weight_scale).alias("_w"),
                        *[units(m, value_scale).alias(m) for m in metrics],
                        *([units(confidence, value_scale).alias("_c")] if confidence else []))
    w = F.col("_w")
    rated = w.isNotNull()
    s0 = F.col(metrics[0])
    aggs = [
        F.count(F.lit(1)).alias("statement_count"),
        F.count(w).alias("_rated"),
        F.count(F.when(rated, s0)).alias("_scored"),
        F.sum(w).alias("imp_total_u"),
        F.sum(F.when(s0.isNotNull(), w).otherwise(F.when(rated, F.lit(0)))).alias("imp_scored_u"),
        F.max(F.when(s0.isNotNull(), F.lit(1)).otherwise(F.lit(0))).alias("_any_score"),
    ]
    for m in metrics:
        v = F.col(m)
        aggs += split_sums(w, v, f"_n_{m}", split_of(value_scale))
        aggs.append(F.sum(F.when(v.isNotNull(), w).otherwise(F.when(rated, F.lit(0)))).alias(f"_d_{m}"))
    if confidence:
        c = F.col("_c")
        aggs.append(F.sum(F.when(rated, c if value_scale <= 6 else c.cast("decimal(20,0)"))).alias("_conf_sum"))
        aggs.append(F.count(F.when(rated, c)).alias("_conf_cnt"))
    g = lean.groupBy(key).agg(*aggs)
    has_rated = F.col("_rated") > 0
    lo, hi = norm_range
    scale_w = 10 ** weight_scale
    # placeholder proxy: avg of (imp - lo)/(hi - lo) over rated statements,
    # 0 when the occupation has statements but none is rated.
    ph = F.coalesce(
        exact_ratio(F.col("imp_total_u") - F.col("_rated") * F.lit(int(round(lo * scale_w))),
                    F.col("_rated") * F.lit(int(round((hi - lo) * scale_w))), 4),
        F.lit(0.0))
    cols = [
        F.col(key),
        F.col("statement_count"),
        F.when(has_rated, F.col("_rated")).alias("rated_task_count"),
        F.when(has_rated, F.col("_scored")).alias("scored_task_count"),
        F.when(has_rated, F.col("imp_total_u")).alias("imp_total_u"),
        F.when(has_rated, F.col("imp_scored_u")).alias("imp_scored_u"),
        F.col("_any_score").alias("any_score"),
        ph.alias("placeholder_exposure"),
    ]
    for m in metrics:
        cols.append(exact_ratio(split_total(f"_n_{m}", split_of(value_scale)), F.col(f"_d_{m}").cast(WHOLE) * F.lit(10 ** value_scale).cast(WHOLE), 4)
                    .alias(f"occ_{m}"))
    if confidence:
        cols.append(exact_ratio(F.col("_conf_sum"), F.col("_conf_cnt") * F.lit(10 ** value_scale), 4)
                    .alias("occ_confidence"))
    return g.select(*cols)


def placeholder_index(tasks: DataFrame, key: str = "OCC_CODE", weight: str = "IMPORTANCE_RAW",
                      weight_scale: int = 2, norm_range=(1.0, 5.0)) -> DataFrame:
    """AI_EXPOSURE_PLACEHOLDER: per occupation, ROUND(COALESCE(avg normalised
    importance, 0), 4), statement count and rated count."""
    w = units(weight, weight_scale)
    lo, hi = norm_range
    scale_w = 10 ** weight_scale
    g = tasks.groupBy(key).agg(F.count(F.lit(1)).alias("task_count"),
                               F.count(w).alias("rated_task_count"),
                               F.sum(w).alias("_s"))
    ph = F.coalesce(exact_ratio(F.col("_s") - F.col("rated_task_count") * F.lit(int(round(lo * scale_w))),
                                F.col("rated_task_count") * F.lit(int(round((hi - lo) * scale_w))), 4),
                    F.lit(0.0))
    return g.select(key, ph.alias("AI_EXPOSURE"), "task_count", "rated_task_count",
                    F.lit("PLACEHOLDER_ONET_IMPORTANCE_PROXY").alias("SCORE_SOURCE"))


def ratio_of_sums(df: DataFrame, keys: Sequence[str], value: str, weight: str,
                  digits: int = 4, value_scale: int = 4, order_by: str | None = None) -> DataFrame:
    """ROUND(SUM(value * weight) / NULLIF(SUM(weight), 0), digits) per key (a
    NULL value adds nothing to the numerator but its weight still counts),
    with row count and the weight total; optional MIN(order_by) as ``_ord``."""
    w = F.col(weight).cast("bigint")
    aggs = [F.count(F.lit(1)).alias("occupations"),
            F.sum(w).alias("total_employment"),
            F.sum(units(value, value_scale) * w).alias("_n")]
    if order_by:
        aggs.append(F.min(order_by).alias("_ord"))
    g = df.groupBy(*keys).agg(*aggs)
    return g.withColumn(
        "emp_weighted_exposure",
        exact_ratio(F.col("_n"), F.col("total_employment") * F.lit(10 ** value_scale), digits)).drop("_n")


def mean_abs_diff(a: DataFrame, b: DataFrame, key: str, col_a: str, col_b: str,
                  digits: int = 6, value_scale: int = 4) -> DataFrame:
    """Weight sensitivity: mean |a - b| over keys where both are present
    (exact: values carry <= value_scale decimals), one row."""
    j = a.select(key, units(col_a, value_scale).alias("_a")).join(
        b.select(key, units(col_b, value_scale).alias("_b")), key)
    j = j.filter(F.col("_a").isNotNull() & F.col("_b").isNotNull())
    return j.agg(exact_ratio(F.sum(F.abs(F.col("_a") - F.col("_b"))),
                             F.count(F.lit(1)) * F.lit(10 ** value_scale), digits).alias("mean_abs_diff"),
                 F.count(F.lit(1)).alias("n"))
