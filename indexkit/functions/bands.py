"""Half-open value bands (wage percentile bands, score bands)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

# Fixed values that must equal the reference's for right results:
# wage bands (name, min inclusive, max exclusive, order); the top bound is
# 1.01 so a percentile of exactly 1.0 is High.
WAGE_BANDS = (
    ("Low", 0.00, 0.3333, 1),
    ("Middle", 0.3333, 0.6667, 2),
    ("High", 0.6667, 1.01, 3),
)
# Score bands of the calibration comparison (cut points, labels).
SCORE_CUTS = (0.3333, 0.6667)
SCORE_BAND_LABELS = ("Low", "Mid", "High")

BAND_SCHEMA = StructType([
    StructField("WAGE_BAND", StringType()),
    StructField("WAGE_PERCENTILE_MIN", DoubleType()),
    StructField("WAGE_PERCENTILE_MAX", DoubleType()),
    StructField("BAND_ORDER", IntegerType()),
])


def bands_frame(spark: SparkSession, bands: Sequence = WAGE_BANDS) -> DataFrame:
    """Static band dimension as a DataFrame (DIM_WAGE_BAND)."""
    return spark.createDataFrame([tuple(b) for b in bands], BAND_SCHEMA)


def band_case(c, bands: Sequence = WAGE_BANDS, label_index: int = 0) -> Column:
    """Compile static half-open bands into a CASE chain (codegen friendly,
    no join).  NULL and out-of-range values stay NULL."""
    v = F.col(c) if isinstance(c, str) else c
    out = None
    for b in bands:
        label, lo, hi = b[label_index], b[1], b[2]
        cond = (v >= F.lit(lo)) & (v < F.lit(hi))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out


def band_order_case(c, bands: Sequence = WAGE_BANDS) -> Column:
    v = F.col(c) if isinstance(c, str) else c
    out = None
    for label, _lo, _hi, order in bands:
        out = F.when(v == F.lit(label), F.lit(order)) if out is None else out.when(v == F.lit(label), F.lit(order))
    return out


def cut_band(c, cuts: Sequence[float] = SCORE_CUTS,
             labels: Sequence[str] = SCORE_BAND_LABELS) -> Column:
    """Band by cut points: v < c1 -> labels[0], v < c2 -> labels[1], else the
    last label; NULL stays NULL."""
    v = F.col(c) if isinstance(c, str) else c
    out = F.when(v.isNull(), F.lit(None).cast("string"))
    for cut, label in zip(cuts, labels):
        out = out.when(v < F.lit(cut), F.lit(label))
    return out.otherwise(F.lit(labels[len(cuts)]))
