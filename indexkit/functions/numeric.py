"""Exact arithmetic helpers.

Sums of doubles depend on the order rows arrive in, so every quantity that
is summed is first cast to a narrow DECIMAL (exact, and long-backed while the
precision stays <= 18), and every published ratio is rounded from the exact
decimal quotient: half-up, like the reference's ROUND on its warehouse.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Ratios are rounded in whole numbers: (2 n 10^k + d) div 2 d, on numerators and
# denominators with up to six decimals.  Magnitudes up to 1e24 fit.
MICRO = DecimalType(32, 6)
WHOLE = DecimalType(38, 0)
# A sum of weight x value (both whole) is carried as two long-backed sums, for the
# value's part above and below SPLIT.  They stay fast and hold while the weights
# of a group sum to less than 9e15; beyond that Spark raises, never wraps.
SPLIT = 1000
# Values with up to twelve decimals are split higher; weights may then sum to 9e12.
FINE_SPLIT = 10 ** 6


def split_of(value_scale: int) -> int:
    return SPLIT if value_scale <= 6 else FINE_SPLIT


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_ratio(num, den, digits: int = 4, zero=None) -> Column:
    """round(num / den, digits) as DOUBLE, computed from exact decimals.

    ``den == 0`` gives ``zero`` (None → NULL, like NULLIF; 0 → DIV0).
    A NULL operand gives NULL.
    """
    n, d = _col(num), _col(den)
    million, power = F.lit(Decimal(10) ** 6).cast("decimal(7,0)"), F.lit(Decimal(10) ** digits).cast(f"decimal({digits + 1},0)")
    top = F.abs((n.cast(MICRO) * million).cast(WHOLE))
    low = F.abs((F.nullif(d, F.lit(0)).cast(MICRO) * million).cast(WHOLE))
    two = F.lit(2).cast("decimal(1,0)")
    half_up = F.call_function("div", ((top * power).cast(WHOLE) * two).cast(WHOLE) + low, (low * two).cast(WHOLE))
    sign = F.when((n < 0) != (d < 0), -1).otherwise(1)
    q = (sign * half_up).cast("double") / F.lit(float(10 ** digits))
    if zero is None:
        return q
    return F.when(d == 0, F.lit(float(zero))).otherwise(q)


def split_sums(weight: Column, value: Column, name: str, split: int = SPLIT) -> list[Column]:
    """Aggregates of the exact sum of weight x value, in two parts."""
    return [F.sum(weight * F.call_function("div", value, F.lit(split))).alias(f"{name}_hi"),
            F.sum(weight * (value % F.lit(split))).alias(f"{name}_lo")]


def split_total(name: str, split: int = SPLIT) -> Column:
    return F.col(f"{name}_hi").cast(WHOLE) * F.lit(split).cast("decimal(7,0)") + F.col(f"{name}_lo").cast(WHOLE)


def div0(num, den, digits: int = 4) -> Column:
    """DIV0 then ROUND: 0 when the denominator is 0, NULL when an operand is."""
    return exact_ratio(num, den, digits, zero=0)


def quotient_key(num: Column, den: Column) -> Column:
    """A text that orders and compares like the exact quotient of two whole
    numbers (den > 0; NULL otherwise), by long division to 32 decimals.

    Different quotients of denominators below 9e15 differ by more than 1e-32,
    so they get different keys, and equal ones the same."""
    n, d = num.cast(WHOLE), F.when(den > 0, den.cast(DecimalType(16, 0)))
    shift = F.lit(Decimal(10) ** 16).cast(DecimalType(17, 0))

    def div(a: Column) -> Column:
        return F.call_function("div", a, d)
    # floored, so the remainder is never negative
    rest = F.pmod(n, d)
    whole = div(n - rest)
    digits = []
    for _ in range(2):
        scaled = (rest.cast(DecimalType(16, 0)) * shift).cast(WHOLE)
        digits.append(div(scaled))
        rest = F.pmod(scaled, d)
    high = (whole.cast(DecimalType(20, 0)) + F.lit(Decimal(10) ** 18).cast(DecimalType(19, 0))).cast(DecimalType(20, 0))
    return F.concat(F.lpad(high.cast("string"), 20, "0"), *[F.lpad(x.cast("string"), 16, "0") for x in digits])


def to_dec(c, precision: int = 18, scale: int = 4) -> Column:
    """Exact decimal view of a double that carries at most ``scale`` digits."""
    return _col(c).cast(DecimalType(precision, scale))


def weighted_parts(value, weight):
    """(numerator, denominator) of a weighted mean over rows where the value
    is present: Σ w·v and Σ w (v not NULL).  Aggregate expressions."""
    v, w = _col(value), _col(weight)
    return F.sum(w * v), F.sum(F.when(v.isNotNull(), w).otherwise(F.lit(0)))


def weighted_mean(value, weight, digits: int = 4) -> Column:
    """Σ(w·v) / NULLIF(Σ w over rows with v, 0), rounded.  Aggregate."""
    num, den = weighted_parts(value, weight)
    return exact_ratio(num, den, digits)


def safe_divide(num, den) -> Column:
    """Plain double division that is NULL instead of an error on 0."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
