"""Column cleaning expressions (trim, codes, guarded casts, label maps)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for right results.
# Null tokens of the labour-statistics files (after trim; the empty string
# is always a null token):
OEWS_NULL_TOKENS = ("*", "#", "**", "NA", "N/A")
# Null tokens of the task-catalogue files:
ONET_NULL_TOKENS = ("n/a", "N/A")
# Total row of the occupation code list:
TOTAL_OCC_CODE = "00-0000"
# Area type code -> label (dimension) and -> granularity (region axis):
AREA_TYPE_LABELS = {"1": "National", "2": "State", "3": "Territory",
                    "4": "Metropolitan", "6": "Nonmetropolitan"}
AREA_TYPE_OTHER = "Other"
GRANULARITY_LABELS = {"2": "State", "4": "Metropolitan", "6": "Nonmetropolitan"}
# Strings accepted as numbers before a guarded cast (no NaN/Infinity,
# no type suffixes such as '5d').
NUMERIC_PATTERN = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    return F.trim(_col(c))


def lower_trim(c) -> Column:
    return F.lower(F.trim(_col(c)))


def null_tokens(c, tokens: Iterable[str] = ()) -> Column:
    """Trimmed value, or NULL for the empty string and any token."""
    t = F.trim(_col(c))
    toks = [""] + list(tokens)
    return F.when(t.isin(toks), F.lit(None).cast("string")).otherwise(t)


def standardize_code(c, n: int = 7) -> Column:
    """LEFT(TRIM(code), n): '11-1011.00' -> '11-1011'."""
    return F.left(F.trim(_col(c)), F.lit(n))


def major_group(c) -> Column:
    """First two characters, '??' for shorter or missing codes."""
    s = _col(c)
    return F.when(F.length(s) >= 2, F.substring(s, 1, 2)).otherwise(F.lit("??"))


def numeric_text(c) -> Column:
    """Trimmed text with thousands separators removed, or NULL if it is not
    a plain decimal number (guards try_cast against 'NaN', '5d', ...)."""
    t = F.replace(F.trim(_col(c)), F.lit(","), F.lit(""))
    return F.when(t.rlike(NUMERIC_PATTERN), t)


def parse_number(c, dtype: str = "double") -> Column:
    """Safe number: commas removed, bad text -> NULL (TRY_TO_DOUBLE /
    TRY_TO_DECIMAL)."""
    return numeric_text(c).try_cast(dtype)


def parse_int(c) -> Column:
    """TRY_TO_NUMBER: decimal text rounds half-up to an integer, else NULL."""
    return numeric_text(c).try_cast("decimal(38,0)").try_cast("bigint")


def default_if_blank(c, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(_col(c)), F.lit("")), F.lit(default))


def label_case(c, mapping: Mapping[str, str], default: str | None = None) -> Column:
    """CASE c WHEN k THEN v ... ELSE default END."""
    s = _col(c)
    out = None
    for k, v in mapping.items():
        out = F.when(s == F.lit(k), F.lit(v)) if out is None else out.when(s == F.lit(k), F.lit(v))
    return out.otherwise(F.lit(default).cast("string"))


def normalize(c, lo: float = 1.0, hi: float = 5.0) -> Column:
    """(x - lo) / (hi - lo): importance 1..5 -> 0..1."""
    return (_col(c) - F.lit(lo)) / F.lit(hi - lo)


def not_blank(c) -> Column:
    s = _col(c)
    return s.isNotNull() & (F.trim(s) != "")


def is_blank(c) -> Column:
    s = _col(c)
    return s.isNull() | (F.trim(s) == "")
