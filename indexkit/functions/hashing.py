"""Deterministic hashes as native column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sha_hex(*cols, sep: str = ":") -> Column:
    """Hex sha256 of the columns joined by ``sep``."""
    return F.sha2(F.concat_ws(sep, *[_col(c).cast("string") for c in cols]), 256)


def sha8(c) -> Column:
    """First eight hex characters of sha256 (run ids, prompt hashes)."""
    return F.left(F.sha2(_col(c).cast("string"), 256), F.lit(8))


def hex_mod(hex_col, modulus: int = 1000) -> Column:
    """int(hex, 16) % modulus for a 64-character hex string: a Horner fold
    over eight 32-bit chunks with (2**32 mod modulus) as the step, so the
    accumulator stays far below the BIGINT range."""
    h = _col(hex_col)
    step = (2 ** 32) % modulus
    acc = F.lit(0).cast("bigint")
    for i in range(8):
        chunk = F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("bigint")
        acc = (acc * F.lit(step) + chunk) % F.lit(modulus)
    return acc


def hash_score(salt: str, *cols) -> Column:
    """Synthetic score in [0, 1): sha256('salt:c1:c2...') as an integer,
    mod 1000, / 1000."""
    return hex_mod(sha_hex(F.lit(salt), *cols)) / F.lit(1000.0)
