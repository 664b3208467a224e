"""Sort keys of exact quotients."""

import random
from fractions import Fraction

from pyspark.sql import functions as F

from indexkit.functions.numeric import quotient_key


def test_keys_order_like_fractions(spark):
    rng = random.Random(5)
    pairs = [(rng.randint(-2 ** 60, 2 ** 60), rng.randint(1, 8 * 10 ** 15)) for _ in range(300)]
    pairs += [(n * k, d * k) for n, d in [(1, 3), (2, 7), (10 ** 9 + 7, 998244353), (-5, 9)] for k in (1, 2, 3, 1000, 10 ** 6)]
    big = 2 ** 55 + 1
    pairs += [(big, 2 ** 52), (big + 1, 2 ** 52), (2 * big, 2 ** 52 * 2 - 1), (0, 5), (7, 0), (None, 3)]
    df = spark.createDataFrame([(i, None if n is None else str(n), d) for i, (n, d) in enumerate(pairs)], "i int, n string, d long")
    keys = {r.i: r.k for r in df.select("i", quotient_key(F.col("n").cast("decimal(38,0)"), F.col("d")).alias("k")).collect()}
    good = [i for i, (n, d) in enumerate(pairs) if n is not None and d]
    assert all(keys[i] is None for i in range(len(pairs)) if i not in good)
    want = {i: Fraction(*pairs[i]) for i in good}
    rank = {k: r for r, k in enumerate(sorted({keys[i] for i in good}))}
    place = {v: r for r, v in enumerate(sorted(set(want.values())))}
    assert all(rank[keys[i]] == place[want[i]] for i in good)


def test_scores_with_many_decimals_are_summed_exactly(spark):
    """Doubles with up to twelve decimals: no abort, the mean of the exact values."""
    from indexkit.operators.rollup import task_rollup
    rng = random.Random(9)
    rows = [("a", rng.randint(100, 500) / 100.0, rng.choice([0.123456789, 1 / 3, 0.1 + 0.2, 0.7, 1e-9, 1.0, 0.0])) for _ in range(200)]
    df = spark.createDataFrame(rows, "OCC_CODE string, IMPORTANCE_RAW double, s double").selectExpr(
        "*", "s AS AI_EXPOSURE_SCORE", "s AS AUTOMATION_SCORE", "1 - s AS AUGMENTATION_SCORE", "s AS CONFIDENCE")
    got = task_rollup(df, value_scale=12).first()
    total = sum(Fraction(round(w * 100)) for _, w, _ in rows)
    mean = sum(Fraction(round(w * 100)) * Fraction(round(s * 10 ** 12)) for _, w, s in rows) / total / 10 ** 12
    assert abs(got["occ_AI_EXPOSURE_SCORE"] - float(mean)) <= 0.0000501
    assert abs(got["occ_confidence"] - sum(s for _, _, s in rows) / len(rows)) <= 0.0000501
