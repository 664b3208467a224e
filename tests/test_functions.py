"""Column expressions: guarded casts, codes, bands, hashes, exact ratios."""

import hashlib

from pyspark.sql import functions as F

from indexkit.functions import clean as C
from indexkit.functions.bands import band_case, cut_band
from indexkit.functions.hashing import hash_score, sha8
from indexkit.functions.numeric import div0, exact_ratio


def test_parse_number_and_int(spark):
    rows = [("1,234",), (" 12.6 ",), ("NaN",), ("5d",), ("#",), ("-0.5",), ("1e3",), (None,)]
    df = spark.createDataFrame(rows, "s string")
    out = df.select(C.parse_number("s").alias("d"), C.parse_int("s").alias("i")).collect()
    assert [r["d"] for r in out] == [1234.0, 12.6, None, None, None, -0.5, 1000.0, None]
    assert [r["i"] for r in out] == [1234, 13, None, None, None, -1, 1000, None]


def test_codes_and_labels(spark):
    df = spark.createDataFrame([(" 11-1011.00 ", "2"), ("7", "9")], "c string, t string")
    r = df.select(C.standardize_code("c").alias("s"), C.major_group(F.trim("c")).alias("m"),
                  C.label_case("t", C.AREA_TYPE_LABELS, C.AREA_TYPE_OTHER).alias("l"),
                  C.label_case("t", C.GRANULARITY_LABELS).alias("g")).collect()
    assert (r[0]["s"], r[0]["m"], r[0]["l"], r[0]["g"]) == ("11-1011", "11", "State", "State")
    assert (r[1]["m"], r[1]["l"], r[1]["g"]) == ("??", "Other", None)


def test_null_tokens_and_default(spark):
    df = spark.createDataFrame([(" * ",), ("",), ("x",), ("  ",)], "s string")
    r = df.select(C.null_tokens("s", C.OEWS_NULL_TOKENS).alias("n"),
                  C.default_if_blank("s", "unreviewed").alias("d")).collect()
    assert [x["n"] for x in r] == [None, None, "x", None]
    assert [x["d"] for x in r] == ["*", "unreviewed", "x", "unreviewed"]


def test_band_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.3333,), (0.6667,), (1.0,), (None,), (0.33329,)], "p double")
    r = df.select(band_case("p").alias("b"), cut_band("p").alias("c")).collect()
    assert [x["b"] for x in r] == ["Low", "Middle", "High", "High", None, "Low"]
    assert [x["c"] for x in r] == ["Low", "Mid", "High", "High", None, "Low"]


def test_hash_score_matches_python(spark):
    df = spark.createDataFrame([("11-1011.00", "7"), ("15-1252.00", "12345")], "code string, task string")
    got = [r["h"] for r in df.select(hash_score("salt", "code", "task").alias("h")).collect()]
    want = [int(hashlib.sha256(f"salt:{c}:{t}".encode()).hexdigest(), 16) % 1000 / 1000
            for c, t in [("11-1011.00", "7"), ("15-1252.00", "12345")]]
    assert got == want
    assert df.select(sha8(F.lit("abc")).alias("s")).first()["s"] == hashlib.sha256(b"abc").hexdigest()[:8]


def test_exact_ratio_half_up_ties(spark):
    df = spark.createDataFrame([(2469, 20000), (1, 8), (5, 0), (None, 3)], "n long, d long")
    r = df.select(exact_ratio("n", "d").alias("q"), div0("n", "d").alias("z")).collect()
    assert [x["q"] for x in r] == [0.1235, 0.125, None, None]
    assert [x["z"] for x in r] == [0.1235, 0.125, 0.0, None]
