"""Findings of round 3: repeats of a task, bounded writes, parsing once, quantiles
of every language, one pass over the lines for all axes."""

from __future__ import annotations

import datetime as dt
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from indexkit.operators import agreement as AG
from indexkit.operators import quality as Q
from indexkit.functions import clean as C
from indexkit.plans import queries_scoring as QS
from indexkit.plans import queries_staging as QG
from indexkit.session import open_files

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def twice(spark, tmp_path_factory):
    """The small tables with line items that repeat tasks in other amounts."""
    d = str(tmp_path_factory.mktemp("twice"))
    for n in os.listdir(SF):
        if n != "lineitem.parquet":
            shutil.copy(os.path.join(SF, n), os.path.join(d, n))
    rows = [(o, line, 3, dt.date(1995, 3, 1), 7, q, 100.0, 0.05, 0.04, "A", "F") for o in (1, 2) for line in (1, 2) for q in (5.0, 9.0)]
    have = spark.read.parquet(f"{SF}/lineitem.parquet")
    names = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_partkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    made = spark.createDataFrame(rows, names)
    made.select(*[(F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in have.schema]) \
        .coalesce(1).write.parquet(f"{d}/lineitem.parquet")
    return d


def test_repeats_of_a_task_are_dropped_before_joins(spark, twice):
    tasks = QG.q_staging_tasks(spark, twice).collect()
    assert len(tasks) == 4 and {r["IMPORTANCE_RAW"] for r in tasks} == {0.5}
    assert QG.q_pilot(spark, twice).count() == 4


def test_sample_holds_a_task_once(spark, twice):
    sample = QS.q_stratified_sample(spark, twice).collect()
    assert len(sample) == 4 and {r["IMPORTANCE_RAW"] for r in sample} == {"5.00"}
    assert QS.q_annotation_sheet(spark, twice).count() == 4


def test_scores_text_is_gone_once_landed(spark):
    runs = QG._land_scores(spark, SF)
    root = os.path.dirname(os.path.dirname(os.path.dirname(runs.inputFiles()[0].removeprefix("file://"))))
    assert os.listdir(root) == ["runs"]
    assert runs.count() > 0


def test_partitioned_writes_do_not_sort(spark, tmp_path):
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    with open_files(spark):
        assert int(spark.conf.get(key)) > 0
        spark.range(100).select("id", (F.col("id") % 70).alias("p")).write.partitionBy("p").parquet(str(tmp_path / "t"))
    assert spark.conf.get(key) == before
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("p").count().count() == 70


def test_range_guard_parses_a_column_once(spark):
    raw = spark.createDataFrame([("0.5",), ("1,0",), ("NaN",), (None,), ("-0.1",), ("1",), ("x",)], "s string")
    d = Q.range_guard(raw.select("s", C.parse_number("s").alias("v")), ["v"])
    assert sorted(r["s"] for r in d.collect()) == ["0.5", "1"]
    plan = d._jdf.queryExecution().optimizedPlan().toString()
    condition = next(line for line in plan.splitlines() if "Filter" in line)
    assert condition.count("try_cast") <= 1


def test_rater_mean_rounds_half_up_in_whole_numbers(spark):
    df = spark.createDataFrame([(0.0001, 0.0002, None), (-0.0001, -0.0002, None), (0.5, None, float("nan")), (None, None, None),
                                (0.1, 0.2, 0.2)], "a double, b double, c double")
    got = [(r["rater_mean"], r["raters_present"]) for r in AG.rater_mean(df, ["a", "b", "c"]).collect()]
    assert got == [(0.0002, 2), (-0.0002, 2), (0.5, 1), (None, 0), (0.1667, 3)]
    two = [r["rater_mean"] for r in AG.rater_mean(df, ["a", "b", "c"], digits=2).collect()]
    assert two == [0.0, 0.0, 0.5, None, 0.17]


def test_every_language_has_quantiles_of_its_own(spark, monkeypatch):
    from indexkit.llm import kneser_ney as KN
    monkeypatch.setattr(KN, "LANGUAGES", 2)
    marks = spark.createDataFrame([(lang, 1.0 + i) for lang in ("a", "b", "c", None) for i in range(3)], "lang string, perplexity double")
    assert {r["lang"] for r in KN.limits(marks).collect()} == {"a", "b", "c", None}


def test_more_languages_than_are_broadcast_are_judged_alike(spark, monkeypatch):
    from indexkit.llm import kneser_ney as KN
    docs = spark.createDataFrame([(i, f"text number {i} of some words", f"l{i % 4}") for i in range(40)], "doc_id long, text string, lang string")
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    few = {r["doc_id"]: r["accepted"] for r in KN.classify(docs, labels).collect()}
    monkeypatch.setattr(KN, "LANGUAGES", 2)
    assert {r["doc_id"]: r["accepted"] for r in KN.classify(docs, labels).collect()} == few


@pytest.mark.parametrize("name", ["axis_cells", "json_export"])
def test_axes_share_one_pass_over_the_lines(spark, monkeypatch, name):
    import __spark_entry__ as entry
    from indexkit.plans import standins as S
    calls = []
    whole = S.enriched_lines
    monkeypatch.setattr(S, "enriched_lines", lambda *a: calls.append(1) or whole(*a))
    assert entry.queries()[name](spark, SF).count() > 0
    assert len(calls) == 1


def test_every_character_has_a_code_of_its_own():
    from indexkit.llm import kneser_ney as KN
    chars = list(range(ord("a"), ord("a") + 26)) + list(range(0x400, 0x500)) + list(range(0x4E00, 0x4E00 + 3000))
    coder = KN.Coder(chars[:KN.ranked()])
    points = [*chars, 0x10FFFF, 0x1F600, 0, 10]
    codes = [tuple(coder.coded(chr(p)).tolist()) for p in points]
    assert len(set(codes)) == len(points) and {len(c) for c in codes} == {1, 2, 3, 5}
    assert all(0 < s < KN.SYMBOLS for c in codes for s in c)
    assert not any(c[:n] in set(codes) for c in codes for n in range(1, len(c)))  # no code begins another
    text = "".join(map(chr, points))
    assert coder.coded(text).tolist() == [s for c in codes for s in c]


def test_texts_in_a_minority_script_are_told_from_their_shuffles(spark):
    from indexkit.llm import kneser_ney as KN
    rng = random.Random(0)
    greek = [chr(c) for c in range(0x3B1, 0x3C9)]
    latin = "".join(chr(c) for c in range(33, 127))
    words = ["".join(rng.choices(greek, k=4)) for _ in range(12)]
    rows = [(latin * 6, 0)] * 20 + [(" ".join(rng.choices(words, k=30)), 0) for _ in range(20)]
    model = KN.fit(spark.createDataFrame(rows, "text string, fold int"))[0]
    usual = " ".join(rng.choices(words, k=30))
    junk = " ".join("".join(rng.sample(w, len(w))) for w in usual.split(" "))
    assert model.score(usual)[1] == model.score(junk)[1] == len(usual) + 1
    assert model.score(usual)[0] > model.score(junk)[0] + 10
