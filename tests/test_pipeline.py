"""Domain pipeline on the hand-made fixture (expected values worked by hand)."""

import os

import pytest
from pyspark.sql import functions as F

from domain_fixture import write_domain_files
from indexkit.plans import pipeline as P
from indexkit.sources.publish import Publication
from indexkit.schemas import OEWS_SCHEMA, SCORE_SCHEMA, TASK_RATING_SCHEMA, TASK_STATEMENT_SCHEMA
from indexkit.sources import ingest as I
from indexkit.functions.clean import OEWS_NULL_TOKENS, ONET_NULL_TOKENS


def _land(spark, d, out):
    paths = write_domain_files(d)
    oews = I.read_delimited(spark, [paths["oews_2023"], paths["oews_2024"]], OEWS_SCHEMA,
                            tokens=OEWS_NULL_TOKENS)
    oews = I.tag_year_from_file(oews)
    oews.write.mode("overwrite").parquet(os.path.join(out, "raw_oews"))
    oews = spark.read.parquet(os.path.join(out, "raw_oews"))
    good, bad = I.split_quarantine(oews)
    st = I.read_delimited(spark, paths["statements"], TASK_STATEMENT_SCHEMA, sep="\t", quote=None,
                          tokens=ONET_NULL_TOKENS, keep_corrupt=False)
    ra = I.read_delimited(spark, paths["ratings"], TASK_RATING_SCHEMA, sep="\t", quote=None,
                          tokens=ONET_NULL_TOKENS, keep_corrupt=False)
    runs = os.path.join(out, "raw_scores")
    for r in ("run_a", "run_b"):
        sc = I.read_delimited(spark, paths[f"scores_{r}"], SCORE_SCHEMA, keep_corrupt=False, multiline=True)
        I.append_run(sc, runs)
    return good, bad, st, ra, spark.read.parquet(runs)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("domain"))
    out = str(tmp_path_factory.mktemp("out"))
    good, bad, st, ra, scores = _land(spark, d, out)
    t = P.rebuild(spark, P.RawTables(good, st, ra, scores, None), out)
    return t, bad


def _rows(df, key):
    return {r[key]: r for r in df.collect()}


def test_quarantine_keeps_malformed_rows(built):
    _, bad = built
    assert bad.count() >= 1


def test_index_statuses_and_metrics(built):
    t, _ = built
    fact = _rows(t["occupation_exposure_fact"], "OCC_CODE")
    assert set(fact) == {"11-1011", "11-1021", "13-2011", "15-1252", "41-2031"}   # no wage -> dropped
    assert fact["11-1011"]["SCORE_STATUS"] == "SCORED"
    assert fact["11-1011"]["AI_EXPOSURE"] == 0.3778
    assert fact["11-1011"]["AUTOMATION"] == 0.2
    assert fact["11-1011"]["AUGMENTATION"] == 0.5111
    assert fact["11-1011"]["EXPOSURE_CONFIDENCE"] == 0.8
    # coverage exactly 0.80 is SCORED (inclusive threshold)
    assert fact["11-1021"]["IMPORTANCE_WEIGHT_COVERAGE"] == 0.8
    assert fact["11-1021"]["SCORE_STATUS"] == "SCORED"
    assert fact["13-2011"]["AI_EXPOSURE"] == 0.7          # the 1.2 score is range-guarded away
    assert fact["41-2031"]["SCORE_STATUS"] == "NO_ONET"
    assert fact["41-2031"]["AI_EXPOSURE"] is None
    assert fact["15-1252"]["EXPOSURE_RANK"] == 1 and fact["41-2031"]["EXPOSURE_RANK"] == 5
    assert fact["41-2031"]["WAGE_PERCENTILE"] == 0.0 and fact["11-1011"]["WAGE_PERCENTILE"] == 1.0
    assert fact["13-2011"]["WAGE_PERCENTILE"] == 0.25 == fact["15-1252"]["WAGE_PERCENTILE"]
    assert fact["11-1011"]["WAGE_BAND"] == "High" and fact["41-2031"]["WAGE_BAND"] == "Low"
    assert fact["11-1011"]["EXPOSURE_MODE"] == "REAL_TASK_SCORE"


def test_axes(built):
    t, _ = built
    ind = _rows(t["industry_exposure_fact"], "NAICS")
    assert ind["51"]["AI_EXPOSURE"] == 0.85 and ind["51"]["TOTAL_EMP"] == 1800
    assert ind["52"]["AI_EXPOSURE"] == 0.7 and ind["52"]["TOTAL_EMP"] == 700   # OWN_CODE 1235 excluded
    reg = {(r["GRANULARITY"], r["AREA"]): r for r in t["region_exposure_fact"].collect()}
    assert reg[("State", "06")]["EMP_COVERAGE"] == 0.45
    assert reg[("Nonmetropolitan", "0600001")]["AI_EXPOSURE"] is None
    assert len({g for g, _ in reg}) == 3
    wb = _rows(t["wage_band_exposure_fact"], "WAGE_BAND")
    assert wb["Low"]["AI_EXPOSURE"] == 0.8429 and wb["Low"]["EMP_COVERAGE"] == 0.4667
    assert wb["High"]["AI_EXPOSURE"] == 0.5352
    long = t["vw_exposure_axis"]
    assert long.count() == len(ind) + len(reg) + len(wb)


def test_dimensions_and_quality(built):
    t, _ = built
    ind = _rows(t["dim_industry"], "NAICS")
    assert ind["000000"]["INDUSTRY_TITLE"] == "Cross-industry"
    reg = _rows(t["dim_region"], "AREA")
    assert reg["99"]["AREA_TITLE"] == "U.S."     # newest year wins over "U.S. (old)"
    dq = t["dq_results"]
    ids = {r["CHECK_ID"] for r in dq.collect()}
    assert {1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 20, 21, 22, 23, 24, 25, 26, 27, 28} <= ids
    statuses = {(r["CHECK_ID"], r["CHECK_NAME"]): r["STATUS"] for r in dq.collect()}
    assert statuses[(20, "task scores out of range")] == "PASS"       # staging has dropped the 1.2 row
    assert statuses[(27, "state area count")] == "WARN"
    v = t["verdict"].first()
    assert v["VERDICT"] == ("BUILD HAS FAILURES" if v["QUALITY_FAILS"] else "BUILD OK")
    assert statuses[(25, "industry employment within the fact total")] in ("PASS", "FAIL")


def test_placeholder_mode(spark, tmp_path):
    d, out = str(tmp_path / "d"), str(tmp_path / "o")
    good, _bad, st, ra, _scores = _land(spark, d, out)
    # no sub-scores exist in this mode, so rule 21 fails and the rebuild says so
    with pytest.raises(P.QualityFailure) as failure:
        P.rebuild(spark, P.RawTables(good, st, ra, None, None), out)
    t = failure.value.tables
    assert {r["CHECK_NAME"]: r["STATUS"] for r in t["dq_results"].collect()}["exposure mode"] == "WARN"
    fact = _rows(t["occupation_exposure_fact"], "OCC_CODE")
    assert fact["11-1011"]["EXPOSURE_MODE"] == "PLACEHOLDER"
    # statements 1, 2, 3 have normalised importance 1, 0, 0.5
    assert fact["11-1011"]["AI_EXPOSURE"] == 0.5
    assert fact["11-1011"]["AUTOMATION"] is None
    assert fact["41-2031"]["SCORE_STATUS"] == "NO_ONET"


def test_one_command_refresh(spark, tmp_path):
    from indexkit import cli
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    write_domain_files(raw)
    code = cli.main(["refresh", "--raw", raw, "--out", out])
    assert code == 0                                   # staging drops the 1.2 score, so no rule fails
    fact = Publication(spark, out).table("occupation_exposure_fact")
    assert fact.count() == 5
    assert spark.read.parquet(os.path.join(out, "quarantine", "oews")).count() >= 1
    # a second refresh of the same files neither duplicates OEWS rows nor the log's fact
    before = spark.read.parquet(os.path.join(out, "raw_oews")).count()
    cli.main(["refresh", "--raw", raw, "--out", out])
    assert spark.read.parquet(os.path.join(out, "raw_oews")).count() == before
    assert spark.read.parquet(os.path.join(out, "raw_scores")).count() == 11   # each run file loaded once
    assert spark.read.parquet(os.path.join(out, "refresh_log")).count() == 2
    # and writes no table: the published version is still the first one
    published = Publication(spark, out).current()
    assert published["parent"] is None and len({e["path"].split("/")[1] for e in published["tables"].values()}) == 1


def test_changed_year_rewrites_its_descendants_only(spark, tmp_path):
    d, out = str(tmp_path / "d"), str(tmp_path / "o")
    good, _bad, st, ra, scores = _land(spark, d, out)
    names = lambda t: {r[0] for r in t["written"].collect()}
    first = P.rebuild(spark, P.RawTables(good, st, ra, scores, None), out, build="b1")
    assert "occupation_exposure_fact" in names(first) and len(names(first)) == 19
    assert names(P.rebuild(spark, P.RawTables(good, st, ra, scores, None), out, build="b2")) == set()
    # one more row of the older year: its staged table and what reads all years
    older = good.filter("DATA_YEAR = 2023 AND OCC_CODE <> '00-0000'").limit(1).withColumn("AREA", F.lit("98"))
    third = P.rebuild(spark, P.RawTables(good.unionByName(older), st, ra, scores, None), out, build="b3")
    assert names(third) == {"stg_oews@2023", "dim_region", "dim_industry", "dq_results"}
    assert Publication(spark, out).table("dim_region").filter("AREA = '98'").count() == 1
    # a promoted run changes the scores and what descends from them
    approved = spark.createDataFrame([("run_a", "2024-01-01")], "SCORING_RUN_ID string, APPROVED_AT string") \
        .withColumn("APPROVED_AT", F.col("APPROVED_AT").cast("timestamp"))
    try:
        fourth = P.rebuild(spark, P.RawTables(good.unionByName(older), st, ra, scores, approved), out, build="b4")
    except P.QualityFailure as e:
        fourth = e.tables
    assert "stg_scores" in names(fourth) and not {"stg_national", "dim_task", "stg_oews@2024"} & names(fourth)


def test_failed_rebuild_leaves_the_old_version(spark, tmp_path, monkeypatch):
    d, out = str(tmp_path / "d"), str(tmp_path / "o")
    good, _bad, st, ra, scores = _land(spark, d, out)
    P.rebuild(spark, P.RawTables(good, st, ra, scores, None), out, build="b1")
    before = sorted(map(str, Publication(spark, out).table("occupation_exposure_fact").collect()))
    # a build that breaks half way
    monkeypatch.setattr(P.ix, "axis_wage_band", lambda f: f.select(F.raise_error(F.lit("lost")).alias("x")))
    more = good.unionByName(good.filter("DATA_YEAR = 2024").limit(1))
    with pytest.raises(Exception, match="lost"):
        P.rebuild(spark, P.RawTables(more, st, ra, scores, None), out, build="b2")
    monkeypatch.undo()
    assert not os.path.exists(os.path.join(out, "versions", "b2"))
    # and one whose rules FAIL: its results are kept, its tables are not published
    with pytest.raises(P.QualityFailure):
        P.rebuild(spark, P.RawTables(good, st, ra, None, None), out, build="b3")
    assert Publication(spark, out).current()["build"] == "b1"
    assert sorted(map(str, Publication(spark, out).table("occupation_exposure_fact").collect())) == before
    history = spark.read.parquet(os.path.join(out, "quality_history"))
    assert {r[0] for r in history.select("BUILD_ID").distinct().collect()} == {"b1", "b3"}


def test_build_clock(spark, tmp_path):
    from indexkit.session import BUILD_TIME
    d, out = str(tmp_path / "d"), str(tmp_path / "o")
    good, _bad, st, ra, scores = _land(spark, d, out)
    spark.conf.set(BUILD_TIME, "2024-05-06T07:08:09.000010")
    try:
        t = P.rebuild(spark, P.RawTables(good, st, ra, scores, None), out)
        stamps = {str(r[0]) for n, c in (("dq_results", "CHECKED_AT"), ("refresh_log", "REFRESHED_AT"))
                  for r in t[n].select(F.col(c).cast("string")).collect()}
    finally:
        spark.conf.unset(BUILD_TIME)
    assert stamps == {"2024-05-06 07:08:09.00001"}
