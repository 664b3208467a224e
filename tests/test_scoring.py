"""Score responses, resume, stratified sample (checked against brute force)."""

import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from indexkit.operators import scoring as SC


def test_parse_responses(spark):
    rows = [(1, '{"ai_exposure_score": 0.5, "automation_score": 0.25, "augmentation_score": 1.0, '
                '"confidence": 0.9, "rationale": "ok"}'),
            (2, '{"ai_exposure_score": 1.5, "automation_score": 0.2, "augmentation_score": 0.1, '
                '"confidence": 0.9, "rationale": "x"}'),
            (3, '{"ai_exposure_score": 0.5}'),
            (4, "not json"),
            (5, '{"ai_exposure_score": 0.1, "automation_score": 0.2, "augmentation_score": 0.1, '
                '"confidence": 0.9, "rationale": "' + "r" * 241 + '"}')]
    out = {r["id"]: r for r in SC.parse_score_response(spark.createDataFrame(rows, "id long, t string"), "t").collect()}
    assert out[1]["ERROR_MESSAGE"] is None and out[1]["AI_EXPOSURE_SCORE"] == 0.5
    assert out[2]["ERROR_MESSAGE"] == "ai_exposure_score out of range [0, 1]"
    assert out[3]["ERROR_MESSAGE"].startswith("missing or invalid field")
    assert out[4]["ERROR_MESSAGE"] == "response is not a JSON object"
    assert out[5]["ERROR_MESSAGE"] == "rationale longer than 240"


def test_pending_skips_successful_rows(spark):
    work = spark.createDataFrame([("1", "a"), ("2", "a"), ("3", "a")], "TASK_ID string, ONET_SOC_CODE string")
    done = spark.createDataFrame([("1", "a", None, "r"), ("2", "a", "boom", "r")],
                                 "TASK_ID string, ONET_SOC_CODE string, ERROR_MESSAGE string, SCORING_RUN_ID string")
    got = sorted(r["TASK_ID"] for r in SC.pending(work, done, ["TASK_ID", "ONET_SOC_CODE"], run="r").collect())
    assert got == ["2", "3"]


def test_run_id_is_deterministic():
    assert SC.run_id("v2", "p1", "rubric") == SC.run_id("v2", "p1", "rubric")
    assert SC.run_id("v2", "p1", "rubric").startswith("v2_p1_")


def test_stratified_sample_matches_brute_force(spark):
    tasks = [(str(i), f"{(i * 7) % 23:02d}-{i:04d}") for i in range(1, 700)]
    df = spark.createDataFrame(tasks, "TASK_ID string, SOC string")
    got = [r["TASK_ID"] for r in SC.stratified_sample(df, F.substring("SOC", 1, 2), "TASK_ID", 50, 42,
                                                      salt_buckets=4).collect()]
    h = lambda t: hashlib.sha256(f"42:{t}".encode()).hexdigest()
    groups = defaultdict(list)
    for t, soc in tasks:
        groups[soc[:2]].append(t)
    sample = []
    for g, items in sorted(groups.items()):
        items.sort(key=h)
        sample.extend(items[:max(1, round(50 * len(items) / len(tasks)))])
    sample.sort(key=h)
    assert got == sample[:50]


def test_render_prompt(spark):
    df = spark.createDataFrame([("7", None, "")], "TASK_ID string, IMPORTANCE_RAW double, OCCUPATION_TITLE string")
    t = "T{{TASK_ID}} imp {{IMPORTANCE_RAW}} title {{OCCUPATION_TITLE}}"
    r = SC.render_prompt(df, t, ["TASK_ID", "IMPORTANCE_RAW", "OCCUPATION_TITLE"]).first()["PROMPT"]
    assert r == "T7 imp not rated title (not available)"


def test_stratified_sample_hot_stratum(spark):
    """One stratum holds 90% of the rows and every salt group is far larger
    than n: sizes must still count every row."""
    tasks = [(str(i), ("AA" if i % 10 else "B%d" % (i % 7)) + "-x") for i in range(1, 20000)]
    df = spark.createDataFrame(tasks, "TASK_ID string, SOC string")
    got = [r["TASK_ID"] for r in SC.stratified_sample(df, F.substring("SOC", 1, 2), "TASK_ID", 30, 7,
                                                      salt_buckets=4).collect()]
    h = lambda t: hashlib.sha256(f"7:{t}".encode()).hexdigest()
    groups = defaultdict(list)
    for t, soc in tasks:
        groups[soc[:2]].append(t)
    sample = []
    for g, items in sorted(groups.items()):
        items.sort(key=h)
        sample.extend(items[:max(1, round(30 * len(items) / len(tasks)))])
    sample.sort(key=h)
    assert got == sample[:30]
