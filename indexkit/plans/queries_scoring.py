"""Registered queries: scoring-run jobs, synthetic scores, sampling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from indexkit.functions import clean as C
from indexkit.functions.hashing import hash_score
from indexkit.operators import scoring as SC
from indexkit.operators import relational as REL
from indexkit.plans import standins as S
from indexkit.plans.queries_ops import LI_ORDER
from indexkit.plans.registry import query
from indexkit.session import written
from indexkit.sources import ingest as I

# Our own prompt template (placeholders are filled from columns).
TEMPLATE = ("Task {{TASK_ID}} of occupation {{ONET_SOC_CODE}} "
            "({{OCCUPATION_TITLE}}: {{OCCUPATION_DESCRIPTION}}). Type: {{TASK_TYPE}}. "
            "Importance: {{IMPORTANCE_RAW}} on a 1-5 scale. Statement: {{TASK_STATEMENT}}")
FIELDS = ("TASK_ID", "ONET_SOC_CODE", "OCCUPATION_TITLE", "OCCUPATION_DESCRIPTION", "TASK_TYPE",
          "IMPORTANCE_RAW", "TASK_STATEMENT")


def task_id():
    return F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_suppkey")],
                       F.date_format("l_shipdate", "yyyyMMdd"))


#: Columns that name a task, and those that decide which of its rows stays.
TASK_COLUMNS = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_partkey"]
TASK_ORDER = [c for c in LI_ORDER if c not in TASK_COLUMNS]

#: One line item of each task.
ONE_LINE_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(TASK_COLUMNS)}
                               ORDER BY {', '.join(c + ' NULLS FIRST' for c in TASK_ORDER)}) AS rn
  FROM lineitem) WHERE rn = 1"""


def one_line_per_task(spark, sf_dir):
    """The line items without repeats of a task, so that joins on the task key
    give one row per task."""
    return REL.dedupe_one(S.read(spark, sf_dir, "lineitem"), TASK_COLUMNS, TASK_ORDER)


def _worklist_tables(spark, sf_dir, lines=None):
    """Statements, importance and occupation context, each from its own scan of
    ``lines`` (all line items); order, line, supplier, ship date and part name a
    task."""
    li = S.read(spark, sf_dir, "lineitem") if lines is None else lines
    key = [task_id().alias("TASK_ID"), F.col("l_partkey").cast("string").alias("ONET_SOC_CODE")]
    st = li.select(*key, F.concat(F.lit("line "), F.col("l_linenumber").cast("string"), F.lit(" of order "),
                                  F.col("l_orderkey").cast("string")).alias("TASK_STATEMENT"),
                   F.when(F.col("l_returnflag") == "A", F.lit("Core"))
                    .when(F.col("l_returnflag") == "N", F.lit("Supplemental")).alias("TASK_TYPE"))
    im = li.filter("l_linestatus = 'F'").select(*key, F.col("l_quantity").alias("IMPORTANCE_RAW"))
    ctx = S.read(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("ONET_SOC_CODE"), F.col("p_name").alias("OCCUPATION_TITLE"),
        F.col("p_type").alias("OCCUPATION_DESCRIPTION"))
    return st, im, ctx


def _worklist(spark, sf_dir):
    return SC.build_worklist(*_worklist_tables(spark, sf_dir))


TASK_ID_SQL = ("CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) "
               "|| '-' || strftime(l_shipdate, '%Y%m%d')")

WORKLIST_SQL = f"""
WITH st AS (SELECT {TASK_ID_SQL} AS TASK_ID, CAST(l_partkey AS VARCHAR) AS ONET_SOC_CODE,
              'line ' || CAST(l_linenumber AS VARCHAR) || ' of order ' || CAST(l_orderkey AS VARCHAR) AS TASK_STATEMENT,
              CASE l_returnflag WHEN 'A' THEN 'Core' WHEN 'N' THEN 'Supplemental' END AS TASK_TYPE,
              CASE WHEN l_linestatus = 'F' THEN l_quantity END AS IMPORTANCE_RAW FROM lineitem)
SELECT st.TASK_ID, st.ONET_SOC_CODE, st.TASK_STATEMENT,
       coalesce(nullif(trim(st.TASK_TYPE), ''), 'n/a') AS TASK_TYPE, st.IMPORTANCE_RAW,
       coalesce(p_name, '') AS OCCUPATION_TITLE, coalesce(p_type, '') AS OCCUPATION_DESCRIPTION
FROM st LEFT JOIN part ON st.ONET_SOC_CODE = CAST(p_partkey AS VARCHAR)"""


@query("worklist", WORKLIST_SQL, ids=("C01", "J01"))
def q_worklist(spark, sf_dir):
    return _worklist(spark, sf_dir).select("TASK_ID", "ONET_SOC_CODE", "TASK_STATEMENT", "TASK_TYPE",
                                           "IMPORTANCE_RAW", "OCCUPATION_TITLE", "OCCUPATION_DESCRIPTION")


def _prompt_sql():
    out = []
    rest = TEMPLATE
    while "{{" in rest:
        pre, after = rest.split("{{", 1)
        name, rest = after.split("}}", 1)
        out.append("'" + pre.replace("'", "''") + "'")
        if name == "IMPORTANCE_RAW":
            out.append("coalesce(printf('%.2f', CAST(IMPORTANCE_RAW AS DOUBLE)), 'not rated')")
        elif name in ("OCCUPATION_TITLE", "OCCUPATION_DESCRIPTION"):
            out.append(f"coalesce(nullif({name}, ''), '(not available)')")
        else:
            out.append(f"coalesce(CAST({name} AS VARCHAR), '')")
    out.append("'" + rest.replace("'", "''") + "'")
    return " || ".join(out)


@query("prompt_text", f"SELECT TASK_ID, ONET_SOC_CODE, {_prompt_sql()} AS PROMPT FROM ({WORKLIST_SQL}) w",
       ids=("C03",))
def q_prompt_text(spark, sf_dir):
    return SC.render_prompt(_worklist(spark, sf_dir), TEMPLATE, FIELDS).select("TASK_ID", "ONET_SOC_CODE", "PROMPT")


def _hex_mod_sql(h: str) -> str:
    acc = "CAST(0 AS BIGINT)"
    for i in range(8):
        acc = f"(({acc}) * 296 + CAST('0x' || substr({h}, {8 * i + 1}, 8) AS BIGINT)) % 1000"
    return acc


@query("hash_score", f"""
SELECT TASK_ID, ONET_SOC_CODE,
       ({_hex_mod_sql("sha256('exposure:' || ONET_SOC_CODE || ':' || TASK_ID)")}) / 1000.0 AS SYNTHETIC_SCORE
FROM ({WORKLIST_SQL}) w""", ids=("C02",))
def q_hash_score(spark, sf_dir):
    w = _worklist(spark, sf_dir)
    return w.select("TASK_ID", "ONET_SOC_CODE",
                    hash_score("exposure", "ONET_SOC_CODE", "TASK_ID").alias("SYNTHETIC_SCORE"))


UNIQUE_WORKLIST_SQL = f"""
WITH d AS ({ONE_LINE_SQL}),
st AS (SELECT {TASK_ID_SQL} AS TASK_ID, CAST(l_partkey AS VARCHAR) AS ONET_SOC_CODE,
              'line ' || CAST(l_linenumber AS VARCHAR) || ' of order ' || CAST(l_orderkey AS VARCHAR) AS TASK_STATEMENT,
              CASE l_returnflag WHEN 'A' THEN 'Core' WHEN 'N' THEN 'Supplemental' END AS TASK_TYPE FROM d),
im AS (SELECT {TASK_ID_SQL} AS TASK_ID, CAST(l_partkey AS VARCHAR) AS ONET_SOC_CODE, l_quantity AS IMPORTANCE_RAW
       FROM d WHERE l_linestatus = 'F')
SELECT st.TASK_ID, st.ONET_SOC_CODE, st.TASK_STATEMENT,
       coalesce(nullif(trim(st.TASK_TYPE), ''), 'n/a') AS TASK_TYPE, im.IMPORTANCE_RAW,
       coalesce(p_name, '') AS OCCUPATION_TITLE, coalesce(p_type, '') AS OCCUPATION_DESCRIPTION
FROM st LEFT JOIN im ON st.TASK_ID = im.TASK_ID AND st.ONET_SOC_CODE = im.ONET_SOC_CODE
        LEFT JOIN part ON st.ONET_SOC_CODE = CAST(p_partkey AS VARCHAR)"""

SAMPLE_SQL = f"""
WITH t AS (SELECT *, CASE WHEN length(ONET_SOC_CODE) >= 2 THEN substr(ONET_SOC_CODE, 1, 2) ELSE '??' END AS stratum,
                  sha256('42:' || TASK_ID) AS h
           FROM ({UNIQUE_WORKLIST_SQL}) w WHERE IMPORTANCE_RAW IS NOT NULL),
sz AS (SELECT stratum, COUNT(*) AS size FROM t GROUP BY stratum),
tot AS (SELECT SUM(size) AS total FROM sz),
al AS (SELECT stratum, greatest(1, CAST(round_even(250.0 * size / total, 0) AS INTEGER)) AS k FROM sz, tot),
r AS (SELECT t.*, al.k, row_number() OVER (PARTITION BY t.stratum ORDER BY h) AS rn FROM t JOIN al USING (stratum))
SELECT TASK_ID, ONET_SOC_CODE, stratum AS MAJOR_GROUP, OCCUPATION_TITLE, TASK_TYPE,
       printf('%.2f', CAST(IMPORTANCE_RAW AS DOUBLE)) AS IMPORTANCE_RAW, TASK_STATEMENT, OCCUPATION_DESCRIPTION
FROM r WHERE rn <= k ORDER BY h LIMIT 250"""


def _sample(spark, sf_dir):
    """Line items are deduplicated by task first.  Only keys are sampled; the
    texts of the at most 250 chosen tasks are fetched by a broadcast of those."""
    st, im, ctx = _worklist_tables(spark, sf_dir, written(one_line_per_task(spark, sf_dir), "tasks"))
    keys = im.filter("IMPORTANCE_RAW IS NOT NULL").select("TASK_ID", "ONET_SOC_CODE")
    chosen = written(SC.stratified_sample(keys, C.major_group("ONET_SOC_CODE"), "TASK_ID", 250, 42), "sample")
    key = ["TASK_ID", "ONET_SOC_CODE"]
    few = [d.join(F.broadcast(chosen.select(*key)), key, "left_semi") for d in (st, im)]
    codes = ctx.join(F.broadcast(chosen.select("ONET_SOC_CODE").distinct()), "ONET_SOC_CODE", "left_semi")
    s = SC.build_worklist(*few, codes).join(F.broadcast(chosen), key)
    return s.select("TASK_ID", "ONET_SOC_CODE", F.col("_stratum").alias("MAJOR_GROUP"), "OCCUPATION_TITLE",
                    "TASK_TYPE", F.format_string("%.2f", F.col("IMPORTANCE_RAW").cast("double")).alias("IMPORTANCE_RAW"),
                    "TASK_STATEMENT", "OCCUPATION_DESCRIPTION")


@query("stratified_sample", SAMPLE_SQL, ids=("C07", "W10", "T07", "P03"))
def q_stratified_sample(spark, sf_dir):
    return _sample(spark, sf_dir)


ANNOT_COLS = [f"{m}_annot{a}" for m in ("ai_exposure", "automation", "augmentation") for a in (1, 2)]


@query("annotation_sheet", f"""
SELECT *, {', '.join(f"'' AS {c}" for c in ANNOT_COLS)}, '' AS annotator_notes FROM ({SAMPLE_SQL}) s""",
       ids=("C08", "S17"))
def q_annotation_sheet(spark, sf_dir):
    return SC.annotation_sheet(_sample(spark, sf_dir), ("ai_exposure", "automation", "augmentation"), 2)


def _response_text(k):
    def dd(x):
        return F.concat(F.lit("0."), F.lpad(x.cast("string"), 2, "0"))
    return F.concat(
        F.lit('{"ai_exposure_score": '), F.when(k >= 95, F.lit("1.2")).otherwise(dd(k)),
        F.lit(', "automation_score": '), dd((k * 7) % 100),
        F.lit(', "augmentation_score": '), dd((k * 3) % 100),
        F.lit(', "confidence": 0.9, "rationale": "'), F.repeat(F.lit("r"), k * 3), F.lit('"}'))


RESPONSE_SQL = """
SELECT event_id, CASE WHEN event_type = 'error' THEN 'not json at all'
                      WHEN event_type = 'signup' THEN '{"ai_exposure_score": 0.5}'
                      ELSE '{"ai_exposure_score": ' || CASE WHEN k >= 95 THEN '1.2' ELSE '0.' || lpad(CAST(k AS VARCHAR), 2, '0') END
                        || ', "automation_score": 0.' || lpad(CAST((k * 7) % 100 AS VARCHAR), 2, '0')
                        || ', "augmentation_score": 0.' || lpad(CAST((k * 3) % 100 AS VARCHAR), 2, '0')
                        || ', "confidence": 0.9, "rationale": "' || repeat('r', k * 3) || '"}' END AS RESPONSE
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""


def _field(f):
    return f"TRY_CAST(json_extract_string(RESPONSE, '$.{f}') AS DOUBLE)"


def _response_parse_sql():
    fields = list(SC.RESPONSE_FIELDS)
    err = ["WHEN NOT json_valid(RESPONSE) THEN 'response is not a JSON object'"]
    for f in fields:
        err.append(f"WHEN {_field(f)} IS NULL THEN 'missing or invalid field {f}'")
    err.append("WHEN json_extract_string(RESPONSE, '$.rationale') IS NULL THEN 'missing or invalid field rationale'")
    for f in fields:
        err.append(f"WHEN NOT ({_field(f)} BETWEEN 0.0 AND 1.0) THEN '{f} out of range [0, 1]'")
    err.append("WHEN length(json_extract_string(RESPONSE, '$.rationale')) > 240 THEN 'rationale longer than 240'")
    e = "CASE " + " ".join(err) + " END"
    cols = ", ".join(f"CASE WHEN ERROR_MESSAGE IS NULL THEN round_even({_field(f)}, 4) END AS {f.upper()}"
                     for f in fields)
    return f"""
SELECT event_id, RESPONSE, {cols},
       CASE WHEN ERROR_MESSAGE IS NULL THEN json_extract_string(RESPONSE, '$.rationale') END AS RATIONALE,
       ERROR_MESSAGE
FROM (SELECT *, left({e}, 500) AS ERROR_MESSAGE FROM ({RESPONSE_SQL}) r)"""


def _responses(spark, sf_dir):
    e = S.read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    e = e.withColumn("k", k)
    text = (F.when(F.col("event_type") == "error", F.lit("not json at all"))
             .when(F.col("event_type") == "signup", F.lit('{"ai_exposure_score": 0.5}'))
             .otherwise(_response_text(F.col("k"))))
    return e.select("event_id", text.alias("RESPONSE"))


@query("response_parse", _response_parse_sql(), ids=("C05",))
def q_response_parse(spark, sf_dir):
    return SC.parse_score_response(_responses(spark, sf_dir), "RESPONSE")


SCORE_OUT = StructType([
    StructField("TASK_ID", StringType()), StructField("ONET_SOC_CODE", StringType()),
    StructField("AI_EXPOSURE_SCORE", DoubleType()), StructField("AUTOMATION_SCORE", DoubleType()),
    StructField("AUGMENTATION_SCORE", DoubleType()), StructField("CONFIDENCE", DoubleType()),
    StructField("RATIONALE", StringType()), StructField("ERROR_MESSAGE", StringType()),
])


def offline_scorer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Deterministic stand-in for a model client (vectorised over the batch):
    scores from the prompt length, an error row for some prompt lengths."""
    n = pdf["PROMPT"].str.len().to_numpy()
    base = (n % 97) / 96.0
    err = np.where(n % 17 == 0, "scorer error: empty response", None)
    ok = pd.isna(err)
    def scores(values):
        # error rows get NULL (nullable Float64 -> Arrow null), never NaN
        return pd.Series(values, dtype="Float64").where(ok, pd.NA)
    out = pd.DataFrame({
        "TASK_ID": pdf["TASK_ID"].to_numpy(), "ONET_SOC_CODE": pdf["ONET_SOC_CODE"].to_numpy(),
        "AI_EXPOSURE_SCORE": scores(np.round(base, 4)),
        "AUTOMATION_SCORE": scores(np.round(base * 0.5, 4)),
        "AUGMENTATION_SCORE": scores(np.round(1 - base, 4)),
        "CONFIDENCE": scores(np.full(len(pdf), 0.8)),
        "RATIONALE": np.where(ok, "offline stand-in score", None),
        "ERROR_MESSAGE": err,
    })
    return out


def _scored_sql():
    n = "length(PROMPT)"
    base = f"(({n} % 97) / 96.0::DOUBLE)"
    def four(x):
        return f"CASE WHEN {n} % 17 <> 0 THEN round_even({x} * 10000.0::DOUBLE, 0) / 10000.0::DOUBLE END"
    rid = SC.run_id("v2", "p1", TEMPLATE)
    return f"""
SELECT TASK_ID, ONET_SOC_CODE, {four(base)} AS AI_EXPOSURE_SCORE, {four(f"({base} * 0.5::DOUBLE)")} AS AUTOMATION_SCORE,
       {four(f"(1.0::DOUBLE - {base})")} AS AUGMENTATION_SCORE, CASE WHEN {n} % 17 <> 0 THEN 0.8::DOUBLE END AS CONFIDENCE,
       CASE WHEN {n} % 17 <> 0 THEN 'offline stand-in score' END AS RATIONALE,
       CASE WHEN {n} % 17 = 0 THEN 'scorer error: empty response' END AS ERROR_MESSAGE, '{rid}' AS SCORING_RUN_ID,
       'v2' AS RUBRIC_VERSION, '{rid.rsplit("_", 1)[1]}' AS RUBRIC_HASH, 'p1' AS PROMPT_VERSION, 'offline-stand-in' AS MODEL_ID
FROM (SELECT *, {_prompt_sql()} AS PROMPT FROM ({WORKLIST_SQL}) w) p WHERE TASK_TYPE <> 'Core'"""


@query("score_worklist", _scored_sql(), ids=("C04", "C06", "J17", "S09"))
def q_score_worklist(spark, sf_dir):
    """Resume a run: tasks already scored without error (stand-in: return flag
    'A') are skipped; the rest is scored batch by batch into a run ledger, each
    batch once, and tagged with the run."""
    w = SC.render_prompt(_worklist(spark, sf_dir), TEMPLATE, FIELDS)
    done = w.filter(F.col("TASK_TYPE") == "Core").select("TASK_ID", "ONET_SOC_CODE",
                                                         F.lit(None).cast("string").alias("ERROR_MESSAGE"))
    key = ["TASK_ID", "ONET_SOC_CODE"]
    todo = SC.pending(w, done, key).select(*key, "PROMPT")
    rid = SC.run_id("v2", "p1", TEMPLATE)
    ledger = SC.RunLedger(spark, I.work_dir(spark, "ledger"), rid, key)
    ledger.score(todo, offline_scorer, SCORE_OUT, batches=4)
    return SC.with_run_metadata(ledger.rows(), rid, "v2", rid.rsplit("_", 1)[1], "p1", "offline-stand-in")
