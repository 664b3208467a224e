"""Scoring-run jobs as Spark jobs: work-list, prompt text, run metadata,
response parsing, resumable scoring with an injected batch scorer, and the
stratified calibration sample.

The scorer itself (a network client) is not part of the package; any
callable ``pandas.DataFrame -> pandas.DataFrame`` runs inside
``mapInPandas`` on Arrow batches, one partition at a time.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from indexkit.functions.hashing import sha8, sha_hex
from indexkit.operators.ranking import range_buckets
from indexkit.session import written
from indexkit.sources.publish import append_once, folders

RESPONSE_FIELDS = ("ai_exposure_score", "automation_score", "augmentation_score", "confidence")
RESPONSE_SCHEMA = StructType([StructField(f, DoubleType()) for f in RESPONSE_FIELDS]
                             + [StructField("rationale", StringType())])
MAX_RATIONALE = 240
MAX_ERROR = 500


def build_worklist(statements: DataFrame, importance: DataFrame, context: DataFrame,
                   keys: Sequence[str] = ("TASK_ID", "ONET_SOC_CODE"),
                   code: str = "ONET_SOC_CODE") -> DataFrame:
    """statements ⟕ importance on the task key, ⟕ occupation context on the
    code; missing context becomes blank, missing task type 'n/a'."""
    w = statements.join(importance, list(keys), "left").join(context, code, "left")
    return (w.withColumn("OCCUPATION_TITLE", F.coalesce("OCCUPATION_TITLE", F.lit("")))
             .withColumn("OCCUPATION_DESCRIPTION", F.coalesce("OCCUPATION_DESCRIPTION", F.lit("")))
             .withColumn("TASK_TYPE", F.coalesce(F.nullif(F.trim("TASK_TYPE"), F.lit("")), F.lit("n/a"))))


def render_prompt(df: DataFrame, template: str, fields: Sequence[str], out: str = "PROMPT") -> DataFrame:
    """Fill ``{{FIELD}}`` placeholders of a user-supplied template from
    columns (plain string concatenation, no Python per row).  Importance is
    shown with two decimals or 'not rated'; blank context as
    '(not available)'."""
    parts: list[Column] = []
    rest = template
    while "{{" in rest:
        pre, after = rest.split("{{", 1)
        name, rest = after.split("}}", 1)
        parts.append(F.lit(pre))
        if name not in fields:
            raise KeyError(f"template field {name} not in {fields}")
        parts.append(field_text(name))
    parts.append(F.lit(rest))
    return df.withColumn(out, F.concat(*parts))


def field_text(name: str) -> Column:
    c = F.col(name)
    if name == "IMPORTANCE_RAW":
        # format_string('%.2f', NULL) yields 'nu' (Java formats the text "null")
        return F.when(c.isNull(), F.lit("not rated")).otherwise(F.format_string("%.2f", c.cast("double")))
    if name in ("OCCUPATION_TITLE", "OCCUPATION_DESCRIPTION"):
        return F.coalesce(F.nullif(c, F.lit("")), F.lit("(not available)"))
    return F.coalesce(c.cast("string"), F.lit(""))


def run_id(rubric_version: str, prompt_version: str, rubric_text: str) -> str:
    """Deterministic run id: no timestamp, so a resumed run keeps its id."""
    import hashlib
    return f"{rubric_version}_{prompt_version}_{hashlib.sha256(rubric_text.encode('utf-8')).hexdigest()[:8]}"


def with_run_metadata(df: DataFrame, rid: str, rubric_version: str, rubric_hash: str,
                      prompt_version: str, model_id: str) -> DataFrame:
    """Provenance columns on every row (driver-side literals)."""
    return (df.withColumn("SCORING_RUN_ID", F.lit(rid)).withColumn("RUBRIC_VERSION", F.lit(rubric_version))
              .withColumn("RUBRIC_HASH", F.lit(rubric_hash)).withColumn("PROMPT_VERSION", F.lit(prompt_version))
              .withColumn("MODEL_ID", F.lit(model_id)))


def parse_score_response(df: DataFrame, col: str) -> DataFrame:
    """Parse a structured score object; valid rows get four scores rounded
    to 4 decimals (half-even, like the scorer) and the rationale, invalid
    rows an ERROR_MESSAGE (<= 500 chars) and NULL scores."""
    p = F.from_json(F.col(col), RESPONSE_SCHEMA, {"mode": "PERMISSIVE"})
    d = df.withColumn("_p", p)
    is_json = F.get_json_object(F.col(col), "$").isNotNull() & F.col("_p").isNotNull()
    err = F.when(~is_json, F.lit("response is not a JSON object"))
    for f in RESPONSE_FIELDS + ("rationale",):
        err = err.when(F.col(f"_p.{f}").isNull(), F.lit(f"missing or invalid field {f}"))
    for f in RESPONSE_FIELDS:
        err = err.when(~F.col(f"_p.{f}").between(0.0, 1.0), F.lit(f"{f} out of range [0, 1]"))
    err = err.when(F.length(F.col("_p.rationale")) > MAX_RATIONALE, F.lit("rationale longer than 240"))
    d = d.withColumn("ERROR_MESSAGE", F.left(err, F.lit(MAX_ERROR)))
    ok = F.col("ERROR_MESSAGE").isNull()
    cols = [F.when(ok, F.bround(F.col(f"_p.{f}"), 4)).alias(f.upper()) for f in RESPONSE_FIELDS]
    return d.select(*[c for c in df.columns], *cols,
                    F.when(ok, F.col("_p.rationale")).alias("RATIONALE"), "ERROR_MESSAGE")


def pending(worklist: DataFrame, done: DataFrame, keys: Sequence[str], run: str | None = None,
            run_col: str = "SCORING_RUN_ID", error_col: str = "ERROR_MESSAGE") -> DataFrame:
    """Resume: work-list rows without a successful row (no error) in this run."""
    ok = done.filter(F.col(error_col).isNull() | (F.trim(F.col(error_col)) == ""))
    if run is not None:
        ok = ok.filter(F.col(run_col) == F.lit(run))
    return worklist.join(ok.select(*keys).distinct(), list(keys), "left_anti")


def score_worklist(df: DataFrame, scorer: Callable, out_schema: StructType) -> DataFrame:
    """Run a batch scorer over Arrow batches of the pending rows.  The scorer
    must return one row per input row with ``out_schema``; failures should be
    reported in an ERROR_MESSAGE column, not raised (error rows are kept)."""
    def run(batches):
        for pdf in batches:
            yield scorer(pdf)
    return df.mapInPandas(run, out_schema)


class RunLedger:
    """Scored batches of one run, each committed once.

    A call to ``score`` is an attempt: the tasks without a success in earlier
    attempts, dealt into batches by a hash of their key.  A batch is written
    aside and committed by a rename to ``BATCH_ID=a<attempt>-b<batch>of<batches>``.
    An attempt that broke off is resumed: its pending tasks depend on earlier
    attempts only, so the missing batches are the same rows, and a batch that
    was committed, even by a writer that is still running, can't be added again."""

    def __init__(self, spark, path: str, run: str, keys: Sequence[str], error_col: str = "ERROR_MESSAGE"):
        self.spark, self.keys, self.error_col = spark, list(keys), error_col
        self.path = f"{path.rstrip('/')}/SCORING_RUN_ID={run}"

    def committed(self) -> dict[tuple[int, int], set[int]]:
        """(attempt, number of its batches) -> batches that are there."""
        out: dict[tuple[int, int], set[int]] = {}
        for name in folders(self.spark, self.path):
            m = re.fullmatch(r"BATCH_ID=a(\d+)-b(\d+)of(\d+)", name)
            if m:
                out.setdefault((int(m[1]), int(m[3])), set()).add(int(m[2]))
        return out

    def rows(self, before: int | None = None) -> DataFrame | None:
        """All committed rows (of attempts below ``before``); None if there are none."""
        paths = [f"{self.path}/BATCH_ID=a{a}-b{k}of{n}" for (a, n), ks in sorted(self.committed().items())
                 if before is None or a < before for k in sorted(ks)]
        return self.spark.read.parquet(*paths) if paths else None

    def score(self, worklist: DataFrame, scorer: Callable, out_schema: StructType, batches: int = 16) -> int:
        """Score what is pending; returns the number of batches this call committed."""
        seen = self.committed()
        attempt, done = 0, set()
        if seen:
            (attempt, n), done = max(seen.items())
            if len(done) == n:
                attempt, done = attempt + 1, set()
            else:
                batches = n
        earlier = self.rows(before=attempt)
        todo = worklist if earlier is None else pending(worklist, earlier, self.keys, error_col=self.error_col)
        todo = written(todo, "pending")
        if not done and todo.isEmpty():
            return 0
        count = 0
        for k in range(batches):
            if k not in done:
                part = todo.filter(F.pmod(F.xxhash64(*self.keys), F.lit(batches)) == k)
                count += append_once(self.spark, self.path, score_worklist(part, scorer, out_schema),
                                     f"a{attempt}-b{k}of{batches}", "BATCH_ID")
        return count


def stratified_sample(df: DataFrame, strata: Column, key: str, n: int, seed: int,
                      salt_buckets: int | None = None) -> DataFrame:
    """Proportional allocation k = max(1, round_half_even(n * size / total))
    per stratum, rows ordered by sha256('seed:key') inside the stratum; the
    union is trimmed to n by the same order (not padded).

    One pass over the input, skew-safe: rows are spread over
    (stratum, salt) groups; one window there yields both the hash order and
    the group size, and only the first n rows of each group survive (k <= n).
    Stratum sizes are the sums of the group sizes, so the second window sees
    at most ``salt_buckets * n`` rows per stratum and no task holds a whole
    stratum."""
    salt_buckets = salt_buckets or range_buckets(df)
    d = (df.withColumn("_stratum", strata).withColumn("_h", sha_hex(F.lit(seed), F.col(key)))
           .withColumn("_salt", F.pmod(F.xxhash64(F.col(key)), F.lit(salt_buckets))))
    w1 = Window.partitionBy("_stratum", "_salt")
    d = (d.withColumn("_r1", F.row_number().over(w1.orderBy("_h")))
          .withColumn("_cs", F.count(F.lit(1)).over(w1))
          .filter(F.col("_r1") <= F.lit(n)))
    sizes = d.filter(F.col("_r1") == 1).groupBy("_stratum").agg(F.sum("_cs").alias("_size"))
    total = sizes.agg(F.sum("_size").alias("_total"))
    # one row per stratum of any strata column: AQE broadcasts it if it is small
    alloc = sizes.crossJoin(F.broadcast(total)).select(
        "_stratum", F.greatest(F.lit(1), F.bround(F.lit(float(n)) * F.col("_size") / F.col("_total"), 0)
                               .cast("int")).alias("_k"))
    d = d.join(alloc, "_stratum")
    w2 = Window.partitionBy("_stratum").orderBy("_h")
    d = d.withColumn("_r2", F.row_number().over(w2)).filter(F.col("_r2") <= F.col("_k"))
    return d.orderBy("_h").limit(n).drop("_r1", "_r2", "_salt", "_k", "_cs")


def annotation_sheet(sample: DataFrame, metrics: Sequence[str], annotators: int) -> DataFrame:
    """Blank annotation columns, annotator by annotator, plus notes."""
    out = sample
    for a in range(1, annotators + 1):
        for m in metrics:
            out = out.withColumn(f"{m}_annot{a}", F.lit(""))
    return out.withColumn("annotator_notes", F.lit(""))


__all__ = ["RunLedger", "build_worklist", "render_prompt", "run_id", "with_run_metadata", "parse_score_response",
           "pending", "score_worklist", "stratified_sample", "annotation_sheet", "sha8"]
