"""Corpus cleaning pipeline over ``documents``: five stages, each one call of an
operator of ``indexkit.llm``, written as Parquet and read back as the next
stage's input.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row its
predecessor kept; all but the last return the columns of ``documents``.  An
empty table passes through all stages; nulls, empty texts, repeated rows and
extra columns have the results the operators' docstrings define.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indexkit.llm import exact_dedup, kneser_ney, language_id, ngram_join, packing
from indexkit.llm.common import read, shielded, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A document whose best language reaches no more than this mean marginal goes.
LEAST_LANGUAGE_SCORE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language stay; texts without a letter or
    without a prevailing language go.  The model learns from the rows it is given."""
    safe, restored = shielded(docs, ["doc_id", "text", "lang"])
    kept = language_id.predict(safe, language_id.fit(safe, F.lit(True))).filter(
        (F.col("lang_pred") != "und") & (F.col("lang_score") > LEAST_LANGUAGE_SCORE))
    return restored(kept)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is usual for their language stay."""
    safe, restored = shielded(docs, ["doc_id", "text", "lang"])
    return restored(kneser_ney.classify(safe, read(spark, sf_dir, "labels")).filter("accepted"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal normalised texts stays."""
    return exact_dedup.deduplicate_rows(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class (five-word shingles,
    similarity 0.8 or more) stays."""
    return ngram_join.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in pieces where it is long, placed in a window."""
    return packing.pack(packing.packable(docs))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language),
    ("quality_classifier", quality),
    ("exact_dedup", exact_duplicates),
    ("ngram_jaccard_join", near_duplicates),
    ("best_fit_packing", pack),
]

#: Trained models and near-duplicate classes can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
