"""Exact deduplication of a new batch against an immutable snapshot.

Method: the distinct digests of the snapshot are kept in static binary-fuse
filters, one per digest shard.  Digests of the new batch are grouped first (so
duplicates inside the batch meet on their own, pre-aggregated), then screened
by the filter of their shard: a negative is certainly new; a positive joins the
exact bucket of its digest.  Every bucket of several rows is then checked byte
by byte (its smallest and largest normalised text must be the same bytes); a
bucket that fails is split by the text itself.

Defined results: a null text counts as empty; an empty table gives an empty
result; a repeated row (same id, same text) is one more member of its group and
exactly one member is kept; a null id sorts after all ids.  Columns of the
input other than ``doc_id`` and ``text`` are neither read nor needed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexkit.llm import fuse_filter
from indexkit.llm.common import may_match, parts, shielded, stored, without_keys

WHITE = " \t\n\x0b\x0c\r"
#: Distinct digests per filter shard; the number of shards grows with the data.
SHARD_KEYS = 16_384


def _rank() -> Column:
    """Order of members: most code points, then smallest id, then the text's
    hash, then first row: only rows of one id and text depend on the row order."""
    return F.struct((-F.col("n_cp")).alias("neg_cp"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "raw", "row_id")


def _raw() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def keyed(docs: DataFrame, fresh: Column) -> DataFrame:
    """One narrow row per document: id, length, digest and whether it belongs
    to the new batch; written once, as three later steps read it."""
    return stored(docs.select(
        F.monotonically_increasing_id().alias("row_id"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(F.coalesce("text", F.lit(""))).alias("n_cp"), _raw().alias("raw"),
        F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest"),
        fresh.alias("fresh")), "dedup-keys")


def _groups(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.count("*").alias("n"), F.min(_rank()).alias("best"))


def build_filters(groups: DataFrame, shards: int) -> DataFrame:
    """(shard, blob): one static filter per shard of a snapshot's digests."""
    def build(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]],
                             "blob": [fuse_filter.build(rows["key"].to_numpy().view(np.uint64))]})
    keys = groups.select(_shard(shards).alias("shard"), _key().alias("key"))
    return keys.groupBy("shard").applyInPandas(build, "shard int, blob binary")


def screen(groups: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Digests of ``groups`` that may be in the snapshot."""
    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return left[["digest"]].iloc[:0]
        hit = fuse_filter.contains(right["blob"].iloc[0], left["key"].to_numpy().view(np.uint64))
        return left.loc[hit, ["digest"]]
    keys = groups.select(_shard(shards).alias("shard"), _key().alias("key"), "digest")
    return keys.groupBy("shard").cogroup(filters.groupBy("shard")).applyInPandas(probe, "digest binary")


def _key() -> Column:
    return F.xxhash64("digest")


def _shard(shards: int) -> Column:
    return F.pmod(F.crc32("digest"), F.lit(shards)).cast("int")


def unequal_buckets(docs: DataFrame, digests: DataFrame) -> DataFrame:
    """Digests whose rows are not all the same bytes (a digest collision).
    ``min`` and ``max`` combine map-side, so a huge bucket ships few texts."""
    texts = docs.select(normalised(F.col("text")).alias("norm"))
    texts = may_match(texts.withColumn("digest", F.unhex(F.sha2("norm", 256))), digests, ["digest"]).join(digests, "digest")
    ends = texts.groupBy("digest").agg(F.min("norm").alias("lo"), F.max("norm").alias("hi"))
    return ends.filter(F.col("lo") != F.col("hi")).select("digest")


def deduplicate(docs: DataFrame, fresh: Column, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Groups of equal normalised text over snapshot (``fresh`` false) and new
    batch (``fresh`` true).  One row per input row: doc_id, keep_id,
    group_size, kept, text_sha256."""
    return _members(docs, fresh, shard_keys).drop("raw")


def _members(docs: DataFrame, fresh: Column, shard_keys: int = SHARD_KEYS) -> DataFrame:
    rows = keyed(docs, fresh)
    groups = stored(
        _groups(rows.filter(~F.col("fresh"))).withColumn("fresh", F.lit(False))
        .unionByName(_groups(rows.filter(F.col("fresh"))).withColumn("fresh", F.lit(True))), "dedup-groups")
    old, new = groups.filter(~F.col("fresh")), groups.filter(F.col("fresh"))
    shards = parts(groups.count(), shard_keys)
    hits = screen(new, build_filters(old, shards), shards)
    # exact buckets: a false positive of the filter finds no bucket here
    bucket = old.select("digest", F.col("n").alias("old_n"), F.col("best").alias("old_best"))
    met = stored(new.join(hits, "digest").join(bucket, "digest")
                 .select("digest", (F.col("n") + F.col("old_n")).alias("n"),
                         F.least("best", "old_best").alias("best")), "dedup-met")
    alone = groups.join(met.select("digest"), "digest", "left_anti").select("digest", "n", "best")
    final = stored(alone.unionByName(met).filter("n > 1"), "dedup-final")

    bad = stored(unequal_buckets(docs, final.select("digest")), "dedup-unequal")
    single = F.struct(F.lit(1).cast("long").alias("n"), _rank().alias("best"))
    out = rows.join(final, "digest", "left").select(
        "row_id", "doc_id", "digest", "n_cp", "raw",
        F.when(F.col("n").isNull(), single).otherwise(F.struct("n", "best")).alias("g"))
    result = out.select("doc_id", F.col("g.best.doc_id").alias("keep_id"), F.col("g.n").alias("group_size"),
                        (F.col("g.best.row_id") == F.col("row_id")).alias("kept"),
                        F.lower(F.hex("digest")).alias("text_sha256"), "raw", "row_id")
    if not bad.isEmpty():
        result = _split(docs, bad, result)
    return result.drop("row_id")


def _split(docs: DataFrame, bad: DataFrame, result: DataFrame) -> DataFrame:
    """Replace the rows of colliding digests by groups of the text itself."""
    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
                       F.char_length(F.coalesce("text", F.lit(""))).alias("n_cp"), _raw().alias("raw"),
                       normalised(F.col("text")).alias("norm"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("norm", 256))).join(bad, "digest")
    best = rows.groupBy("norm").agg(F.count("*").alias("n"), F.min(_rank()).alias("best"))
    redone = rows.join(best, "norm").select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("best.row_id") == F.col("row_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "raw", "row_id")
    marked = bad.select(F.lower(F.hex("digest")).alias("text_sha256"))
    return result.join(marked, "text_sha256", "left_anti").select(result.columns).unionByName(redone.select(result.columns))


def stable_half(doc_id: Column) -> Column:
    """New batch of the registered query: ids whose crc32 is odd."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 2 == 1


def deduplicate_rows(docs: DataFrame) -> DataFrame:
    """All columns of the rows that stay: of each group the row that
    ``deduplicate`` keeps.  Rows are told apart by id and whole text; of rows
    that repeat both, one stays."""
    rows = stored(_members(docs, stable_half(F.col("doc_id"))).select(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha"), F.col("raw").alias("__raw"), "kept"), "dedup-result")
    key = ["__id", "__sha", "__raw"]
    safe, restored = shielded(docs, ["doc_id", "text"])
    marked = safe.withColumn("__id", F.col("doc_id").cast("long")) \
        .withColumn("__sha", F.sha2(normalised(F.col("text")), 256)).withColumn("__raw", _raw())
    # rows whose key is only dropped go; a key with a kept and a dropped row is a repeated row
    keys = rows.groupBy(*key).agg(F.max("kept").alias("stays"), F.count("*").alias("n"))
    again = stored(keys.filter("stays AND n > 1").select(*key), "dedup-again")
    gone = keys.filter("NOT stays").select(*key).unionByName(again)
    kept = without_keys(marked, stored(gone, "dedup-gone"), key)
    twice = may_match(marked, again, key)
    names = again.select(*[F.col(c).alias(f"{c}2") for c in key])
    same = F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__sha") == F.col("__sha2")) & (F.col("__raw") == F.col("__raw2"))
    return restored(kept.unionByName(twice.join(names, same, "left_semi").dropDuplicates(key)))
