"""Conflict-constrained best-fit packing of documents into fixed windows.

Method: within a shard, items are placed largest first.  Open bins are kept in
order of residual space and carry one bitmap of the sources and one of the
duplicate clusters they hold.  The search starts at the tightest bin with
enough space (binary search) and goes on to its successors until the bitmaps
allow the item; if none does, a bin is opened.  So each item lands in the
tightest compatible bin of its shard.

A document longer than a window is cut into pieces: full windows and a rest;
nothing is dropped or truncated.  Shards are dealt by a hash of document and
piece and hold about ``SHARD_ITEMS`` items at any data size, so a source with a
third of all rows is spread over all shards.

Defined results: a null or empty text has size 1 (its end token); null sources
form one source; a null cluster conflicts with nothing; repeated rows are
items of their own; an empty table packs nothing; ties go by id, then piece.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexkit.llm.common import parts
from indexkit.llm.exact_dedup import normalised

WINDOW = 2048
SHARD_ITEMS = 4096


def n_tokens(text: Column) -> Column:
    """Words between white space, and one end token."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")) + 1


def packable(docs: DataFrame) -> DataFrame:
    """doc_id, size, source and the cluster of equal texts (white space and
    case aside) of documents."""
    return docs.select("doc_id", n_tokens(F.col("text")).alias("size"), "source",
                       F.xxhash64(F.lower(normalised(F.col("text")))).alias("cluster"))


def _bits(values: list) -> list[int]:
    """One bit per value that occurs twice or more; others conflict with nothing."""
    shared = {v: k for k, v in enumerate(v for v, n in Counter(values).items() if n > 1 and v is not None)}
    return [1 << shared[v] if v in shared else 0 for v in values]


def best_fit(sizes: list[int], sources: list, clusters: list, window: int) -> tuple[list[int], list[int]]:
    """Bin number and offset of each item; items come largest first."""
    source_bit, cluster_bit = _bits(sources), _bits(clusters)
    open_bins: list[tuple[int, int]] = []   # (residual, bin), ascending
    held_sources: list[int] = []
    held_clusters: list[int] = []
    bins, offsets = [], []
    for size, s, c in zip(sizes, source_bit, cluster_bit):
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins):
            b = open_bins[at][1]
            if not (held_sources[b] & s or held_clusters[b] & c):
                break
            at += 1
        if at < len(open_bins):
            residual, b = open_bins.pop(at)
            held_sources[b] |= s
            held_clusters[b] |= c
        else:
            residual, b = window, len(held_sources)
            held_sources.append(s)
            held_clusters.append(c)
        bins.append(b)
        offsets.append(window - residual)
        if residual > size:
            insort(open_bins, (residual - size, b))
    return bins, offsets


def pack(docs: DataFrame, window: int = WINDOW, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """Pack (doc_id, size, source, cluster) rows: one row per piece with
    doc_id, piece, n_tokens, source, cluster, bin_id, bin_offset."""
    whole = F.ceil(F.col("size") / window)
    items = docs.select(F.col("doc_id").isNull().alias("no_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"),
                        "source", "cluster", "size",
                        F.explode(F.sequence(F.lit(0).cast("long"), whole - 1)).alias("piece")) \
        .withColumn("n_tokens", F.least(F.lit(window), F.col("size") - F.col("piece") * window)).drop("size")
    shards = parts(items.count(), shard_items)
    items = items.withColumn("shard", F.pmod(F.xxhash64("no_id", "id", "piece", "cluster"), F.lit(shards)).cast("long"))

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n_tokens", "no_id", "id", "piece"], ascending=[False, True, True, True], kind="stable")
        sources = [("" if pd.isna(x) else "s" + x) for x in rows["source"]]
        clusters = [None if pd.isna(x) else x for x in rows["cluster"]]
        bins, offsets = best_fit(rows["n_tokens"].tolist(), sources, clusters, window)
        rows = rows.assign(doc_id=rows["id"].astype("Int64").mask(rows["no_id"]))
        return rows.assign(bin_id=(int(rows["shard"].iloc[0]) << 32) + np.asarray(bins), bin_offset=offsets)[
            ["doc_id", "piece", "n_tokens", "source", "cluster", "bin_id", "bin_offset"]]

    return items.withColumn("cluster", F.col("cluster").cast("string")).groupBy("shard").applyInPandas(
        place, "doc_id long, piece long, n_tokens long, source string, cluster string, bin_id long, bin_offset long")
