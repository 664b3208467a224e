"""Self join of documents on the Jaccard similarity of their word n-grams.

Method (Bayesian candidate pruning):

1. Texts are reduced to sets of hashed shingles of ``WORDS`` words.  Texts with
   the same set form a text class; all further work is per class, so copies
   are never expanded.
2. ``HASHES`` MinHash values in ``BANDS`` bands deal classes into buckets.  A
   pair at the threshold meets in some band with probability
   1 - (1 - 0.8^4)^32 > 1 - 5e-8.
3. Inside a bucket, pairs compare their MinHash values ``STEP`` at a time and are
   dropped as soon as the posterior probability (uniform prior) of reaching the
   threshold falls below ``TOLERANCE``.  A bucket reports only a spanning
   forest of the surviving pairs.
4. The components of those forests are the groups in which every pair is
   verified exactly on the shingle sets.  Tasks report link counts and a
   spanning forest of the true links, never pairs.
5. The components of the true links are the near-duplicate classes.

Buckets and groups beyond ``BLOCK`` members (or ``BLOCK_SHINGLES`` shingles) are
dealt into blocks and each pair of blocks is a task of its own: no group lands
in one task, no pair is a row, and no bucket is capped.

Words are what lies between white space in the lower-cased text.  Defined
results: a text of fewer than five words is one shingle of its words; a null or
empty text has the empty set, equal only to itself; a repeated row is one more
copy; a null id sorts after all ids; an empty table gives an empty result;
columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexkit.llm.common import let_go, may_match, shielded, stored, text_slices, whole_groups, without_keys
from indexkit.llm.components import components, local_roots

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 32
TOLERANCE = 1e-7
BLOCK = 512
BLOCK_SHINGLES = 4_000_000
#: Pairs compared at a time, columns of a verification matrix, words remembered.
PAIRS, COLUMNS, MEMO = 200_000, 8192, 400_000
_P = np.uint64(0x9E3779B97F4A7C15)
_WHITE = " \t\n\x0b\x0c\r"
_TO_BLANK = str.maketrans(_WHITE, " " * len(_WHITE))


# ---- one text ------------------------------------------------------------
class Shingler:
    """Sorted distinct 64-bit shingle hashes of texts."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self._memo: dict[str, int] = {}

    def _hashes(self, found: list[str]) -> np.ndarray:
        if len(self._memo) > MEMO:
            self._memo.clear()
        memo = self._memo
        for w in set(found).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(memo.__getitem__, found), dtype=np.uint64, count=len(found))

    def __call__(self, text: str) -> np.ndarray:
        found = [w for w in text.lower().translate(_TO_BLANK).split(" ") if w]
        if not found:
            return np.zeros(0, dtype=np.uint64)
        h = self._hashes(found) if len(found) <= MEMO else \
            np.concatenate([self._hashes(found[i:i + MEMO]) for i in range(0, len(found), MEMO)])
        n = min(self.words, len(h))
        out = np.full(len(h) - n + 1, n, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                out = (out ^ h[k:k + len(out)]) * _P
                out ^= out >> np.uint64(32)
        return np.unique(out)


@lru_cache(maxsize=1)
def _factors() -> np.ndarray:
    return np.random.default_rng(20240229).integers(1, 2 ** 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """HASHES MinHash values (32 bits)."""
    least = np.full(HASHES, 2 ** 32 - 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 512):
            part = shingles[at:at + 512, None] * _factors()[None, :]
            np.minimum(least, (part >> np.uint64(32)).min(axis=0), out=least)
    return least.astype(np.uint32)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """For n = 0, STEP, 2 STEP, ...: the fewest of n equal values at which the
    posterior P(similarity >= threshold) is at least ``tolerance``.  With a
    uniform prior that posterior is P(Binomial(n + 1, threshold) <= matches)."""
    out = []
    for n in range(0, HASHES + 1, STEP):
        total = 0.0
        for m in range(n + 2):
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                out.append(m)
                break
    return out


# ---- pairs inside a bucket -------------------------------------------------
def surviving(sig: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs left after comparing their values step by step."""
    matched = np.zeros(len(i), dtype=np.int32)
    for step, least in enumerate(least_matches()[1:]):
        part = slice(step * STEP, (step + 1) * STEP)
        matched += (sig[i, part] == sig[j, part]).sum(axis=1, dtype=np.int32)
        keep = matched >= least
        i, j, matched = i[keep], j[keep], matched[keep]
    return i, j


def pair_runs(start: np.ndarray, size: np.ndarray, side: np.ndarray, cross: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of all groups, about PAIRS at a time: within a group, or for a
    ``cross`` group only between its two sides (side 0 comes first)."""
    simple = ~cross
    for s in np.unique(size[simple & (size > 1) & (size <= 64)]):
        at = start[simple & (size == s)]
        a, b = np.triu_indices(s, 1)
        per = max(1, PAIRS // len(a))
        for k in range(0, len(at), per):
            yield (at[k:k + per, None] + a).ravel(), (at[k:k + per, None] + b).ravel()
    for g in np.flatnonzero(cross | (size > 64)):
        rows = np.arange(start[g], start[g] + size[g])
        left = rows[side[rows] == 0] if cross[g] else rows
        right = rows[side[rows] == 1] if cross[g] else rows
        per = max(1, PAIRS // max(1, len(right)))
        for k in range(0, len(left), per):
            a, b = np.meshgrid(left[k:k + per], right, indexing="ij")
            keep = np.ones(a.shape, dtype=bool) if cross[g] else a < b
            yield a[keep], b[keep]


def _groups(frame: pd.DataFrame, key: list[str]) -> tuple[np.ndarray, np.ndarray]:
    change = np.ones(len(frame), dtype=bool)
    change[1:] = (frame[key].iloc[1:].to_numpy() != frame[key].iloc[:-1].to_numpy()).any(axis=1)
    start = np.flatnonzero(change)
    return start, np.diff(np.append(start, len(frame)))


def _blocked(members: DataFrame, key: str, node: str, blocks) -> DataFrame:
    """Members dealt into blocks; a row for each pair of blocks it is needed in:
    ``b1`` <= ``b2`` and the row's ``side`` (0 or 1)."""
    own = F.pmod(F.xxhash64(node, F.lit(7)), blocks).cast("int")
    return members.withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), blocks - 1))) \
        .withColumn("b1", F.least("__own", "__other")).withColumn("b2", F.greatest("__own", "__other")) \
        .withColumn("side", F.when(F.col("__own") == F.col("b1"), 0).otherwise(1)).drop("__own", "__other") \
        .repartition(key, "b1", "b2").sortWithinPartitions(key, "b1", "b2", "side")


# ---- the join ---------------------------------------------------------------
def text_classes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, mark (hash of the text), cls (hash of the shingle
    set), n (its size) and the MinHash values; written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        for batch, texts in text_slices(batches, 2):
            sets = [shingles(t) for t in texts]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("mark"),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "mark", "cls", "n", "sig"])
        del shingles
        let_go()
    return stored(_marked_docs(docs).mapInArrow(run, "doc_id long, mark long, cls binary, n long, sig binary"), "nj-docs")


def _marked_docs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"), "text")


def bucket_members(classes: DataFrame) -> DataFrame:
    """(bucket, cls, size) of every bucket with two members or more."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substring(F.col("sig"), b * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    rows = classes.filter("n > 0").select(F.explode(keys).alias("bucket"), "cls")
    full = rows.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    return rows.join(full, "bucket")


def candidate_edges(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Forest edges (a, b) of the pairs in each bucket that survive pruning."""
    held = members.join(classes.select("cls", "sig"), "cls")
    dealt = _blocked(held, "bucket", "cls", F.ceil(F.col("size") / BLOCK).cast("int"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = ["bucket", "b1", "b2"]
        for frame in whole_groups(batches, key):
            sig = np.frombuffer(b"".join(frame["sig"]), dtype=np.uint32).reshape(len(frame), HASHES)
            start, size = _groups(frame, key)
            cross = frame["b1"].to_numpy()[start] != frame["b2"].to_numpy()[start]
            left, right = [], []
            for i, j in pair_runs(start, size, frame["side"].to_numpy(), cross):
                i, j = surviving(sig, i, j)
                left.append(i)
                right.append(j)
            if left:
                root = local_roots(len(frame), np.concatenate(left), np.concatenate(right))
                node = np.flatnonzero(root != np.arange(len(frame)))
                cls = frame["cls"].to_numpy()
                yield pd.DataFrame({"a": cls[node], "b": cls[root[node]]})
        let_go()
    return dealt.select("bucket", "b1", "b2", "side", "cls", "sig").mapInPandas(run, "a binary, b binary")


def shared_shingles(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all sets of ``left`` with all of ``right``."""
    rows = np.concatenate([left, right]) if left is not right else left
    at = np.repeat(np.arange(len(rows)), [len(sets[r]) for r in rows])
    _, column = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)
    often = np.bincount(column)
    keep = often[column] > 1  # a shingle of one set is in no intersection
    at, column = at[keep], (np.cumsum(often > 1) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    at, column = at[order], column[order]
    first = 0 if left is right else len(left)
    total = np.zeros((len(left), len(right)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [low, low + COLUMNS])
        dense = np.zeros((len(rows), COLUMNS), dtype=np.float32)
        dense[at[a:b], column[a:b] - low] = 1
        total += dense[:len(left)] @ dense[first:].T
    return total


def verified(groups: DataFrame) -> DataFrame:
    """Rows (cls, texts, docs, root): links of a class found in one pair of
    blocks, and its forest edge there; over ``groups`` (root, cls, copies,
    shingles, size, total)."""
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    dealt = _blocked(groups, "root", "cls", blocks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = ["root", "b1", "b2"]
        for frame in whole_groups(batches, key):
            start, size = _groups(frame, key)
            side, copies, cls = frame["side"].to_numpy(), frame["copies"].to_numpy(), frame["cls"].to_numpy()
            sets = [np.frombuffer(s, dtype=np.uint64) for s in frame["shingles"]]
            length = np.array([len(s) for s in sets], dtype=np.float64)
            texts, docs = np.zeros(len(frame), dtype=np.int64), np.zeros(len(frame), dtype=np.int64)
            roots = np.arange(len(frame))
            for at, n in zip(start, size):
                rows = np.arange(at, at + n)
                cross = frame["b1"].iloc[at] != frame["b2"].iloc[at]
                left, right = (rows[side[rows] == 0], rows[side[rows] == 1]) if cross else (rows, rows)
                if not len(left) or not len(right) or n < 2:
                    continue
                both = shared_shingles(sets, left, right)
                either = length[left][:, None] + length[right][None, :] - both
                link = both >= THRESHOLD * either - 1e-9  # integers below 2^53; the slack only mends 0.8's rounding
                if not cross:
                    np.fill_diagonal(link, False)
                texts[left] += link.sum(1)
                docs[left] += link @ copies[right]
                if cross:
                    texts[right] += link.sum(0)
                    docs[right] += copies[left] @ link
                i, j = np.nonzero(link)
                local = local_roots(int(n), left[i] - at, right[j] - at)
                roots[rows] = local + at
            keep = texts > 0
            yield pd.DataFrame({"cls": cls[keep], "texts": texts[keep], "docs": docs[keep], "root": cls[roots[keep]]})
        let_go()
    return dealt.select("root", "b1", "b2", "side", "cls", "copies", "shingles") \
        .mapInPandas(run, "cls binary, texts long, docs long, root binary")


def _joined(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, mark, head and first (no_id, doc_id, mark of
    the first document of its near-duplicate class and of its text class),
    n_links and n_text_links."""
    rows = text_classes(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark"))
    classes = stored(rows.groupBy("cls").agg(first.alias("first"), F.count("*").alias("copies"), F.max("n").alias("n"),
                                             F.max("sig").alias("sig")), "nj-classes")
    edges = candidate_edges(stored(bucket_members(classes), "nj-members"), classes)
    near = components(edges).select(F.col("node").alias("cls"), "root")

    wanted = stored(near.join(classes.drop("sig"), "cls").select(
        "root", "cls", "copies", "n", F.col("first.doc_id").alias("doc_id"), F.col("first.mark").alias("mark")), "nj-wanted")
    size = wanted.groupBy("root").agg(F.count("*").alias("size"), F.sum("n").alias("total"))
    twice = rows.groupBy("doc_id", "mark").agg(F.count("*").alias("times")).filter("times > 1")
    groups = with_shingles(docs, wanted, twice).join(size, "root")
    found = stored(verified(groups), "nj-found")
    links = found.groupBy("cls").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs"))
    linked = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b"))) \
        .select(F.col("node").alias("cls"), "root")
    members = stored(linked.join(classes.select("cls", "first"), "cls").join(links, "cls"), "nj-linked")
    heads = members.groupBy("root").agg(F.min("first").alias("head"))
    by_class = members.join(heads, "root").select("cls", "head", "texts", "docs")

    every = classes.select("cls", "first", "copies").join(by_class, "cls", "left").select(
        "cls", F.coalesce("head", "first").alias("head"), "first",
        (F.coalesce("docs", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_text_links"))
    return rows.select("doc_id", "mark", "cls").join(every, "cls").drop("cls")


def join(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id (least id of its near-duplicate
    class), text_id (least id of the texts with the same shingles), n_links
    (other documents of similarity >= THRESHOLD, copies included) and
    n_text_links (other text classes among them)."""
    return _joined(docs).select("doc_id", F.col("head.doc_id").alias("class_id"), F.col("first.doc_id").alias("text_id"),
                                "n_links", "n_text_links")


def with_shingles(docs: DataFrame, wanted: DataFrame, twice: DataFrame) -> DataFrame:
    """``wanted`` plus the shingle set of each class, made anew from the text of
    its first document: storing all sets would cost more than the input.  Only
    classes whose first document is a repeated row (``twice``: doc_id, mark) need
    their texts sorted to pick one."""
    key = ["doc_id", "mark"]
    again = twice.select(*[F.col(c).alias(f"{c}3") for c in key])
    marked = wanted.join(again, F.col("doc_id").eqNullSafe(F.col("doc_id3")) & (F.col("mark") == F.col("mark3")), "left") \
        .withColumn("repeated", F.col("mark3").isNotNull()).drop("doc_id3", "mark3")
    marked = stored(marked, "nj-wanted-marked")

    def texts_of(some: DataFrame) -> DataFrame:
        names = some.select(*[F.col(c).alias(f"{c}2") for c in key], "root", "cls", "copies")
        return may_match(_marked_docs(docs), some, key).join(
            names, F.col("doc_id").eqNullSafe(F.col("doc_id2")) & (F.col("mark") == F.col("mark2"))) \
            .select("root", "cls", "copies", "text")
    texts = texts_of(marked.filter("NOT repeated")).unionByName(
        texts_of(marked.filter("repeated")).dropDuplicates(["cls"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler()
        for batch, found in text_slices(batches, 3):
            sets = [shingles(t).tobytes() for t in found]
            yield pa.RecordBatch.from_arrays([batch.column("root"), batch.column("cls"), batch.column("copies"),
                                              pa.array(sets, pa.binary())], names=["root", "cls", "copies", "shingles"])
        del shingles
        let_go()
    return stored(texts.mapInArrow(run, "root binary, cls binary, copies long, shingles binary"), "nj-sets")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """All columns of one document of each near-duplicate class: the one with
    the least id.  Rows are told apart by id and text, so neither an id on
    several texts nor a null id takes other rows along; of rows that repeat
    both, one stays."""
    key = ["__id", "__mark"]
    stays = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("mark") == F.col("head.mark"))
    found = _joined(docs).select(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark"), stays.alias("stays"))
    gone = stored(found.groupBy(*key).agg(F.max("stays").alias("stays"), F.count("*").alias("n"))
                  .filter("NOT stays OR n > 1"), "nj-gone")
    again = gone.filter("stays").select(*key)
    safe, restored = shielded(docs, ["doc_id", "text"])
    marked = safe.withColumn("__id", F.col("doc_id").cast("long")) \
        .withColumn("__mark", F.xxhash64(F.coalesce("text", F.lit(""))))
    names = again.select(*[F.col(c).alias(f"{c}2") for c in key])
    twice = may_match(marked, again, key).join(
        names, F.col("__id").eqNullSafe(F.col("__id2")) & (F.col("__mark") == F.col("__mark2")), "left_semi")
    return restored(without_keys(marked, gone.select(*key), key).unionByName(twice.dropDuplicates(key)))
