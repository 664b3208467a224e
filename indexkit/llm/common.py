"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import math
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from indexkit.session import ensure_checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, group_rows: int = 0) -> DataFrame:
    """Cut lineage: write ``df`` once as Parquet under the shared folder that
    ``spark.checkpoint.dir`` names and read it back.  A lost executor then costs
    a re-read, never a recomputation of what stands above.

    A writer holds a row group and a reader the rows of a batch, which ends with
    its row group: rows of megabytes need groups of ``group_rows``, or a task's
    memory grows with the rows of its file."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    (df.write.option("parquet.block.row.count.limit", group_rows) if group_rows else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(col: Column, n: int) -> Column:
    """``crc32`` of the id written as text, modulo ``n`` (a null id: of the empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit(""))) % F.lit(n)


def parts(n_rows: int, per_part: int) -> int:
    """Number of shards so that each holds about ``per_part`` rows."""
    return max(1, math.ceil(n_rows / per_part))


def let_go() -> None:
    """Give memory that a finished task has freed back to the machine: Python
    workers stay for the next task, and allocators keep what they once had."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


#: Bytes of text that are Python strings at a time (one longer text alone).
_TEXT_BYTES = 2 << 20


def text_slices(batches: Iterable[pa.RecordBatch], at: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Batches cut so that column ``at`` holds some ``_TEXT_BYTES``, each with that
    column's texts (null: empty).  Arrow batches can be far larger than what a
    task should hold as strings and results at once."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        lo = 0
        while lo < batch.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, before + _TEXT_BYTES, "right")))
            part = batch.slice(lo, hi - lo)
            yield part, [t or "" for t in part.column(at).to_pylist()]
            lo = hi


def with_columns_from_text(docs: DataFrame, make: Callable[[], tuple[Callable[[list[str]], list], Callable[[], None]]],
                           added: list[tuple[str, str]],
                           text: str = "text") -> DataFrame:
    """``docs`` plus columns computed from one text column by a Python function
    over slices of bounded size; nulls reach it as empty strings.  ``make`` runs once per
    task and gives the function and one that frees what it holds (Python
    workers outlive tasks).  All other columns pass as Arrow, untouched; a column of the name of
    an added one is replaced."""
    names = {n for n, _ in added}
    kept = docs.select([c for c in docs.columns if c not in names])
    extra = StructType.fromDDL(", ".join(f"{n} {t}" for n, t in added))
    schema = StructType(kept.schema.fields + extra.fields)
    types = [f.type for f in to_arrow_schema(extra)]
    at = kept.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn, free = make()
        try:
            for batch, texts in text_slices(batches, at):
                made = fn(texts)
                arrays = [pa.array(m, type=t) for m, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *arrays],
                                                 names=[*batch.schema.names, *(n for n, _ in added)])
        finally:
            free()
            let_go()
    return kept.mapInArrow(run, schema)


#: Size of results that ``mapped_rows`` hands on at a time.
_SLICE = 8 << 20


def mapped_rows(df: DataFrame, drop: list[str], reads: list[str], added: list[tuple[str, str]],
                row: Callable[..., tuple], weight: Callable[[tuple], int]) -> DataFrame:
    """``df`` without ``drop`` plus columns computed row by row from ``reads``,
    handed on in slices of bounded size."""
    names = [n for n, _ in added]
    keep = [c for c in df.columns if c not in names and c not in drop]
    extra = StructType.fromDDL(", ".join(f"{n} {t}" for n, t in added))
    schema = StructType([df.schema[c] for c in keep] + extra.fields)
    types = [f.type for f in to_arrow_schema(extra)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = batch.select(keep)
            inputs = [batch.column(batch.schema.get_field_index(c)) for c in reads]
            made: list[tuple] = []
            size, start = 0, 0
            for i in range(batch.num_rows):
                made.append(row(*(c[i].as_py() for c in inputs)))
                size += weight(made[-1])
                if size >= _SLICE or len(made) == 2048 or i + 1 == batch.num_rows:
                    arrays = [pa.array(c, type=t) for c, t in zip(zip(*made), types)]
                    yield pa.RecordBatch.from_arrays([*kept.slice(start, len(made)).columns, *arrays],
                                                     names=[*kept.schema.names, *names])
                    start, size, made = i + 1, 0, []
    return df.select([*keep, *[c for c in reads if c not in keep]]).mapInArrow(run, schema)


def takes(texts: list[str], chars: int) -> Iterator[list[str]]:
    """Texts in order, in lists of about ``chars`` characters."""
    held: list[str] = []
    size = 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def shielded(docs: DataFrame, needed: list[str]) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but ``needed`` renamed, so that no column an
    operator adds can clash with one of them, and the function that selects
    the original columns again."""
    names = [c if c in needed else f"__c{k}" for k, c in enumerate(docs.columns)]
    originals = docs.columns
    return docs.toDF(*names), lambda out: out.select(*names).toDF(*originals)


#: Bits of the bitmap that screens rows before they are shuffled: a broadcast of
#: at most BITS / 64 rows whatever the data.
BITS = 1 << 23


def _marked(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` plus ``__hit``: false only if no row of ``keys`` has its key."""
    bit = F.pmod(F.xxhash64(*on), F.lit(BITS))
    mask = F.expr("shiftleft(1L, CAST(__bit % 64 AS INT))")
    words = keys.select(bit.alias("__bit")).groupBy(F.expr("__bit DIV 64").alias("__word")) \
        .agg(F.bit_or(mask).alias("__bits"))
    return rows.withColumn("__bit", bit).withColumn("__word", F.expr("__bit DIV 64")) \
        .join(F.broadcast(words), "__word", "left") \
        .withColumn("__hit", F.coalesce(F.col("__bits").bitwiseAND(mask) != 0, F.lit(False))) \
        .drop("__bit", "__word", "__bits")


def may_match(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` without those that certainly match no row of ``keys``.  It only
    saves shuffling them; an exact join must follow."""
    return _marked(rows, keys, on).filter("__hit").drop("__hit")


def without_keys(rows: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Left anti join (null equals null) that shuffles only rows which may match."""
    marked = _marked(rows, keys, on)
    renamed = keys.select(*[F.col(c).alias(f"__k{i}") for i, c in enumerate(on)]).distinct()
    same = F.lit(True)
    for i, c in enumerate(on):
        same = same & F.col(c).eqNullSafe(F.col(f"__k{i}"))
    checked = marked.filter("__hit").join(renamed, same, "left_anti")
    return marked.filter("NOT __hit").unionByName(checked).drop("__hit")


def whole_groups(batches: Iterable[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """Re-cut sorted batches at group borders: every yielded frame holds
    complete groups only.  At most one batch plus one group is held."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch[key].iloc[-1]
        same = (batch[key] == last).all(axis=1).to_numpy()
        cut = len(batch) - int(same[::-1].argmin()) if not same.all() else 0
        if cut:
            held.append(batch.iloc[:cut])
            yield pd.concat(held, ignore_index=True) if len(held) > 1 else held[0].reset_index(drop=True)
            held = [batch.iloc[cut:]]
        elif held and not (held[-1][key].iloc[-1] == last).all():
            yield pd.concat(held, ignore_index=True)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pd.concat(held, ignore_index=True)
