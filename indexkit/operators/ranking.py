"""Global ranks that do not funnel every row into one task.

``Window.orderBy(v)`` without a partition compiles to ``Exchange
SinglePartition``: one task sorts the whole table.  Here the rows cross one
range exchange and carry their rank with them:

1. ``repartitionByRange`` on (partition columns, value, row hash) and a sort
   inside each range.  The hash splits a value that holds a third of all rows
   over as many ranges as it needs.
2. One pass over each sorted range (Arrow columns, no per-row Python) adds the
   number of rows before the value's run and the run's length, both counted
   inside the range, and ends with two rows that describe the range's edges.
3. The rows are written once.  The edges, two per range and so bounded by the
   shuffle partitions, are prefix-summed: what stands in earlier ranges, and
   the true start and length of a run that crosses ranges.
4. Reading the written rows back, one lookup by range number (one row per
   range, broadcast) completes the counts.  No join on values, no bounds array,
   and every kind of rank follows from the same counts.

There is no size switch: the plain-window form serves tests as their oracle.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from indexkit.session import written


def range_buckets(df: DataFrame) -> int:
    """Value ranges to rank in: as many as there are shuffle partitions."""
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def same(left: DataFrame, right: DataFrame, columns, prefix: str) -> Column:
    """Null-safe equality of ``columns`` with their ``prefix``-ed names."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & left[c].eqNullSafe(right[f"{prefix}{c}"])
    return cond


def _order(c: Column, descending: bool, nulls_first: bool) -> Column:
    if descending:
        return c.desc_nulls_first() if nulls_first else c.desc_nulls_last()
    return c.asc_nulls_first() if nulls_first else c.asc_nulls_last()


def rank_window(df: DataFrame, col: str, out: str = "rank", descending: bool = False,
                nulls_first: bool | None = None, partition_by=(), kind: str = "rank") -> DataFrame:
    """Plain window rank (kind: rank | percent_rank | dense_rank | row_number
    | average).  ``nulls_first`` defaults to Spark's own (first for ASC, last
    for DESC)."""
    if nulls_first is None:
        nulls_first = not descending
    w = Window.orderBy(_order(F.col(col), descending, nulls_first))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if kind == "average":
        tie = Window.partitionBy(*partition_by, col) if partition_by else Window.partitionBy(col)
        expr = F.rank().over(w) + (F.count(F.lit(1)).over(tie) - 1) / 2.0
    else:
        expr = getattr(F, kind)().over(w)
    return df.withColumn(out, expr if kind in ("average", "percent_rank") else expr.cast("bigint"))


_ADDED = ("_range", "_seg", "_run", "_less", "_ties", "_edge", "_rows", "_seg_rows")


def _changes(batch: pa.RecordBatch, before: pa.RecordBatch | None, columns: Sequence[str]) -> np.ndarray:
    """Per row: does any of ``columns`` differ from the row before it?  Null
    equals null and NaN equals NaN, as in Spark's grouping."""
    out = np.zeros(batch.num_rows, dtype=bool)
    out[0] = before is None
    for c in columns:
        col = batch.column(c)
        prev = pa.concat_arrays([before.column(c) if before is not None else col.slice(0, 1), col.slice(0, len(col) - 1)])
        same = pc.fill_null(pc.equal(col, prev), False)
        same = pc.or_(same, pc.and_(pc.is_null(col), pc.is_null(prev)))
        if pa.types.is_floating(col.type):
            same = pc.or_(same, pc.fill_null(pc.and_(pc.is_nan(col), pc.is_nan(prev)), False))
        out |= ~np.asarray(same.to_numpy(zero_copy_only=False), dtype=bool)
    return out


def _with_counts(batch: pa.RecordBatch, **counts) -> pa.RecordBatch:
    arrays = []
    for name in _ADDED:
        v = counts.get(name)
        arrays.append(pa.nulls(batch.num_rows, pa.int64()) if v is None else
                      pa.array(np.broadcast_to(np.asarray(v, dtype=np.int64), batch.num_rows), pa.int64()))
    return pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *_ADDED])


def _count_range(number: int, batches: Iterator[pa.RecordBatch], parts: Sequence[str], col: str,
                 weight: str | None = None) -> Iterator[pa.RecordBatch]:
    """Counts of one sorted range; with ``weight``, a row counts so many times.
    Only the rows of the last, still open run are held."""
    seg = run = -1
    n = 0
    seg_start = run_start = 0
    held: list[pa.RecordBatch] = []      # rows of the open run
    first = last = None
    first_seg_rows = first_ties = None

    def closed(length: int) -> Iterator[pa.RecordBatch]:
        for b in held:
            yield _with_counts(b, _range=number, _seg=seg, _run=run, _less=run_start - seg_start, _ties=length)
        held.clear()
    for batch in batches:
        if not batch.num_rows:
            continue
        new_seg = _changes(batch, last, parts) if parts else np.zeros(batch.num_rows, dtype=bool)
        new_seg[0] |= last is None
        new_run = _changes(batch, last, [col]) | new_seg
        each = np.ones(batch.num_rows, np.int64) if weight is None else \
            batch.column(weight).to_numpy(zero_copy_only=False).astype(np.int64)
        at = n + np.cumsum(each) - each          # rows before each row
        starts = np.flatnonzero(new_run)
        if len(starts):
            if first is None:
                first = batch.slice(0, 1)
            elif run == 0 and first_ties is None:
                first_ties = int(at[starts[0]]) - run_start
            yield from closed(int(at[starts[0]]) - run_start)
            if starts[0] and run >= 0:
                yield _with_counts(batch.slice(0, int(starts[0])), _range=number, _seg=seg, _run=run,
                                   _less=run_start - seg_start, _ties=int(at[starts[0]]) - run_start)
            segs = seg + np.cumsum(new_seg)
            runs = run + np.cumsum(new_run)
            seg_starts = np.maximum.accumulate(np.where(new_seg, at, seg_start))
            run_starts = np.maximum.accumulate(np.where(new_run, at, run_start))
            lo, hi = int(starts[0]), int(starts[-1])
            if hi > lo:
                lengths = np.diff(at[starts])
                if runs[lo] == 0 and first_ties is None:
                    first_ties = int(lengths[0])
                yield _with_counts(batch.slice(lo, hi - lo), _range=number, _seg=segs[lo:hi], _run=runs[lo:hi],
                                   _less=(run_starts - seg_starts)[lo:hi], _ties=np.repeat(lengths, np.diff(starts)))
            if first_seg_rows is None and segs[-1] > 0:
                first_seg_rows = int(at[np.flatnonzero(segs > 0)[0]])
            seg, run = int(segs[-1]), int(runs[-1])
            seg_start, run_start = int(seg_starts[-1]), int(run_starts[-1])
            held.append(batch.slice(hi))
        else:
            held.append(batch)
        n += int(each.sum())
        last = batch.slice(batch.num_rows - 1)
    if last is None:
        return
    yield from closed(n - run_start)
    yield _with_counts(first, _range=number, _seg=0, _run=0, _less=0, _ties=n - run_start if first_ties is None else first_ties,
                       _edge=0, _rows=n, _seg_rows=n if first_seg_rows is None else first_seg_rows)
    yield _with_counts(last, _range=number, _seg=seg, _run=run, _less=run_start - seg_start, _ties=n - run_start,
                       _edge=1, _rows=n, _seg_rows=n - seg_start)


def _key(values) -> tuple:
    return tuple("nan" if isinstance(v, float) and v != v else v for v in values)


def _lookup(edges: list, parts: Sequence[str], col: str) -> list[tuple]:
    """Per range: rows of its first partition key in earlier ranges, the true
    number of rows before its first run, and the true lengths of its first and
    last run with the last run's number."""
    before: dict[tuple, int] = {}
    runs: dict[tuple, list[int]] = {}
    carried: dict[int, int] = {}
    for e in sorted(edges, key=lambda e: (e["_range"], e["_edge"])):
        part = _key(e[c] for c in parts)
        run = (part, _key([e[col]]))
        if e["_edge"] == 0:
            carried[e["_range"]] = before.get(part, 0)
        if e["_edge"] == 0 or e["_run"] > 0:
            start = e["_less"] + (carried[e["_range"]] if e["_seg"] == 0 else 0)
            runs.setdefault(run, [start, 0])[1] += e["_ties"]
        if e["_edge"] == 0 or e["_seg"] > 0:
            before[part] = before.get(part, 0) + e["_seg_rows"]
    out: dict[int, list] = {}
    for e in edges:
        start, length = runs[(_key(e[c] for c in parts), _key([e[col]]))]
        row = out.setdefault(e["_range"], [e["_range"], carried[e["_range"]], 0, 0, 0, 0])
        if e["_edge"] == 0:
            row[2:4] = start, length
        else:
            row[4:6] = length, e["_run"]
    return [tuple(r) for r in out.values()]


def counted(df: DataFrame, col: str, partition_by: Sequence[str] = (), buckets: int | None = None,
            scan: bool = False, weight: str | None = None) -> DataFrame:
    """``df`` plus ``_before`` (rows of the partition with a smaller value, NULL
    the smallest), ``_ties`` (rows with the same value), ``_n`` and ``_nulls``
    (rows and NULLs of the partition).  With ``weight``, a whole number above
    zero, every row counts so many times.

    The range exchange reads its input twice (once to sample it), so ``df`` is
    written first unless it is a plain ``scan``.  Rows that are equal in all
    columns stay together in one range."""
    parts, spark = list(partition_by), df.sparkSession
    if not scan:
        df = written(df, "rank-input")
    names = df.columns
    kind = df.schema[col].dataType.typeName()
    order = [F.col(c).asc_nulls_first() for c in (*parts, col)]
    tie = F.xxhash64(*[F.col(c) for c in names])
    schema = StructType(df.schema.fields + [StructField(c, LongType()) for c in _ADDED])
    schema = StructType([StructField(f.name, f.dataType, True) for f in schema])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        return _count_range(TaskContext.get().partitionId(), batches, parts, col, weight)
    if kind in ("array", "map", "struct"):
        raise ValueError(f"{col} has no simple order")
    ranges = buckets or range_buckets(df)
    made = written(df.repartitionByRange(ranges, *order, tie).sortWithinPartitions(*order).mapInArrow(run, schema), "ranked")
    # two edge rows per range, so at most twice the shuffle partitions
    edges = made.filter("_edge IS NOT NULL").select(*parts, col, *[c for c in _ADDED if c not in (*parts, col)]).collect()
    rows = made.filter("_edge IS NULL").drop("_edge", "_rows", "_seg_rows")
    table = spark.createDataFrame(_lookup(edges, parts, col),
                                  "_at long, _carried long, _first_less long, _first_ties long, _last_ties long, _last_run long")
    rows = rows.join(F.broadcast(table), F.col("_range") == F.col("_at"))
    less = (F.when(F.col("_run") == 0, F.col("_first_less"))
            .when(F.col("_seg") == 0, F.col("_less") + F.col("_carried")).otherwise(F.col("_less")))
    ties = (F.when(F.col("_run") == 0, F.col("_first_ties"))
            .when(F.col("_run") == F.col("_last_run"), F.col("_last_ties")).otherwise(F.col("_ties")))
    rows = rows.select(*names, less.alias("_before"), ties.alias("_ties"))
    each = F.lit(1).cast("bigint") if weight is None else F.col(weight)
    if parts:
        totals = made.filter("_edge IS NULL").groupBy(*[F.col(p).alias(f"_t_{p}") for p in parts]).agg(
            F.sum(each).alias("_n"), F.sum(F.when(F.col(col).isNull(), each).otherwise(F.lit(0))).alias("_nulls"))
        return rows.join(totals, same(rows, totals, parts, "_t_")).drop(*[f"_t_{p}" for p in parts])
    n = sum(e["_rows"] for e in edges if e["_edge"] == 0)
    nulls = [e for e in edges if e[col] is None and (e["_edge"] == 0 or e["_run"] > 0)]
    return rows.withColumns({"_n": F.lit(n).cast("bigint"), "_nulls": F.lit(sum(e["_ties"] for e in nulls)).cast("bigint")})


def rank_expr(col: str, kind: str = "rank", descending: bool = False, nulls_first: bool | None = None) -> Column:
    """One kind of rank (rank | percent_rank | average) from the columns of ``counted``."""
    if nulls_first is None:
        nulls_first = not descending
    null = F.col(col).isNull()
    present = F.col("_n") - F.col("_nulls")
    less = F.col("_before") - F.col("_nulls")          # present values before this one, ascending
    before = present - less - F.col("_ties") if descending else less
    if nulls_first:
        before = before + F.col("_nulls")
    rank = F.when(null, F.lit(0).cast("bigint") if nulls_first else present).otherwise(before) + 1
    if kind == "rank":
        return rank.cast("bigint")
    if kind == "percent_rank":
        return F.when(F.col("_n") <= 1, F.lit(0.0)).otherwise((rank - 1).cast("double") / (F.col("_n") - 1).cast("double"))
    if kind == "average":
        return rank.cast("double") + (F.col("_ties") - 1).cast("double") / 2.0
    if kind == "average_share":
        return (rank.cast("double") + (F.col("_ties") - 1).cast("double") / 2.0) / F.col("_n")
    raise ValueError(f"unknown rank kind {kind!r}")


def rank_many(df: DataFrame, col: str, out: dict[str, dict], partition_by: Sequence[str] = (),
              buckets: int | None = None, scan: bool = False) -> DataFrame:
    """Several ranks of one column from one range exchange: output name to the
    arguments of ``rank_expr``."""
    c = counted(df, col, partition_by, buckets, scan)
    return c.select(*[x for x in df.columns if x not in out], *[rank_expr(col, **kw).alias(name) for name, kw in out.items()])


def rank_scaled(df: DataFrame, col: str, out: str = "rank", descending: bool = False,
                nulls_first: bool | None = None, kind: str = "rank",
                buckets: int | None = None, partition_by=(), scan: bool = False) -> DataFrame:
    """Global (or per ``partition_by``) rank / percent_rank / average rank of
    ``col`` without a single-partition window.  Equals the plain window on
    every row."""
    return rank_many(df, col, {out: {"kind": kind, "descending": descending, "nulls_first": nulls_first}},
                     partition_by, buckets, scan)


def percent_rank_scaled(df: DataFrame, col: str, out: str = "percent_rank",
                        buckets: int | None = None, scan: bool = False) -> DataFrame:
    return rank_scaled(df, col, out, kind="percent_rank", buckets=buckets, scan=scan)


def average_rank_scaled(df: DataFrame, col: str, out: str = "avg_rank",
                        buckets: int | None = None, scan: bool = False) -> DataFrame:
    return rank_scaled(df, col, out, kind="average", buckets=buckets, scan=scan)


def top_n(df: DataFrame, n: int, order, tie_break=()) -> DataFrame:
    """ORDER BY ... LIMIT n with a total order (TakeOrderedAndProject: each
    task keeps its own top n, the driver merges n·tasks rows)."""
    cols = list(order) + [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in tie_break]
    return df.orderBy(*cols).limit(n)
