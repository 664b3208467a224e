"""Main text of web pages by wrappers inferred per host.

Method: every page's token stream is aligned with its host's wrapper, a
union-free regular expression (``wrappers``), which grows optional and repeated
groups and text slots until all pages fit.  Tasks infer one partial wrapper per
host from their own pages, so a host with a third of all pages sends one small
row per task; partial wrappers merge in a tree of bounded fan-in.  The finished
wrapper names the region of the main text, and a second pass over the pages
reads it from there.  Only wrappers are joined to pages; Spark broadcasts them
if the written table is small enough and splits a hot host's pages otherwise.

Defined results: null or empty html, or a page without main text, gives an
empty text; a page without url belongs to the host named by the empty string; a
page that has none of its host's regions is read by its own wrapper; a block of
any length is whole; repeated rows are extracted alike; an empty table gives an
empty result.  Other columns pass through; ``text``, ``n_chars`` are replaced.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexkit.llm import wrappers
from indexkit.llm.common import mapped_rows, stored
from indexkit.llm.html_tokens import tree
from indexkit.llm.url_rules import url_host

#: Hosts whose partial wrappers a task holds at a time.
HOSTS = 2_000
#: Partial wrappers merged at a time.
FAN_IN = 64
_PART = "host string, part long, wrapper string"


def page_tree(page: str):
    return tree(page, wrappers.dropped_inline)


def partial_wrappers(pages: DataFrame, html: str, host: Column) -> DataFrame:
    """One wrapper per host and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: dict[str, list] = {}

        def done() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held)), pa.array([part] * len(held), pa.int64()),
                 pa.array([json.dumps(w) for w in held.values()])], names=["host", "part", "wrapper"])
            held.clear()
            return out
        for batch in batches:
            hosts, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                name = hosts[i].as_py()
                page = wrappers.pattern(page_tree(texts[i].as_py()))
                held[name] = wrappers.joined(held[name], page) if name in held else page
                if len(held) >= HOSTS:
                    yield done()
        if held:
            yield done()
    return pages.select(host.alias("host"), F.col(html).alias("html")).filter("html <> ''").mapInArrow(run, _PART)


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values(["part", "wrapper"])
    whole = None
    for w in map(json.loads, group["wrapper"]):
        whole = w if whole is None else wrappers.joined(whole, w)
    return pd.DataFrame({"host": [group["host"].iloc[0]], "part": [group["part"].iloc[0]], "wrapper": [json.dumps(whole)]})


def infer(pages: DataFrame, html: str, host: Column) -> DataFrame:
    """One wrapper per host: ``host``, ``wrapper`` (JSON)."""
    made = stored(partial_wrappers(pages, html, host), "wrappers")
    most = made.agg(F.max("part")).first()[0] or 0
    group = F.col("part")
    while True:
        group = F.floor(group / FAN_IN)
        made = made.withColumn("part", group).groupBy("host", "part").applyInPandas(_merge, _PART)
        most //= FAN_IN
        if not most:
            return made.select("host", "wrapper")
        group = F.col("part")


def read_regions(wrappers_: DataFrame) -> DataFrame:
    """Region of the main text per host: ``host``, ``regions`` (JSON)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"host": b["host"],
                                "regions": [json.dumps(wrappers.regions(json.loads(w))) for w in b["wrapper"]]})
    return wrappers_.mapInPandas(run, "host string, regions string")


@lru_cache(maxsize=4096)
def _regions(text: str) -> dict:
    return json.loads(text)


def text_of(page: str | None, where: str | None) -> str:
    """Main text of one page, given its host's regions."""
    if not page:
        return ""
    root = page_tree(page)
    text = wrappers.main_text(root, _regions(where)) if where else None
    return wrappers.main_text(root, wrappers.regions(wrappers.pattern(root))) or "" if text is None else text


def extract(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` without the html, with ``text`` and ``n_chars``."""
    host = url_host(F.col(url))
    # a wrapper's regions are small, so they are written once: their size is known when the join is planned
    found = stored(read_regions(infer(pages, html, host)), "regions") \
        .select(F.col("host").alias("__host"), F.col("regions").alias("__regions"))
    names = [c for c in pages.columns if c not in ("text", "n_chars") or c == html]
    rows = pages.select(*names, host.alias("__host")).join(found, "__host", "left").drop("__host")

    def row(page: str | None, where: str | None) -> tuple:
        text = text_of(page, where)
        return text, len(text)
    return mapped_rows(rows, [html, "__regions"], [html, "__regions"], [("text", "string"), ("n_chars", "long")], row,
                       lambda r: r[1] + 100)
