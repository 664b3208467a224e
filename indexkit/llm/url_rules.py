"""URL filter: listed host/path rules, and association rules mined from labels.

Method: every url becomes a small set of tokens, one per slot (scheme, top
level, domain, first and last remaining host label, first path segment, file
extension, first query key, fragment).  Spark's FP-growth mines token sets that
go with the label ``block``; rules are pruned by support, by confidence and by
dropping every rule that a more general one covers.  An inverted index from a
rule's rarest token to its token set judges a url by the few rules that share
a token with it.  A listed rule, where one fits, takes precedence.

Sizes: a url has at most ``SLOTS`` tokens, so there are at most
2^SLOTS / MIN_SUPPORT frequent sets whatever the data; only rules of that
bounded set are collected and sent to the tasks.

Defined results: a null url, or one without ``://``, has empty host and path,
no tokens and the verdict ``allow``; with no labelled url nothing is mined;
repeated pages are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The listed rules: verdict, host, path.  Fixed values.
LISTED = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
SLOTS = 9
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.6
#: Least number of labelled urls behind a rule, however few are labelled.
MIN_ROWS = 25
_BLOCK = "label=block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _SPLIT, 2)


def listed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]] = LISTED) -> Column:
    """Struct (rule, verdict) of the longest listed rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        found = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Array of at most SLOTS distinct tokens, each named by its slot."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    def slot(name: str, value: Column) -> Column:
        return F.when(value != "", F.concat(F.lit(name + "="), value))
    rest = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(.*)$", 1)
    tokens = F.array(
        slot("scheme", F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)),
        slot("top", F.element_at(labels, -1)),
        slot("domain", F.when(n >= 2, F.concat_ws(".", F.element_at(labels, -2), F.element_at(labels, -1)))),
        slot("name", F.when(n >= 3, F.element_at(labels, -3))),
        slot("sub", F.when(n >= 4, F.element_at(labels, 1))),
        slot("seg", F.regexp_replace(F.regexp_extract(path, r"(?s)^/([^/]*)", 1), r"[0-9]+", "#")),
        slot("ext", F.regexp_extract(path, r"\.([A-Za-z0-9]{1,5})$", 1)),
        slot("query", F.regexp_extract(rest, r"^\?([^=&#]*)", 1)),
        slot("frag", F.when(rest.contains("#"), F.lit("yes"))),
    )
    return F.when(host != "", F.filter(tokens, lambda x: x.isNotNull())).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> list[dict]:
    """Block rules from (tokens, blocked) rows, most general first."""
    sets = labelled.filter(F.size("tokens") > 0).select(F.when(
        F.col("blocked"), F.concat("tokens", F.array(F.lit(_BLOCK)))).otherwise(F.col("tokens")).alias("items"))
    n = sets.count()
    if not n:
        return []
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, MIN_ROWS / n)),
                     minConfidence=min_confidence).fit(sets)
    rules = model.associationRules.filter((F.size("consequent") == 1) & (F.col("consequent")[0] == _BLOCK))
    # at most 2^SLOTS / min_support rows, by construction of the tokens
    found = sorted(((frozenset(r["antecedent"]), r["confidence"], r["support"]) for r in rules.collect()),
                   key=lambda r: (len(r[0]), sorted(r[0])))
    kept: list[dict] = []
    by_token: dict[str, list[frozenset]] = {}
    for tokens, confidence, support in found:
        if any(general <= tokens for t in tokens for general in by_token.get(t, ())):
            continue
        for t in tokens:
            by_token.setdefault(t, []).append(tokens)
        kept.append({"tokens": tokens, "confidence": confidence, "support": support})
    return kept


def inverted_index(rules: list[dict]) -> dict[str, list[tuple[frozenset, float]]]:
    """Each rule under the token that fewest rules share."""
    uses = Counter(t for r in rules for t in r["tokens"])
    index: dict[str, list[tuple[frozenset, float]]] = {}
    for r in rules:
        anchor = min(r["tokens"], key=lambda t: (uses[t], t))
        index.setdefault(anchor, []).append((r["tokens"], r["confidence"]))
    return index


def judge(pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict and ``confidence`` (of the best mined
    block rule that fits; null if none).  A page is labelled by the label row
    of the same id: block if it is of low quality or toxic."""
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), "url") \
        .withColumn("host", url_host(F.col("url"))).withColumn("path", url_path(F.col("url"))) \
        .withColumn("tokens", url_tokens(F.col("url"), F.col("host"), F.col("path")))
    known = labels.select(F.col("doc_id").cast("long").alias("page_id"),
                          ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("blocked")).filter("blocked IS NOT NULL")
    index = inverted_index(mine(urls.join(known, "page_id").select("tokens", "blocked"), min_support, min_confidence))

    @F.pandas_udf("double")
    def block_confidence(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for tokens in batches:
            yield pd.Series([max((c for t in ts for need, c in index.get(t, ()) if need.issubset(ts)), default=None)
                             for ts in tokens], dtype="float64")

    listed = listed_rule(F.col("host"), F.col("path"))
    return urls.withColumn("listed", listed).withColumn("confidence", block_confidence("tokens")).select(
        "page_id", "host", "path", F.col("listed.rule").alias("rule"),
        F.coalesce(F.col("listed.verdict"), F.when(F.col("confidence").isNotNull(), "block").otherwise("allow"))
        .alias("verdict"), "confidence")
