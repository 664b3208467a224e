"""Quality classifier: interpolated modified Kneser-Ney over character n-grams.

Method: trusted documents (labelled good and not toxic) are counted whole.
N-grams of ``ORDER`` symbols are summed in Spark, lower orders are continuation
counts of the next higher one, discounts follow from the counts of counts, and
joins that are sharded by context and by suffix interpolate each order with the
one below.  Every character is told apart: of the ``SYMBOLS`` symbols one marks
borders, ``LEADS`` begin the codes of rarer characters and the others are the
commonest characters of the trusted text.  A rarer character is a lead and one
digit, two digits or, beyond those and if the trusted text has not shown it,
the digits of its code point (see ``Coder``); digits are symbols too and are
counted and predicted like all others.  So the joined table has at most
SYMBOLS^ORDER rows at any data size and any number of characters; that proven
bound lets the last join, of document n-grams with their probabilities, run
inside the tasks that read the documents, without shuffling a text.

Where a rarer character stands among the last ORDER - 1 ones, or is itself being
spelt, ORDER symbols are fewer than ORDER characters.  Those places have further
levels above the joined table: the contexts are the last ORDER - 1, ..., 1 whole
characters with what is spelt of the next one, as far as they reach beyond the
table's context (see ``Coder.wide``).  So every text, whatever its script, is
predicted from ORDER - 1 characters.  These levels are sparse and grow with the
text; up to ``WIDE_ROWS`` of their rows go to the tasks, more are joined in Spark,
sharded by context, with the documents' own wide n-grams.

A document is accepted when its perplexity lies within its language's quantiles
of the trusted documents' perplexities, each under the model of the other
fold (widened by ``SLACK``); a language
without trusted documents is judged by the quantiles over all of them.

Defined results: a null or empty text has the perplexity of its end symbol
alone; with no trusted document every character is the digits of its code
point under the uniform model and every document is accepted; perplexities and
``n_symbols`` count characters and the end, however many symbols code them; a null language is a language of its own; repeated
rows get equal results; an empty table gives an empty result; extra columns
pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexkit.llm.common import crc_mod, let_go, may_match, stored, text_slices, with_columns_from_text

ORDER = 4
SYMBOLS = 48
LOW, HIGH, SLACK, REACH = 0.001, 0.999, 0.05, 4.0
#: Folds of trusted documents for the gate.
FOLDS = 2
#: Languages whose quantiles are broadcast; more are joined by a shuffle.
LANGUAGES = 10_000
#: Characters coded at a time; each is at most five symbols.
TAKE_CHARS = 200_000
_BORDER = 0
#: Stands for a border among code points.
_EDGE = 0x110000
#: Symbols that begin the code of a rarer character: with one digit, with two,
#: with the digits of the code point.
LEADS = 3
#: Rows of the wide levels, of all models, that tasks hold; more are joined.
WIDE_ROWS = 4_000_000
#: Bits of a character in a wide context.
_BITS = 21
#: Wide n-grams that a counting task adds up before it hands them on.
_HELD = 2_000_000


def ranked(symbols: int = SYMBOLS) -> int:
    """How many characters have codes by rank (the others: by code point)."""
    digits = symbols - 1
    return symbols - 1 - LEADS + digits + digits ** 2


def alphabet(trusted: DataFrame, symbols: int = SYMBOLS) -> list[int]:
    """Code points of the commonest characters that get codes by rank; all
    others are coded by code point, so none is left out."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for at in range(0, len(text or ""), TAKE_CHARS):
                    part = np.frombuffer(text[at:at + TAKE_CHARS].encode("utf-32-le"), dtype=np.uint32)
                    low = part[part < 0x800]
                    total[:0x800] += np.bincount(low, minlength=0x800)
                    if len(low) < len(part):
                        np.add.at(total, part[part >= 0x800], np.int64(1))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["cp", "n"])
    rows = trusted.select("text").mapInArrow(count, "cp long, n long").groupBy("cp").agg(F.sum("n").alias("n")) \
        .orderBy(F.desc("n"), "cp").limit(ranked(symbols)).collect()
    return [r["cp"] for r in rows]


class Coder:
    """Texts to n-gram numbers: base-``symbols`` numbers whose last digit is the
    predicted symbol.  ``chars`` by rank: the first have a symbol each, the next
    a lead and one digit, the next a lead and two digits; every other code point
    is the last lead and its own digits.  No two characters share a code and no
    code begins another."""

    def __init__(self, chars: list[int], symbols: int = SYMBOLS, order: int = ORDER):
        self.chars, self.symbols, self.order = chars, symbols, order
        base, single = symbols - 1, symbols - 1 - LEADS
        longest = 1
        while base ** longest < 0x110000:
            longest += 1
        #: symbols of the code that begins with a symbol
        self.length = np.ones(symbols, dtype=np.int64)
        self.length[1:1 + LEADS] = [2, 3, 1 + longest]
        self.code = np.full(_EDGE + 1, LEADS, dtype=np.uint8)
        self.code[_EDGE] = _BORDER
        self.digits = np.zeros((longest, 0x110000), dtype=np.uint8)
        self._spell(np.arange(0x110000), np.arange(0x110000), longest)
        known = np.asarray(chars, dtype=np.int64)
        self.code[known[:single]] = np.arange(1 + LEADS, 1 + LEADS + len(known[:single]))
        at = single
        for lead in range(1, LEADS):
            part = known[at:at + base ** lead]
            self.code[part] = lead
            self._spell(part, np.arange(len(part)), lead)
            at += base ** lead

    def _spell(self, points: np.ndarray, numbers: np.ndarray, places: int) -> None:
        for k in range(places):
            self.digits[k, points] = 1 + numbers // (self.symbols - 1) ** (places - 1 - k) % (self.symbols - 1)

    def coded(self, text: str) -> np.ndarray:
        """Symbols of a text, without its end."""
        return self._coded(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32))

    def _coded(self, points: np.ndarray) -> np.ndarray:
        first = self.code[points]
        rare = np.flatnonzero(first <= LEADS)
        if not len(rare):
            return first.astype(np.int64)
        length = self.length[first]
        start = np.cumsum(length) - length
        out = np.empty(int(length.sum()), dtype=np.int64)
        out[start] = first
        length, start, points = length[rare], start[rare], points[rare]
        for k in range(int(length.max()) - 1):
            more = length > k + 1
            out[start[more] + k + 1] = self.digits[k, points[more]]
        return out

    def grams(self, text: str) -> Iterator[np.ndarray]:
        """N-gram numbers of a whole text and its end, piece by piece."""
        return (grams for grams, _ in self.pieces(text, False))

    def blocks(self, texts: list[str], wide: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, tuple[np.ndarray, ...] | None]]:
        """(first, starts, grams, wide n-grams) of texts and their ends, many short
        texts at a time: text first + i has the n-gram numbers from starts[i] on;
        a long text comes in pieces."""
        lo = 0
        while lo < len(texts):
            hi, size = lo + 1, len(texts[lo])
            while hi < len(texts) and size + len(texts[hi]) + self.order * (hi - lo) <= TAKE_CHARS:
                size += len(texts[hi])
                hi += 1
            if size > TAKE_CHARS:
                yield from ((lo, np.zeros(1, dtype=np.int64), *piece) for piece in self.pieces(texts[lo], wide))
            else:
                yield lo, *self._block(texts[lo:hi], wide)
            lo = hi

    def _block(self, texts: list[str], wide: bool) -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...] | None]:
        reach = self.order - 1
        ends = np.cumsum(list(map(len, texts)))
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype=np.uint32)
        # every text has its end and then the borders before the next
        points = np.insert(points, np.repeat(ends, self.order), _EDGE)
        codes = np.concatenate([np.full(reach, _BORDER, dtype=np.int64), self._coded(points)])
        length = self.length[self.code[points]]
        ends = ends + self.order * np.arange(len(texts))
        last = (np.cumsum(length) - length)[ends]  # the place of each text's end symbol
        n = len(codes) - reach
        grams = reduce(lambda g, k: g * self.symbols + codes[k:k + n], range(self.order), np.zeros(n, dtype=np.int64))
        used = np.ones(n, dtype=bool)
        used[(last[:, None] + np.arange(1, self.order)).ravel()] = False
        starts = np.concatenate([[0], last[:-1] + 1 - reach * np.arange(len(texts) - 1)])
        found = None
        if wide and length.max() > 1:
            between = np.zeros(len(points), dtype=bool)
            between[(ends[:, None] + np.arange(1, self.order)).ravel()] = True
            values = np.where(points == _EDGE, 0, points.astype(np.int64) + 1)
            at, *rest = self.wide(np.concatenate([np.zeros(reach, dtype=np.int64), values]),
                                  np.concatenate([np.ones(reach, dtype=np.int64), length]), codes[reach:], between)
            found = (at - np.cumsum(~used)[at], *rest)
        return starts, grams[used], found

    def pieces(self, text: str, wide: bool = True) -> Iterator[tuple[np.ndarray, tuple[np.ndarray, ...] | None]]:
        """N-gram numbers of a whole text and its end, piece by piece, each with
        its wide n-grams (none: a piece of characters of one symbol)."""
        held = np.full(self.order - 1, _BORDER, dtype=np.int64)
        values, lengths = np.zeros(self.order - 1, dtype=np.int64), np.ones(self.order - 1, dtype=np.int64)
        for at in range(0, len(text) + 1, TAKE_CHARS):
            points = np.frombuffer(text[at:at + TAKE_CHARS].encode("utf-32-le"), dtype=np.uint32)
            end = [_BORDER] if at + TAKE_CHARS > len(text) else []
            codes = np.concatenate([held, self._coded(points), np.array(end, dtype=np.int64)])
            n = len(codes) - self.order + 1
            found = None
            if wide:
                values = np.concatenate([values, points.astype(np.int64) + 1, np.array(end, dtype=np.int64)])
                lengths = np.concatenate([lengths, self.length[self.code[points]], np.ones(len(end), dtype=np.int64)])
                if lengths.max() > 1:
                    found = self.wide(values, lengths, codes[self.order - 1:])
                values, lengths = values[len(values) - self.order + 1:], lengths[len(lengths) - self.order + 1:]
            yield reduce(lambda g, k: g * self.symbols + codes[k:k + n], range(self.order), np.zeros(n, dtype=np.int64)), found
            held = codes[len(codes) - self.order + 1:]

    def wide(self, values: np.ndarray, lengths: np.ndarray, codes: np.ndarray, skip: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
        """(place, ctx, part, low) of the symbols whose ``order`` - 1 characters
        before, with what is spelt of their own, are more than ``order`` - 1
        symbols.  ``values`` (code point + 1, borders 0) and ``lengths`` begin
        with the ``order`` - 1 characters before the first of ``codes``.  ``ctx``
        holds the characters before, ``part`` the symbols of the own one up to
        the predicted one; ``low`` is the least number of characters before that
        reach beyond ``order`` - 1 symbols.  Characters of ``skip`` are not predicted."""
        reach = self.order - 1
        own = lengths[reach:]
        before = np.cumsum([lengths[reach - j:len(lengths) - j] for j in range(1, reach + 1)], axis=0)
        at = (before[-1] > reach) | (own > 1)
        at = np.flatnonzero(at if skip is None else at & ~skip)
        ctx = reduce(lambda c, j: c << _BITS | values[reach + at - j], range(reach, 0, -1), np.zeros(len(at), dtype=np.int64))
        start = (np.cumsum(own) - own)[at]
        own, before, part = own[at], before[:, at], np.zeros(len(at), dtype=np.int64)
        out = []
        for k in range(int(own.max()) if len(own) else 0):
            if k:
                more = own > k
                own, before, ctx, start, part = own[more], before[:, more], ctx[more], start[more], part[more]
            part = part * self.symbols + codes[start + k]
            beyond = before + k > reach
            keep = beyond[-1]
            out.append((start[keep] + k, ctx[keep], part[keep], reach + 1 - beyond[:, keep].sum(axis=0)))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, dtype=np.int64),) * 4


def gram_counts(trusted: DataFrame, coder: Coder) -> DataFrame:
    """(gram, n) over all trusted texts; each task adds up its own first."""
    chars, symbols, order = coder.chars, coder.symbols, coder.order

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Coder(chars, symbols, order)
        total = np.zeros(symbols ** order, dtype=np.int32)
        for batch in batches:
            for _, _, grams, _ in own.blocks([t or "" for t in batch.column(0).to_pylist()], False):
                np.add.at(total, grams, np.int32(1))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["gram", "n"])
        del own, total, used
        let_go()
    return trusted.select("text").mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def wide_counts(trusted: DataFrame, coder: Coder) -> DataFrame:
    """(ctx, part, low, n) of the wide n-grams of all trusted texts; each task
    adds up its own, some at a time."""
    chars, symbols, order = coder.chars, coder.symbols, coder.order
    names = ["ctx", "part", "low", "n"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Coder(chars, symbols, order)
        held: list[pa.Table] = []
        rows = 0

        def summed() -> pa.Table:
            return pa.concat_tables(held).group_by(names[:3]).aggregate([("n", "sum")]).rename_columns(names)
        for batch in batches:
            for _, _, _, found in own.blocks([t or "" for t in batch.column(0).to_pylist()]):
                if found is not None:
                    held.append(pa.table([*found[1:], np.ones(len(found[0]), dtype=np.int64)], names=names))
                    rows += len(found[0])
                if rows > _HELD:
                    held = [summed()]
                    rows = held[0].num_rows
                    if rows > _HELD // 2:
                        yield from held[0].to_batches(1 << 16)
                        held, rows = [], 0
        if held:
            yield from summed().to_batches(1 << 16)
        del own, held
        let_go()
    return trusted.select("text").mapInArrow(count, "ctx long, part long, low long, n long") \
        .groupBy(*names[:3]).agg(F.sum("n").alias("n"))


def discounts(seen: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of one order from its counts of counts."""
    n1, n2, n3, n4 = (seen.get(i, 0) for i in range(1, 5))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    d = [k - (k + 1) * y * nxt / now if now else k * 0.5 for k, (now, nxt) in enumerate([(n1, n2), (n2, n3), (n3, n4)], 1)]
    return tuple(min(max(x, 0.0), float(k)) for k, x in enumerate(d, 1))


def _off(level: DataFrame) -> Column:
    """What the discounts of a level take from a row's count ``n``, for all models."""
    seen: dict[int, dict[int, int]] = {}
    for r in level.filter("n <= 4").groupBy("model", "n").agg(F.count("*").alias("times")).collect():
        seen.setdefault(r["model"], {})[r["n"]] = r["times"]
    n, off = F.col("n"), F.lit(0.5)
    for m, times in seen.items():
        d1, d2, d3 = discounts(times)
        off = F.when(F.col("model") == m, F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)).otherwise(off)
    return off


def _alpha() -> Column:
    return F.greatest(F.col("n") - F.col("off"), F.lit(0.0)) / F.col("total")


def interpolated(counts: DataFrame, symbols: int = SYMBOLS, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """(model, k, gram, p) of every seen n-gram of every order and (model, k,
    ctx, gamma) of every seen context, from (model, gram, n).  All models go
    through the same joins; every level is written, so plans stay short.
    Tables have at most symbols^order rows a model."""
    level = {order: stored(counts, "kn-counts")}
    for k in range(order - 1, 0, -1):
        level[k] = stored(level[k + 1].groupBy("model", (F.col("gram") % symbols ** k).alias("gram"))
                          .agg(F.count("*").alias("n")), "kn-counts")
    probs, gammas = [], []
    below = None
    for k in range(1, order + 1):
        rows = level[k].withColumn("ctx", F.expr(f"gram DIV {symbols}")).withColumn("off", _off(level[k]))
        ctx = stored(rows.groupBy("model", "ctx").agg(F.sum("n").alias("total"), F.sum("off").alias("cut"))
                     .withColumn("gamma", F.col("cut") / F.col("total")), "kn-contexts")
        rows = rows.join(ctx, ["model", "ctx"]).withColumn("alpha", _alpha())
        if below is None:
            p = rows.select("model", "gram", (F.col("alpha") + F.col("gamma") / symbols).alias("p"))
        else:
            lower = below.select("model", F.col("gram").alias("suffix"), F.col("p").alias("lower_p"))
            p = rows.withColumn("suffix", F.col("gram") % symbols ** (k - 1)).join(lower, ["model", "suffix"]) \
                .select("model", "gram", (F.col("alpha") + F.col("gamma") * F.col("lower_p")).alias("p"))
        below = stored(p, "kn-probs")
        probs.append(below.withColumn("k", F.lit(k)))
        gammas.append(ctx.select("model", "ctx", "gamma").withColumn("k", F.lit(k)))
    return reduce(DataFrame.unionByName, probs), reduce(DataFrame.unionByName, gammas)


def _last(chars: int) -> Column:
    """The last ``chars`` characters of a wide context."""
    return F.col("ctx").bitwiseAND(F.lit((1 << _BITS * chars) - 1))


def wide_levels(counts: DataFrame, symbols: int = SYMBOLS, order: int = ORDER) -> tuple[DataFrame, DataFrame]:
    """(model, j, ctx, part, a, g) of every seen wide n-gram after j characters,
    whose probability is a + g * its symbol's in the joined table, and (model, j,
    ctx, spelt, gamma) of every seen context, from (model, ctx, part, low, n).
    Counts below the highest j are continuation counts, as in the joined table."""
    level = {order - 1: stored(counts, "kn-wide-counts")}
    for j in range(order - 2, 0, -1):
        level[j] = stored(level[j + 1].filter(F.col("low") <= j).groupBy("model", _last(j).alias("ctx"), "part", "low")
                          .agg(F.count("*").alias("n")), "kn-wide-counts")
    grams, contexts = [], []
    below = None
    for j in range(1, order):
        rows = level[j].withColumn("spelt", F.expr(f"part DIV {symbols}")).withColumn("off", _off(level[j]))
        ctx = stored(rows.groupBy("model", "ctx", "spelt").agg(F.sum("n").alias("total"), F.sum("off").alias("cut"))
                     .withColumn("gamma", F.col("cut") / F.col("total")), "kn-wide-contexts")
        rows = rows.join(ctx, ["model", "ctx", "spelt"]).withColumn("a", _alpha()).withColumn("g", F.col("gamma"))
        if below is not None:
            lower = below.select("model", F.col("ctx").alias("suffix"), "part", F.col("a").alias("la"), F.col("g").alias("lg"))
            # a row whose context reaches no further than the table's with fewer characters has none below
            rows = rows.withColumn("suffix", _last(j - 1)).join(lower, ["model", "suffix", "part"], "left") \
                .withColumn("a", F.col("a") + F.col("gamma") * F.coalesce("la", F.lit(0.0))) \
                .withColumn("g", F.col("gamma") * F.coalesce("lg", F.lit(1.0)))
        below = stored(rows.select("model", "ctx", "part", "a", "g"), "kn-wide")
        grams.append(below.withColumn("j", F.lit(j)))
        contexts.append(ctx.select("model", "ctx", "spelt", "gamma").withColumn("j", F.lit(j)))
    return reduce(DataFrame.unionByName, grams), reduce(DataFrame.unionByName, contexts)


class Wide:
    """The wide levels of one model as sorted arrays."""

    def __init__(self, grams: pd.DataFrame, contexts: pd.DataFrame, symbols: int = SYMBOLS):
        self.symbols, self.levels = symbols, {}
        for j, rows in contexts.groupby("j"):
            ctx = np.unique(rows["ctx"].to_numpy(np.int64))
            seen = grams[grams["j"] == j]
            self.levels[int(j)] = (ctx, *self._by_key(ctx, seen, "part", "a", "g"), *self._by_key(ctx, rows, "spelt", "gamma"))

    @staticmethod
    def _by_key(ctx: np.ndarray, rows: pd.DataFrame, last: str, *values: str) -> list[np.ndarray]:
        keys = np.searchsorted(ctx, rows["ctx"].to_numpy(np.int64)) << 32 | rows[last].to_numpy(np.int64)
        order = np.argsort(keys)
        return [keys[order], *(rows[v].to_numpy(np.float64)[order] for v in values)]

    def probabilities(self, ctx: np.ndarray, part: np.ndarray, low: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Of wide n-grams, from their symbols' probabilities in the joined table."""
        out, left, scale = base.copy(), np.arange(len(ctx)), np.ones(len(ctx))
        for j in sorted(self.levels, reverse=True):
            known, grams, a, g, contexts, gamma = self.levels[j]
            left = left[low[left] <= j]
            c = ctx[left] & (1 << _BITS * j) - 1
            at = np.searchsorted(known, c)
            there = at < len(known)
            there[there] = known[at[there]] == c[there]
            at, hit = at << 32, np.zeros(len(left), dtype=bool)
            place = np.searchsorted(grams, at | part[left])
            hit[there] = place[there] < len(grams)
            hit[hit] = grams[place[hit]] == (at | part[left])[hit]
            i = left[hit]
            out[i] = scale[i] * (a[place[hit]] + g[place[hit]] * base[i])
            left, at, there = left[~hit], at[~hit], there[~hit]
            key = at | part[left] // self.symbols
            place = np.searchsorted(contexts, key)
            there &= place < len(contexts)
            there[there] = contexts[place[there]] == key[there]
            scale[left[there]] *= gamma[place[there]]
            out[left] = scale[left] * base[left]
        return out


class Model:
    """Log10 probability of every possible n-gram: the seen ones and, through
    the contexts' left-over mass, all others.  ``wide`` are the levels of wider
    contexts, if tasks hold them; ``shards`` are those levels as tables, if not."""

    def __init__(self, chars: list[int], probs: pd.DataFrame, gammas: pd.DataFrame, symbols: int = SYMBOLS, order: int = ORDER,
                 wide: Wide | None = None):
        self.parts = (chars, probs, gammas, symbols, order, wide)
        self.wide, self.shards = wide, None
        self._log: np.ndarray | None = None
        self.coder: Coder | None = None

    def __getstate__(self) -> tuple:
        return self.parts

    def __setstate__(self, parts: tuple) -> None:
        self.__init__(*parts)

    def log10(self) -> np.ndarray:
        if self._log is None:
            chars, probs, gammas, a, order, _ = self.parts
            self.coder = Coder(chars, a, order)
            p = np.full(1, 1.0 / a, dtype=np.float32)
            for k in range(1, order + 1):
                seen, ctx = probs[probs["k"] == k], gammas[gammas["k"] == k]
                left = np.ones(a ** (k - 1), dtype=np.float32)
                left[ctx["ctx"].to_numpy(np.int64)] = ctx["gamma"].to_numpy()
                lower = np.tile(p, a)
                p = (lower.reshape(a ** (k - 1), a) * left[:, None]).ravel()
                p[seen["gram"].to_numpy(np.int64)] = seen["p"].to_numpy()
            self._log = np.log10(np.maximum(p, 1e-30, out=p), out=p)
        return self._log

    def forget(self) -> None:
        self._log = self.coder = None

    def score(self, text: str) -> tuple[float, int]:
        """Log10 probability of a whole text with its end, and how many characters that is."""
        return float(self.scores([text])[0]), len(text) + 1

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log10 probabilities of whole texts with their ends."""
        log, total = self.log10(), np.zeros(len(texts))
        for first, starts, grams, found in self.coder.blocks(texts, self.wide is not None):
            each = log[grams].astype(np.float64)
            if found is not None:
                at, ctx, part, low = found
                each[at] = np.log10(self.wide.probabilities(ctx, part, low, 10.0 ** each[at]))
            total[first:first + len(starts)] += np.add.reduceat(each, starts)
        return total

    def wide_grams(self, texts: list[str]) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, ctx, part, low, base) of the wide n-grams of texts, some at a
        time; ``base`` is the symbol's probability in the joined table."""
        log = self.log10()
        for first, starts, grams, found in self.coder.blocks(texts):
            if found is not None:
                yield first + np.searchsorted(starts, found[0], "right") - 1, *found[1:], 10.0 ** log[grams[found[0]]].astype(np.float64)


def fit(trusted: DataFrame, folds: int = 1) -> list[Model]:
    """The model of all of ``trusted`` (text, fold) and, for more than one fold,
    the models that leave out fold 0, 1, ... (every text is counted once)."""
    chars = alphabet(trusted)
    models = range(folds + 1 if folds > 1 else 1)

    def counted(count: Callable[[DataFrame, Coder], DataFrame]) -> DataFrame:
        parts = [count(trusted.filter(F.col("fold") == f), Coder(chars)).select(
            F.explode(F.array(*[F.lit(m) for m in models if m != f + 1])).alias("model"), "*") for f in range(folds)]
        both = reduce(DataFrame.unionByName, parts)
        return both.groupBy(*[c for c in both.columns if c != "n"]).agg(F.sum("n").alias("n"))
    # at most SYMBOLS^ORDER rows a model, whatever the data
    probs, gammas = (t.toPandas() for t in interpolated(counted(gram_counts)))
    made = [Model(chars, probs[probs["model"] == m], gammas[gammas["model"] == m]) for m in models]
    levels = wide_levels(counted(wide_counts))
    if sum(t.count() for t in levels) > WIDE_ROWS:
        for m in models:
            made[m].shards = tuple(t.filter(F.col("model") == m).drop("model") for t in levels)
        return made
    for m in models:
        # one model's rows at a time
        made[m] = Model(*made[m].parts[:5], Wide(*(t.filter(F.col("model") == m).drop("model").toArrow().to_pandas() for t in levels)))
    return made


def with_perplexity(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` plus log10_prob, n_symbols and perplexity (per symbol)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def fn(texts: list[str]) -> list:
            found, sizes = m.scores(texts), np.array([len(t) + 1 for t in texts], dtype=np.int64)
            return [found, sizes, 10.0 ** (-found / sizes)]
        return fn, m.forget
    out = with_columns_from_text(docs, make, [("log10_prob", "double"), ("n_symbols", "long"), ("perplexity", "double")])
    if model.shards is None:
        return out
    more = _wide_sums(docs, shared, *model.shards)
    joined = out.withColumn("__text", _text_key()).join(more, "__text", "left").drop("__text")
    return joined.withColumn("log10_prob", F.col("log10_prob") + F.coalesce("__more", F.lit(0.0))).drop("__more") \
        .withColumn("perplexity", F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_symbols")))


def _text_key() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")), 256)


def _wide_sums(docs: DataFrame, shared: Broadcast, grams: DataFrame, contexts: DataFrame) -> DataFrame:
    """(__text, __more): what the wide levels add to the log10 probability of
    each text.  The texts' wide n-grams, under a number for each text, are joined
    with the levels by context."""
    names = ["id", "ctx", "part", "low", "base"]
    kinds = pa.schema([("id", pa.int64()), ("ctx", pa.int64()), ("part", pa.int64()), ("low", pa.int64()),
                       ("base", pa.float64()), ("n", pa.int64()), ("__text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        number = TaskContext.get().partitionId() << 40
        try:
            for batch, texts in text_slices(batches, 1):
                keys = batch.column(0)
                ids = pa.array(np.arange(number, number + len(keys)))
                yield pa.RecordBatch.from_arrays([ids, *(pa.nulls(len(keys), f.type) for f in list(kinds)[1:-1]), keys], schema=kinds)
                for found in m.wide_grams(texts):
                    rows = pa.table([found[0] + number, *found[1:]], names=names).group_by(names).aggregate([([], "count_all")])
                    rows = rows.rename_columns([*names, "n"]).append_column("__text", pa.nulls(rows.num_rows, pa.string()))
                    yield from rows.cast(kinds).to_batches(1 << 16)
                number += len(keys)
        finally:
            m.forget()
            let_go()
    # written, so that a text keeps its number
    made = stored(docs.select(_text_key().alias("__key"), "text").mapInArrow(
        run, "id long, ctx long, part long, low long, base double, n long, __text string"), "kn-wide-asked")
    own = made.filter("__text IS NULL").drop("__text")
    names = names[1:]
    all_ = own.select(*names).distinct().withColumn("p", F.lit(None).cast("double")).withColumn("scale", F.lit(1.0)) \
        .withColumn("spelt", F.expr(f"part DIV {SYMBOLS}"))
    for j in range(ORDER - 1, 0, -1):
        here = grams.filter(F.col("j") == j).select(F.col("ctx").alias("at"), "part", "a", "g")
        left = contexts.filter(F.col("j") == j).select(F.col("ctx").alias("at"), "spelt", "gamma")
        all_ = all_.withColumn("at", _last(j)).join(here, ["at", "part"], "left").join(left, ["at", "spelt"], "left")
        used = F.col("p").isNull() & (F.col("low") <= j)
        p = F.when(used & F.col("a").isNotNull(), F.col("scale") * (F.col("a") + F.col("g") * F.col("base"))).otherwise(F.col("p"))
        scale = F.when(used, F.col("scale") * F.coalesce("gamma", F.lit(1.0))).otherwise(F.col("scale"))
        all_ = all_.withColumns({"p": p, "scale": scale}).drop("at", "a", "g", "gamma")
    more = all_.select("ctx", "part", (F.log10(F.coalesce("p", F.col("scale") * F.col("base"))) - F.log10("base")).alias("more"))
    sums = own.join(more, ["ctx", "part"]).groupBy("id").agg(F.sum(F.col("n") * F.col("more")).alias("__more"))
    # rows of equal texts have equal sums
    return made.filter("__text IS NOT NULL").select("id", "__text").join(sums, "id").groupBy("__text").agg(F.max("__more").alias("__more"))


def bounds() -> tuple:
    """Aggregates (low, high): outer quantiles, widened, and never closer to the
    median than REACH times the spread of the middle of the distribution, so
    that few trusted documents don't make a narrow gate."""
    q = F.percentile_approx("perplexity", [LOW, 0.05, 0.5, 0.95, HIGH], 10_000)
    low = F.least(q[0] * (1 - SLACK), q[2] - REACH * (q[2] - q[1]))
    high = F.greatest(q[4] * (1 + SLACK), q[2] + REACH * (q[3] - q[2]))
    return low.alias("low"), high.alias("high")


def limits(trusted: DataFrame) -> DataFrame:
    """(lang, low, high) for every language of the trusted documents."""
    return trusted.groupBy("lang").agg(*bounds())


def trusted_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, lang, fold) of the documents labelled good and not toxic, written
    once.  Only rows that a bitmap of the labels lets through are shuffled."""
    good = labels.filter((F.col("quality") == 1) & (F.col("toxic") == 0)).select(F.col("doc_id").cast("long").alias("id")).distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text", "lang")
    # labels grow with the data: a merge join at every size, not a broadcast while they are few
    kept = may_match(rows, good, ["id"]).join(good.hint("merge"), "id", "left_semi")
    return stored(kept.select("text", "lang", crc_mod(F.col("id"), FOLDS).cast("int").alias("fold")), "kn-trusted")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, lang and any others) plus log10_prob, n_symbols,
    perplexity and accepted.  The documents themselves are not shuffled.

    The gate comes from trusted documents scored by the model of the other
    folds: perplexities under a model that has read the text would be too low."""
    trusted = trusted_texts(docs, labels)
    model, *others = fit(trusted, FOLDS)
    unread = [with_perplexity(trusted.filter(F.col("fold") == f), m).select("lang", "perplexity") for f, m in enumerate(others)]
    marks = stored(reduce(DataFrame.unionByName, unread), "kn-marks")
    by_lang = stored(limits(marks).select(F.col("lang").alias("__lang"), F.col("low").alias("__low"),
                                          F.col("high").alias("__high")), "kn-limits")
    overall = marks.agg(*bounds()).first()
    low, high = (overall["low"], overall["high"]) if overall["low"] is not None else (0.0, float("inf"))
    # at most LANGUAGES rows are broadcast
    by_lang = F.broadcast(by_lang) if by_lang.count() <= LANGUAGES else by_lang
    joined = with_perplexity(docs, model).join(by_lang, F.col("lang").eqNullSafe(F.col("__lang")), "left")
    return joined.withColumn("accepted", F.col("perplexity").between(
        F.coalesce("__low", F.lit(low)), F.coalesce("__high", F.lit(high)))).drop("__lang", "__low", "__high")
