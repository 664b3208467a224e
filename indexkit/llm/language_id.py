"""Language identification of words in code-switched text with a linear-chain
conditional random field (see ``crf``).

The model is trained here, on a sample of labelled documents: at most
``TRAIN_DOCS`` rows of every language (equal rows count once), each whole or,
beyond ``TRAIN_CHARS`` characters, in ``SPANS`` spans spread over the whole text.
Training sequences grow with the languages.  What it predicts from is the text
alone.  Documents are scored whole: a document's language is the one with the
largest mean marginal over all its words, and that mean is its score.

All languages are learned.  Up to ``FAN`` share one field; more are dealt, in
alphabetical order, to a tree of fields with at most ``FAN`` states each, whose
upper states are groups of languages.  A document then goes down the tree by
its largest mean marginal, and its score is the product of those on the way.
Every field is trained in a task of its own and broadcast by itself; a worker
holds at most ``HELD`` of them.

Defined results: a null text, or one without a letter, is ``und`` with score 0;
with no labelled document everything is ``und``; a tie goes to the
alphabetically first language; repeated rows get equal results; an empty table
gives an empty result; an extra column is left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from indexkit.llm import crf
from indexkit.llm.common import may_match, stored, takes, with_columns_from_text

TRAIN_DOCS = 250
TRAIN_CHARS, SPANS = 3000, 6
#: Training sequences per state of a field, and how many make a batch.
SEQUENCES, BATCH = 250, 1500
#: States of a field, and fields that a worker holds at a time.
FAN, HELD = 32, 4
#: Characters of text taken up at a time by a task, and words it remembers.
TAKE_CHARS = 1_500_000
MEMO = 300_000
_WORD = regex.compile(r"\p{L}+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Model:
    """States of one field and their weights; small enough to travel with a task (2^BITS rows
    of one number per language)."""

    def __init__(self, langs: list[str], weights: np.ndarray, trans: np.ndarray):
        self.langs, self.weights, self.trans = langs, weights, trans
        self._row: dict[str, int] = {}
        self._table = np.zeros((0, len(langs)), dtype=np.float32)

    def __getstate__(self) -> tuple:
        return self.langs, self.weights, self.trans

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def forget(self) -> None:
        self._row, self._table = {}, self._table[:0].copy()

    def emissions(self, words: list[str]) -> np.ndarray:
        new = list(set(words).difference(self._row))
        if len(self._row) + len(new) > MEMO:
            self._row, new = {}, list(set(words))
            self._table = self._table[:0]
        if new:
            self._row.update(zip(new, range(len(self._row), len(self._row) + len(new))))
            self._table = np.concatenate([self._table, crf.emissions(new, self.weights)])
        return self._table[np.fromiter(map(self._row.__getitem__, words), dtype=np.int64, count=len(words))]

    def texts(self, texts: list[str]) -> np.ndarray:
        """Mean marginals [D, L]."""
        lengths = np.zeros(len(texts), dtype=np.int64)
        parts: list[np.ndarray] = []
        held: list[str] = []
        for k, text in enumerate(texts):
            for at, piece in _pieces(text):
                found = words_of(piece)
                lengths[k] += len(found)
                held += found
                if len(held) > 200_000:
                    parts.append(self.emissions(held))
                    held = []
        parts.append(self.emissions(held))
        return crf.posteriors(np.concatenate(parts), lengths, self.trans)[0]

    def label_words(self, text: str) -> list[tuple[str, str, float]]:
        """Every word of a text with its language and marginal."""
        found = words_of(text)
        if not found or not self.langs:
            return [(w, "und", 0.0) for w in found]
        _, each = crf.posteriors(self.emissions(found), np.array([len(found)]), self.trans, per_word=True)
        best = each.argmax(1)
        return [(w, self.langs[k], float(p[k])) for w, k, p in zip(found, best, each)]


def _pieces(text: str, size: int = TAKE_CHARS) -> Iterator[tuple[int, str]]:
    """A text in pieces that end between words."""
    at = 0
    while at < len(text):
        end = at + size
        while end < len(text) and text[end].isalpha():
            end += 1
        yield at, text[at:end]
        at = end


def fields(langs: list[str]) -> list[list[list[str]]]:
    """The fields of the tree over ``langs``, the root first: for every state its
    languages.  A state of several languages has a field of its own."""
    out: list[list[list[str]]] = []
    todo = [list(langs)]
    for own in todo:
        n = len(own) if len(own) <= FAN else min(FAN, -(-len(own) // FAN))
        states = [own[k * len(own) // n:(k + 1) * len(own) // n] for k in range(n)] if n else []
        todo += [s for s in states if len(s) > 1]
        out.append(states)
    return out


class Tree:
    """Fields by number, each broadcast by itself; states are language names or,
    as ``#`` and a number, further fields."""

    def __init__(self, shared: dict[int, Broadcast]):
        self.shared = shared
        self._held: dict[int, Model] = {}

    def __getstate__(self) -> dict[int, Broadcast]:
        return self.shared

    def __setstate__(self, shared: dict[int, Broadcast]) -> None:
        self.__init__(shared)

    def field(self, number: int) -> Model:
        model = self._held.pop(number, None) or self.shared[number].value
        self._held[number] = model
        while len(self._held) > HELD:
            self._drop(next(iter(self._held)))
        return model

    def _drop(self, number: int) -> None:
        self._held.pop(number).forget()
        if number:
            self.shared[number].__dict__.pop("_value", None)  # read again when needed

    def forget(self) -> None:
        for number in list(self._held):
            self._drop(number)

    def languages(self, texts: list[str], number: int = 0) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        if number not in self.shared:
            return ["und"] * len(texts), np.zeros(len(texts))
        model = self.field(number)
        mean = np.concatenate([model.texts(part) for part in takes(texts, TAKE_CHARS)])
        best, score = mean.argmax(1), np.clip(mean.max(1), 0, 1)
        names = [model.langs[k][1] if ok else "und" for k, ok in zip(best, mean.sum(1) > 0)]
        for k, (kind, name) in enumerate(model.langs):
            rows = np.flatnonzero((best == k) & (mean.sum(1) > 0)) if kind == "#" else ()
            if len(rows):
                below, share = self.languages([texts[r] for r in rows], int(name))
                score[rows] *= share
                for r, found in zip(rows, below):
                    names[r] = found
        return names, np.where(mean.sum(1) > 0, score, 0.0)


def spans(text: Column, mark: Column) -> Column:
    """A text as one span if it has at most TRAIN_CHARS characters, else SPANS
    spans, each at a place of its own share of the text that the mark chooses."""
    size = TRAIN_CHARS // SPANS
    share = F.floor(F.char_length(text) / SPANS).cast("int")
    cut = F.array(*[F.substring(text, share * k + F.pmod(F.xxhash64(mark, F.lit(k)), share - size + 1).cast("int") + 1, F.lit(size))
                    for k in range(SPANS)])
    return F.when(F.char_length(text) <= TRAIN_CHARS, F.array(text)).otherwise(cut)


def sample(docs: DataFrame, usable: Column) -> DataFrame:
    """(lang, n, mark, spans) of at most TRAIN_DOCS rows of every language; ``n``
    numbers them from 1 in an order given by hashes of id and text."""
    key = ["lang", "mark", "body"]
    known = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "lang", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("mark"),
        F.xxhash64("text").alias("body"), "text")
    pick = Window.partitionBy("lang").orderBy("mark", "body")
    picked = stored(known.select(*key).distinct().withColumn("n", F.row_number().over(pick))
                    .filter(F.col("n") <= TRAIN_DOCS), "lang-picked")
    # only the picked rows are shuffled with their texts
    return may_match(known, picked, key).select(*key, spans(F.col("text"), F.col("mark")).alias("spans")) \
        .dropDuplicates(key).join(picked, key).select("lang", "n", "mark", "spans")


def _span_words(found: list[str]) -> list[list[str]]:
    """Words of each span, without those that its ends may have cut."""
    each = [words_of(t) for t in found]
    return [w[1:-1] if len(each) > 1 and len(w) > 2 else w for w in each]


def fit(docs: DataFrame, usable: Column) -> Tree:
    """Train on the labelled rows of ``docs`` (doc_id, text, lang) for which
    ``usable`` holds."""
    spark = docs.sparkSession
    rows = stored(sample(docs, usable), "lang-sample")
    tree = fields(sorted(r["lang"] for r in rows.select("lang").distinct().collect()))
    number = {tuple(l for s in states for l in s): k for k, states in enumerate(tree)}
    # a state learns from TRAIN_DOCS rows, or one of each language if it has more
    parts = [(k, j, lang, -(-TRAIN_DOCS // len(s))) for k, states in enumerate(tree) for j, s in enumerate(states) for lang in s]
    if not parts:
        return Tree({})
    sequences, batch_size = SEQUENCES, BATCH

    def learn(batch: pd.DataFrame) -> pd.DataFrame:
        batch = batch.sort_values(["lang", "n"])
        texts = [[w for part in _span_words(list(found)) for w in part] for found in batch["spans"]]
        states = sorted({int(j) for j, t in zip(batch["state"], texts) if t})
        pairs = [(t, states.index(j)) for t, j in zip(texts, batch["state"]) if t]
        weights, trans = crf.train([t for t, _ in pairs], [k for _, k in pairs], len(states), sequences=batch_size,
                                   batches=-(-sequences * len(states) // batch_size))
        return pd.DataFrame({"field": [int(batch["field"].iloc[0])], "states": [states],
                             "weights": [weights.tobytes()], "trans": [trans.tobytes()]})

    dealt = rows.join(spark.createDataFrame(parts, "field int, state int, lang string, most int"), "lang").filter("n <= most")
    # one bounded group per field: at most FAN states
    got = stored(dealt.select("field", "state", "lang", "n", "spans").groupBy("field").applyInPandas(
        learn, "field int, states array<int>, weights binary, trans binary"), "lang-fields")
    shared = {}
    for r in got.toLocalIterator():
        own, n = [tree[r["field"]][j] for j in r["states"]], len(r["states"])
        if n:
            names = [("", s[0]) if len(s) == 1 else ("#", str(number[tuple(s)])) for s in own]
            shared[r["field"]] = spark.sparkContext.broadcast(Model(
                names, np.frombuffer(r["weights"], dtype=np.float32).reshape(-1, n), np.frombuffer(r["trans"]).reshape(n, n)))
    return Tree(shared)


def predict(docs: DataFrame, tree: Tree) -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``lang_score``."""
    def make():
        def fn(texts: list[str]) -> list:
            return list(tree.languages(texts)) if texts else [[], []]
        return fn, tree.forget
    return with_columns_from_text(docs, make, [("lang_pred", "string"), ("lang_score", "double")])
