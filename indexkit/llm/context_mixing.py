"""Language-model scoring by online logistic mixing of hashed-context bit
predictors.

The text is a sequence of tokens (words between ASCII white space, A-Z lowered,
then one end).  A token is written as the bits of a prefix code over a bounded
dictionary (at most ``DICTIONARY`` of the commonest training words), the end and one
symbol for all other words.  Every bit is predicted by

* the node of the code alone (training counts), and
* three hashed contexts: the word before, the two words before, and the last
  very common word (which tells the language).

A hashed context keeps the counts of both bit values in a table of fixed size,
summed over all training documents.  Predictions are mixed in the logistic
domain; the weights are chosen by a gate (how often the contexts have been
seen) and refined online along each document, starting anew in every document,
so a document's score doesn't depend on the partition it is read in.

A word outside the dictionary adds its share of that symbol: by its training
count, joined in Spark, or, if unseen in training, by a byte-wise spelling whose
bits are predicted from hashed contexts of one to three bytes.  These
terms are sums over words, so the join needs no text and no order.

What is sent to tasks has a fixed bound: the dictionary, its code and the
context tables.  Word counts themselves stay distributed.

Defined results: a null or empty text is its end token; a null id is held out
or not by the crc32 of the empty text; repeated rows are scored (and learned
from) separately; with no training document the code has its two special
symbols only; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexkit.llm.common import stored

DICTIONARY = 1 << 17
TABLE_BITS, SPELL_BITS = 21, 18
#: Longest context of the spelling, in bytes, and how soon a context is trusted.
SPELL_ORDER, SPELL_TRUST = 3, 3.0
#: The commonest words that serve as the language-telling context.
COMMON = 64
#: Characters of text laid out at a time (a look-up of words has a cost of its own).
TAKE_CHARS = 4_000_000
#: Tokens whose contexts, and whose bits, are worked on at a time: their arrays stay in cache.
GROUP, BLOCK = 80_000, 4_000
#: Distinct words a task counts before it passes them on.
HOLD_WORDS = 400_000
#: Tokens after which a document's weights are refined, and from when on rarely.
SEGMENT, LONG_SEGMENT, EARLY = 96, 1024, 8
RATE, REACH = 3.0, 200.0
#: First weights by gate (see ``_gates``) and input: node, previous word, two words, common word.
_FIRST = {"unseen": (1.0, 0.45, 0.0, 0.75), "rare": (1.0, 0.3, 0.75, 0.4), "often": (1.0, 0.2, 0.9, 0.2)}
LOG10_2 = float(np.log10(2.0))
_M = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


#: What ends a word (bytes.split knows the same six).
_WHITE = frozenset(b" \t\n\x0b\x0c\r")


def pieces(text: str) -> Iterator[list[bytes]]:
    """Words of a text, a bounded list at a time."""
    data = text.encode("utf-8").lower()
    at, size = 0, 4_000_000
    while at < len(data):
        end = at + size
        while end < len(data) and data[end] not in _WHITE:
            end += 1
        yield data[at:end].split()
        at = end


# ---- prefix code --------------------------------------------------------------
class Code:
    """Huffman code of a bounded alphabet: for each symbol the tree nodes and
    bits on its path, flat; and the static prediction of every node."""

    def __init__(self, weights: np.ndarray):
        n = len(weights)
        heap = [(int(w), k) for k, w in enumerate(weights)]
        heapq.heapify(heap)
        parent = np.zeros(2 * n - 1, dtype=np.int64)
        bit = np.zeros(2 * n - 1, dtype=np.uint8)
        mass = np.zeros((max(n - 1, 1), 2))
        for node in range(n - 1):
            (w0, a), (w1, b) = heapq.heappop(heap), heapq.heappop(heap)
            parent[a] = parent[b] = n + node
            bit[b] = 1
            mass[node] = w0, w1
            heapq.heappush(heap, (w0 + w1, n + node))
        self.static = np.log((mass[:, 1] + 0.1) / (mass[:, 0] + 0.1)).astype(np.float32)
        nodes, bits, self.length = [], [], np.zeros(n, dtype=np.int64)
        now, owner = np.arange(n), np.arange(n)
        while len(now) and n > 1:
            up = parent[now]
            nodes.append((owner, up - n, bit[now]))
            self.length[owner] += 1
            keep = up < 2 * n - 2
            now, owner = up[keep], owner[keep]
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64)
        self.node = np.zeros(int(self.length.sum()), dtype=np.int32)
        self.bit = np.zeros(len(self.node), dtype=np.uint8)
        place = self.start.copy()
        for who, at, value in nodes:
            self.node[place[who]], self.bit[place[who]] = at, value
            place[who] += 1


def _spread(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and flat position of ``length`` items after each ``start``."""
    owner = np.repeat(np.arange(len(length)), length)
    first = np.cumsum(length) - length
    return owner, np.arange(len(owner)) - first[owner] + start[owner]


def _flat(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Flat positions of ``length`` items after each ``start``."""
    flat = np.repeat(start - (np.cumsum(length) - length), length)
    flat += np.arange(len(flat))
    return flat


def _blocks(take: np.ndarray, tokens: int) -> Iterator[tuple[int, int]]:
    """Runs of documents of at most ``tokens`` tokens (or one document)."""
    ends = np.cumsum(take)
    lo = 0
    while lo < len(take):
        hi = int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + tokens, "right"))
        hi = max(lo + 1, hi)
        yield lo, hi
        lo = hi


# ---- contexts ------------------------------------------------------------------
def contexts(ids: np.ndarray, lengths: np.ndarray, n_common: int) -> np.ndarray:
    """Hashes [3, T] of the contexts of every token of documents laid end to end."""
    total = len(ids)
    first = np.zeros(total, dtype=bool)
    first[np.cumsum(lengths) - lengths] = True
    word = ids.astype(np.int64) + 2
    one = np.concatenate([[1], word[:-1]])
    one[first] = 1
    two = np.concatenate([[1], one[:-1]])
    two[first] = 1
    at = np.arange(total)
    begin = np.maximum.accumulate(np.where(first, at, 0))
    seen = np.maximum.accumulate(np.where(ids < n_common, at, -1))
    before = np.concatenate([[-1], seen[:-1]])
    common = np.where(before >= begin, word[np.maximum(before, 0)], 1)
    with np.errstate(over="ignore"):
        one, two, common = (x.astype(np.uint64) for x in (one, two, common))
        return np.stack([one * _M[0] + np.uint64(11), (one * _M[1] ^ two * _M[2]) + np.uint64(22), common * _M[3] + np.uint64(33)])


def _slots(h: np.ndarray, mixed: np.ndarray, bits: int) -> np.ndarray:
    """Slots of contexts ``h`` at tree nodes (``mixed`` by ``_mix``)."""
    x = h ^ mixed
    x *= _M[0]  # arrays wrap around without a warning
    x ^= x >> np.uint64(29)
    x *= _M[1]
    x >>= np.uint64(64 - bits)
    return x.view(np.int64)


def _mix(node: np.ndarray) -> np.ndarray:
    return node.astype(np.uint64) * _M[2]


def predictors(n0: np.ndarray, n1: np.ndarray, trust: float = 1.5) -> np.ndarray:
    """(logit, trust) of slots from their two counts; an unseen slot has trust 0."""
    n0, n1 = n0.astype(np.float64), n1.astype(np.float64)
    return np.stack([np.log((n1 + 0.3) / (n0 + 0.3)), (n0 + n1) / (n0 + n1 + trust)], axis=1).astype(np.float32)


#: Slots of a table that travel in one row.
PACK = 1 << 10
_COUNT_ROWS = "block int, counts binary"


def _emit(counts: np.ndarray) -> pa.RecordBatch:
    """The touched blocks of a task's table [slots, 2], packed."""
    blocks = counts.reshape(-1, PACK * 2)
    used = np.flatnonzero(blocks.any(axis=1))
    return pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([blocks[k].tobytes() for k in used], pa.binary())],
                                      names=["block", "counts"])


def collected(counts: DataFrame, bits: int, trust: float = 1.5) -> np.ndarray:
    """Predictors [2^bits, 2] from the packed counts of all tasks.  Blocks are
    dealt and sorted, then summed as a stream that holds one block at a time;
    the driver gets 2^bits / PACK rows of fixed size and nothing else."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(block: int, total: np.ndarray) -> pa.RecordBatch:
            packed = predictors(total[:, 0], total[:, 1], trust) * (total.sum(axis=1) > 0)[:, None].astype(np.float32)
            return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed.tobytes()], pa.binary())],
                                              names=["block", "counts"])
        now, total = None, None
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if block != now:
                    if now is not None:
                        yield row(now, total)
                    now, total = block, np.zeros((PACK, 2), dtype=np.int64)
                total += np.frombuffer(packed.as_buffer(), dtype=np.int32).reshape(PACK, 2)
        if now is not None:
            yield row(now, total)
    table = np.zeros((1 << bits, 2), dtype=np.float32)
    summed = counts.repartition("block").sortWithinPartitions("block").mapInArrow(add, _COUNT_ROWS)
    for r in summed.toLocalIterator():
        table[r["block"] * PACK:(r["block"] + 1) * PACK] = np.frombuffer(r["counts"], dtype=np.float32).reshape(PACK, 2)
    return table


class Mixer:
    """Dictionary, code and tables: what a task needs to score texts."""

    def __init__(self, words: list[bytes], counts: np.ndarray, weights: np.ndarray, table: np.ndarray | None):
        self.words, self.counts, self.weights, self.table = words, counts, weights, table
        self._code: Code | None = None

    def __getstate__(self) -> tuple:
        return self.words, self.counts, self.weights, self.table

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def ready(self) -> "Mixer":
        if self._code is None:
            self._code = Code(self.weights)
            self._mixed = _mix(self._code.node)
            self._static = self._code.static[self._code.node]
            self._sign = self._code.bit.astype(np.float32) * 2 - 1
            self._set = pa.array(self.words, pa.large_binary())
            self.end, self.other = len(self.words), len(self.words) + 1
            self.base = np.append(np.log10(self.counts.astype(np.float64) + 1), [0.0, 0.0])
            first = list(_FIRST.values())
            self.first = np.array([first[k // 2] for k in range(6)], dtype=np.float32)
        return self

    def _pairs(self) -> np.ndarray:
        """The table, each slot's two numbers as one."""
        return np.ascontiguousarray(self.table, dtype=np.float32).view(np.complex64).ravel()

    def ids(self, words: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(words, value_set=self._set), self.other).to_numpy()

    def count(self, ids: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> None:
        """Add the bits of documents to the slots of their contexts."""
        ends = np.cumsum(lengths)
        for lo, hi in _blocks(lengths, GROUP):
            begin = ends[lo] - lengths[lo]
            self._count_group(ids[begin:ends[hi - 1]], lengths[lo:hi], counts.reshape(-1))

    def _count_group(self, ids: np.ndarray, lengths: np.ndarray, flat_counts: np.ndarray) -> None:
        code, h, one = self._code, contexts(ids, lengths, COMMON), np.int32(1)
        for at in range(0, len(ids), BLOCK):
            part = slice(at, at + BLOCK)
            length = code.length.take(ids[part])
            flat = _flat(code.start.take(ids[part]), length)
            mixed, bit = self._mixed.take(flat), code.bit.take(flat)
            for k in range(3):
                slots = _slots(np.repeat(h[k, part], length), mixed, TABLE_BITS)
                slots *= 2
                slots += bit
                np.add.at(flat_counts, slots, one)

    def score(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Log10 probability of the symbols of each document."""
        ends = np.cumsum(lengths)
        return np.concatenate([self._score_group(ids[ends[lo] - lengths[lo]:ends[hi - 1]], lengths[lo:hi])
                               for lo, hi in _blocks(lengths, GROUP)])

    def _score_group(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        h = contexts(ids, lengths, COMMON)
        pairs = self._pairs()
        # the longest documents first: those with tokens left are always the first ones
        order = np.argsort(-lengths, kind="stable")
        begin, left = (np.cumsum(lengths) - lengths)[order], lengths[order]
        bits = np.zeros(len(order))
        weight = [np.tile(self.first[:, k], (len(order), 1)) for k in range(4)]
        turn = 0
        while len(left) and left[0] > 0:
            take = np.minimum(left[:np.searchsorted(-left, 0)], SEGMENT if turn < EARLY else LONG_SEGMENT)
            for lo, hi in _blocks(take, BLOCK):
                goes_on = int(np.searchsorted(-left[lo:hi], -take[lo]))
                bits[lo:hi] += self._score_block(ids, h, pairs, begin[lo:hi], take[lo:hi], goes_on, [w[lo:hi] for w in weight])
            begin[:len(take)] += take
            left[:len(take)] -= take
            turn += 1
        result = np.empty(len(order))
        result[order] = -bits * LOG10_2
        return result

    def _score_block(self, ids: np.ndarray, h: np.ndarray, pairs: np.ndarray, begin: np.ndarray, take: np.ndarray,
                     goes_on: int, weight: list[np.ndarray]) -> np.ndarray:
        """Bits of the next ``take`` tokens of some documents; refines in place the
        ``weight`` of the first ``goes_on``, which have tokens left."""
        code, docs = self._code, len(take)
        token = _flat(begin, take)
        sym = ids.take(token)
        length = code.length.take(sym)
        flat = _flat(code.start.take(sym), length)
        static, sign, mixed = self._static.take(flat), self._sign.take(flat), self._mixed.take(flat)
        x = [static]
        trust = []
        for k in range(3):
            got = pairs.take(_slots(np.repeat(h[k].take(token), length), mixed, TABLE_BITS))  # logit and trust as one number
            trust.append(got.imag)
            logit = got.real - static
            logit *= got.imag
            x.append(logit)
        gate = (trust[1] > 0).view(np.int8) + (trust[1] > 0.75).view(np.int8)
        gate *= 2
        gate += (trust[0] > 0.9).view(np.int8)
        doc = np.repeat(np.repeat(np.arange(docs), take), length)
        cell = doc * 6
        cell += gate
        z = x[0] * weight[0].take(cell)
        for k in range(1, 4):
            z += x[k] * weight[k].take(cell)
        np.clip(z, -14, 14, out=z)
        z *= sign
        np.negative(z, out=z)
        odds = np.exp(z, out=z)                      # (1 - p) / p of the coded bit
        ends = np.cumsum(length)[np.cumsum(take) - 1]
        bits = np.add.reduceat(np.log2(1 + odds), np.append(0, ends[:-1]), dtype=np.float64)
        if goes_on:
            n = int(ends[goes_on - 1])
            cell, miss = cell[:n], odds[:n] / (1 + odds[:n]) * sign[:n]
            seen_bits = np.bincount(cell, minlength=goes_on * 6) + REACH
            lane = cell * 4 + np.arange(n) % 4  # neighbours add to sums of their own
            for k in range(4):
                total = np.bincount(lane, weights=miss * x[k][:n], minlength=goes_on * 24).reshape(-1, 4).sum(axis=1)
                gain = RATE * total / seen_bits
                weight[k][:goes_on] += gain.astype(np.float32).reshape(-1, 6)
        return bits


# ---- spelling of unseen words ------------------------------------------------------
def _spelled(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per bit of all words and their end marks: word, slots [SPELL_ORDER, B], bit."""
    data = np.frombuffer(b"".join(w + b" " for w in words), dtype=np.uint8).astype(np.uint64)
    length = np.fromiter((len(w) + 1 for w in words), dtype=np.int64, count=len(words))
    owner, _ = _spread(np.zeros(len(words), dtype=np.int64), length)
    place = np.arange(len(data)) - (np.cumsum(length) - length)[owner]
    history = np.zeros(len(data), dtype=np.uint64)
    hashes = []
    for k in range(1, SPELL_ORDER + 1):
        prior = np.concatenate([np.zeros(k, dtype=np.uint64), data[:-k]])[:len(data)] if len(data) else data
        history = history * np.uint64(257) + np.where(place >= k, prior + np.uint64(1), np.uint64(0))
        hashes.append(history * np.uint64(4) + np.uint64(k))
    node = np.ones(len(data), dtype=np.uint64)
    nodes, bits = [], []
    for k in range(7, -1, -1):
        bit = (data >> np.uint64(k)) & np.uint64(1)
        nodes.append(node)
        bits.append(bit)
        node = node * np.uint64(2) + bit
    node, bit = np.concatenate(nodes), np.concatenate(bits).astype(np.int64)
    with np.errstate(over="ignore"):
        mixed = _mix(node)
        slots = np.stack([_slots(np.tile(h, 8) * _M[3], mixed, SPELL_BITS) for h in hashes])
    return np.tile(owner, 8), slots, node, bit


def spell_counts(words: list[bytes], counts: np.ndarray) -> None:
    _, slots, _, bit = _spelled(words)
    for s in slots:
        np.add.at(counts.reshape(-1), s * 2 + bit, np.int32(1))


def spell_log10(words: list[bytes], table: np.ndarray) -> np.ndarray:
    """Log10 probability of each word's bytes and end mark: longer contexts
    refine the shorter ones as far as they are trusted."""
    if not words:
        return np.zeros(0)
    owner, slots, _, bit = _spelled(words)
    z = np.zeros(len(bit), dtype=np.float32)
    for s in slots:
        got = table[s]
        z += got[:, 1] * (got[:, 0] - z)
    p = 1 / (1 + np.exp(-np.clip(z, -12, 12) * (2 * bit - 1)))
    return np.bincount(owner, weights=np.log10(p), minlength=len(words))


# ---- Spark --------------------------------------------------------------------------
def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts; the end token has a null word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        def batch_of() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held.keys()), pa.binary()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])
        for batch in batches:
            texts = batch.column(0).to_pylist()
            held[None] += len(texts)
            for text in texts:
                for words in pieces(text or ""):
                    held.update(words)
                if len(held) > HOLD_WORDS:
                    yield batch_of()
                    held.clear()
        yield batch_of()
    return docs.select("text").mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def _takes(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and size < TAKE_CHARS:
            size += len(texts[end])
            end += 1
        yield at, texts[at:end]
        at = end


def _laid(mixer: Mixer, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[Counter]]:
    """Symbols of texts end to end, how many each has, and its words outside the
    dictionary.  Words are those of ``pieces``."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string())))
    words = split.flatten()
    real = pc.greater(pc.binary_length(words), 0)  # white space at an end leaves an empty string
    owner = pc.list_parent_indices(split).filter(real).to_numpy()
    words = words.filter(real).cast(pa.large_binary())
    symbol = mixer.ids(words)
    lengths = np.bincount(owner, minlength=len(texts)) + 1
    ids = np.full(int(lengths.sum()), mixer.end, dtype=np.int32)
    ids[np.arange(len(symbol)) + owner] = symbol  # one end for each text before
    others: list[Counter] = [Counter() for _ in texts]
    out = np.flatnonzero(symbol == mixer.other)
    for k, word in zip(owner[out].tolist(), words.take(pa.array(out)).to_numpy(zero_copy_only=False).tolist()):
        others[k][word] += 1
    return ids, lengths, others


def context_counts(docs: DataFrame, mixer: Mixer) -> DataFrame:
    """Packed counts of the slots that each task's texts touch."""
    shared = docs.sparkSession.sparkContext.broadcast(mixer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value.ready()
        counts = np.zeros((1 << TABLE_BITS, 2), dtype=np.int32)
        for batch in batches:
            for _, texts in _takes([t or "" for t in batch.column(0).to_pylist()]):
                ids, lengths, _ = _laid(m, texts)
                m.count(ids, lengths, counts)
        yield _emit(counts)
    return docs.select("text").mapInArrow(run, _COUNT_ROWS)


def spelling(counts: DataFrame) -> np.ndarray:
    """Spelling table from the words seen once: what unseen words look like."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((1 << SPELL_BITS, 2), dtype=np.int32)
        for batch in batches:
            words = batch.column(0).to_pylist()
            for at in range(0, len(words), 5000):
                spell_counts(words[at:at + 5000], counts)
        yield _emit(counts)
    once = counts.filter("c = 1 AND word IS NOT NULL").select("word")
    return collected(once.mapInArrow(run, _COUNT_ROWS), SPELL_BITS, SPELL_TRUST)


def _least_count(counts: DataFrame) -> int:
    """Count from which on at most DICTIONARY words are left (words of one count
    are taken together or not at all)."""
    by_count = counts.filter("word IS NOT NULL").groupBy("c").agg(F.count("*").alias("k"))
    taken, least = 0, 1 << 62
    for r in by_count.orderBy(F.desc("c")).limit(DICTIONARY).collect():
        taken += r["k"]
        if taken > DICTIONARY:
            break
        least = r["c"]
    return least


def fit(training: DataFrame, counts: DataFrame) -> tuple[Mixer, dict]:
    """Mixer and totals from ``training`` (text) and its word counts."""
    # at most DICTIONARY rows
    top = counts.filter("word IS NOT NULL").filter(F.col("c") >= _least_count(counts)).toPandas()
    top = top.assign(word=top["word"].map(bytes)).sort_values(["c", "word"], ascending=[False, True], kind="stable")
    row = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("once"),
                     F.sum(F.when(F.col("word").isNull(), F.col("c"))).alias("ends")).first()
    total = {"n": row["n"] or 0, "v": row["v"] if row["n"] else 0, "ends": row["ends"] or 0}
    own, words = top["c"].to_numpy(np.int64), top["word"].tolist()
    total["unseen"] = max(1, row["once"])
    total["tail"] = total["n"] - total["ends"] - int(own.sum())
    weights = np.concatenate([own, [max(1, total["ends"]), total["tail"] + total["unseen"]]])
    table = collected(context_counts(training, Mixer(words, own, weights, None)), TABLE_BITS)
    return Mixer(words, own, weights, table), total


def symbol_scores(docs: DataFrame, mixer: Mixer) -> DataFrame:
    """Additive rows by document (several for a document with very many words
    outside the dictionary)."""
    shared = docs.sparkSession.sparkContext.broadcast(mixer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value.ready()
        for batch in batches:
            rid, all_texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            ids_of, held = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for at, texts in _takes(all_texts):
                ids, lengths, others = _laid(m, texts)
                score = m.score(ids, lengths)
                doc = np.repeat(np.arange(len(texts)), lengths)
                base = np.bincount(doc, weights=m.base[ids], minlength=len(texts))
                known = np.bincount(doc[ids != m.other], minlength=len(texts))
                rows = []
                for k, text in enumerate(texts):
                    words = list(others[k].items())
                    first = [rid[at + k], ids_of[at + k], held[at + k], score[k], base[k], int(lengths[k]), int(known[k]), len(text.encode("utf-8"))]
                    rows.append((*first, [w for w, _ in words[:HOLD_WORDS]], [n for _, n in words[:HOLD_WORDS]]))
                    for more in range(HOLD_WORDS, len(words), HOLD_WORDS):
                        part = words[more:more + HOLD_WORDS]
                        rows.append((rid[at + k], None, None, 0.0, 0.0, 0, 0, 0, [w for w, _ in part], [n for _, n in part]))
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _SCORE_TYPES)], names=_SCORE_NAMES)
    return docs.select("rid", "text", "doc_id", "held_out").mapInArrow(
        run, "rid long, doc_id long, held_out boolean, symbols double, base double, n_tokens long, n_known long, n_bytes long, words array<binary>, times array<int>")


_SCORE_NAMES = ["rid", "doc_id", "held_out", "symbols", "base", "n_tokens", "n_known", "n_bytes", "words", "times"]
_SCORE_TYPES = [pa.int64(), pa.int64(), pa.bool_(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32())]


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """Learn from the rows of ``docs`` (doc_id, text) that aren't ``held_out``
    and score all rows: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score, bits_per_byte."""
    spark = docs.sparkSession
    training = docs.filter(~held_out)
    counts = stored(word_counts(training), "cm-counts")
    mixer, total = fit(training, counts)
    spell = spark.sparkContext.broadcast(spelling(counts))

    # numbered, with id and mark, in the one job that writes the scores: numbers of another job may differ
    numbered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out.alias("held_out"),
                           F.monotonically_increasing_id().alias("rid"))
    symbols = stored(symbol_scores(numbered, mixer), "cm-symbols")
    words = symbols.select("rid", F.explode(F.arrays_zip("words", "times")).alias("w")).select("rid", "w.words", "w.times")

    @F.pandas_udf("double")
    def spelled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = np.zeros(len(batch))
            unseen = np.flatnonzero(batch.notna().to_numpy())
            named = [bytes(w) for w in batch.iloc[unseen]]
            for at in range(0, len(named), 5000):
                out[unseen[at:at + 5000]] = spell_log10(named[at:at + 5000], spell.value)
            yield pd.Series(out)

    mass = float(total["tail"] + total["unseen"])
    met = words.join(counts.filter("word IS NOT NULL").withColumnRenamed("word", "words"), "words", "left")
    unseen = F.when(F.col("c").isNull(), F.col("words"))
    share = F.when(F.col("c").isNotNull(), F.log10(F.col("c") / mass)).otherwise(F.lit(float(np.log10(total["unseen"] / mass))))
    zero = F.lit(0).cast("long")
    tail = met.withColumn("spelled", spelled(unseen)).select(
        "rid", (F.col("times") * (share + F.col("spelled"))).alias("symbols"),
        (F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 1)).alias("base"), zero.alias("n_tokens"),
        F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0).cast("long").alias("n_known"), zero.alias("n_bytes"))
    by_doc = symbols.drop("doc_id", "held_out", "words", "times").unionByName(tail).groupBy("rid").agg(
        *[F.sum(c).alias(c) for c in ("symbols", "base", "n_tokens", "n_known", "n_bytes")])
    names = symbols.filter("n_tokens > 0").select("rid", "doc_id", "held_out")  # a document's first row
    ends = total["ends"]
    end_base = float(np.log10(ends + 1))
    room = float(np.log10(total["n"] + total["v"] + 1))
    return names.join(by_doc, "rid").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") - (0 if ends else 1)).alias("n_known"),
        F.lit(total["n"]).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(end_base) - F.col("n_tokens") * F.lit(room)).alias("base_score"),
        F.col("symbols").alias("score"),
        F.when(F.col("n_bytes") > 0, -F.col("symbols") / LOG10_2 / F.col("n_bytes")).alias("bits_per_byte"))
