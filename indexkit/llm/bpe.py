"""BPE encoding and decoding with a public vocabulary file.

Method: a contiguous rank array per word.  ``starts`` holds the part
boundaries and ``ranks`` the merge rank of each part with its right neighbour;
the minimum is found by a scan, its inner boundary is deleted and the two
neighbouring ranks are refreshed.  Words beyond ``SCAN_PARTS`` parts take the
same merges from a heap, so a single huge word stays near-linear.

Text is first cut at the vocabulary's special strings (they become their ids),
then normalised (NFC, white space to one blank, lower case by code point),
split into words by the vocabulary's pattern and mapped to byte symbols.  No
word crosses white space, so chunks between white space are encoded once per
worker and remembered in a table of bounded size.

Defined results: a null text counts as empty and gives no ids; an empty table
gives an empty result; repeated rows are encoded alike; only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexkit.llm.common import with_columns_from_text

#: Words with more parts than this merge through a heap.
SCAN_PARTS = 128
#: Chunks and characters remembered per Python worker; beyond it the table is emptied.
MEMO, MEMO_CHARS = 300_000, 8_000_000
#: Chunks of a text that are looked up at a time.
SLICE = 20_000
_NEVER, _ID = 1 << 60, (1 << 20) - 1
#: Python's white space that the vocabulary's pattern doesn't count as such.
_ODD_SPACE = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"[\t-\r \x85\p{Z}]+")


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte (the byte-level convention: printable
    Latin-1 stands for itself, the rest follows from code point 256)."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class Bpe:
    """Encoder and decoder for one vocabulary file of the ``tokenizers`` kind:
    merges with an end-of-word suffix, no decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        # (left id, right id) -> rank and merged id in one integer, so that the
        # least value of a rank array names its merge
        self.pair = {self.ids[x] << 20 | self.ids[y]: k << 20 | self.ids[x + y]
                     for k, (x, y) in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.word = regex.compile(pattern)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.inner = [self.ids[c] for c in byte_symbols()]
        self.final = [self.ids[c + self.suffix] for c in byte_symbols()]
        self._ids: dict[str, str] = {}
        self._tokens: dict[str, str] = {}
        self._words: dict[str, list[int]] = {}
        self._held = 0

    # ---- one word -------------------------------------------------------
    def merge(self, word: str) -> list[int]:
        """Ids of one word after all merges."""
        data = word.encode("utf-8")
        inner, pair = self.inner, self.pair.get
        parts = [inner[b] for b in data]
        parts[-1] = self.final[data[-1]]
        if len(parts) > SCAN_PARTS:
            return self._merge_heap(parts)
        ranks = [pair(x << 20 | y, _NEVER) for x, y in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) != _NEVER:
            i = ranks.index(low)
            parts[i] = new = low & _ID
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = pair(new << 20 | parts[i + 1], _NEVER)
            if i:
                ranks[i - 1] = pair(parts[i - 1] << 20 | new, _NEVER)
        return parts

    def _merge_heap(self, parts: list[int]) -> list[int]:
        n, pair = len(parts), self.pair
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        live: list[int | None] = list(parts)
        # rank first, then place: the order in which the scan would merge
        heap = [(m, i, x << 20 | y) for i, (x, y) in enumerate(zip(parts, parts[1:]))
                if (m := pair.get(x << 20 | y)) is not None]
        heapq.heapify(heap)
        while heap:
            merged, i, was = heapq.heappop(heap)
            j = right[i]
            if live[i] is None or j >= n or live[i] << 20 | live[j] != was:
                continue  # one of the two has changed since
            live[i], live[j] = merged & _ID, None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (m := pair.get(key := live[x] << 20 | live[y])) is not None:
                    heapq.heappush(heap, (m, x, key))
        return [p for p in live if p is not None]

    # ---- whole texts ----------------------------------------------------
    def _learn(self, chunks: list[str]) -> None:
        """Remember ids and tokens (joined by blanks) of chunks without white
        space; the tables are emptied before they outgrow their bound."""
        if len(self._ids) > MEMO or self._held > MEMO_CHARS:
            for table in (self._ids, self._tokens, self._words):
                table.clear()
            self._held = 0
        words, tokens = self._words, self.tokens
        for chunk in set(chunks).difference(self._ids):
            got = []
            for w in self.word.findall(chunk):
                if (ids := words.get(w)) is None:
                    words[w] = ids = self.merge(w)
                got += ids
            self._ids[chunk] = " ".join(map(str, got))
            self._tokens[chunk] = " ".join([tokens[i] for i in got])
            self._held += len(chunk)

    def _plain(self, text: str, ids: list[str], tokens: list[str]) -> None:
        if not text.isascii():
            # code points are lowered one by one, so no final sigma
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        text = text.lower()
        words = _SPACE.split(text) if _ODD_SPACE.search(text) else text.split()
        for at in range(0, len(words), SLICE):
            part = words[at:at + SLICE]
            self._learn(part)
            ids += filter(None, map(self._ids.__getitem__, part))
            tokens += filter(None, map(self._tokens.__getitem__, part))

    def both(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by one blank, and the decoded text."""
        ids: list[str] = []
        tokens: list[str] = []
        at = 0
        for m in self.cut.finditer(text):
            self._plain(text[at:m.start()], ids, tokens)
            ids.append(str(self.special[m[0]]))
            tokens.append(m[0])
            at = m.end()
        self._plain(text[at:] if at else text, ids, tokens)
        return " ".join(ids), " ".join(tokens)

    def encode(self, text: str) -> list[int]:
        ids = self.both(text)[0]
        return [int(x) for x in ids.split(" ")] if ids else []

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one blank, special ones included; the file names no
        decoder."""
        return " ".join(self.tokens[i] for i in ids)


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 and, when
    ``with_ids``, the ids and the decoded text themselves.  ``path`` must be
    readable on every executor."""
    added = [("n_tokens", "long"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    if with_ids:
        added += [("ids", "array<int>"), ("decoded", "string")]

    def fn(texts: list[str]) -> list:
        bpe = load(path)
        out: list[list] = [[] for _ in added]
        for text in texts:
            ids, decoded = bpe.both(text)
            row = [ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                   hashlib.sha256(decoded.encode()).hexdigest()]
            if with_ids:
                row += [[int(x) for x in ids.split(" ")] if ids else [], decoded]
            for column, value in zip(out, row):
                column.append(value)
        return out
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # the bounded chunk table stays with the worker for its next task
    return with_columns_from_text(docs, lambda: (fn, lambda: None), added).drop("text")
