"""Alignment of two tokenizers' ids over the same text.

Method: the cumulative byte ends of either tokenizer's tokens become a
dictionary from end to index; the hash-set intersection of the two key sets,
sorted, holds the byte offsets where both end a token, and slices both id lists
into groups.  Links, all pairs of tokens whose bytes overlap, are expanded per
slice: the ends of both sides cut it into pieces, and each piece lies in exactly
one token of either side.

Both vocabularies put a blank only in front of a token, so a blank between two
other characters is always such a common offset.  A text is therefore cut
there into chunks, a chunk is tokenised and aligned once (many new chunks in
one go, as one text), and a table of bounded size remembers it; a text's groups
are its chunks' groups in order.

The documents of a task are gathered in blocks.  A block row holds the distinct
chunks' distinct links, in how many of its documents each link occurs, and each
document's chunks with their multiplicity.  Corpus-wide counts are summed over
the blocks' distinct links, and a block gets back one row per distinct link, so
no (document, link) pair is ever shuffled: a link that stands in every document
costs one row a block.  Only the highest count per A id, one row per vocabulary
entry, is broadcast.

Defined results: a text that is null or empty, or whose joined A or B bytes
differ from blank + text, has no tokens (zeros and an empty digest column).  Any
length is aligned whole; repeated rows each get a row and each count as a
document; an empty table gives an empty result.  Only ``doc_id`` and ``text``
are read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from indexkit.llm.bpe import byte_symbols
from indexkit.llm.common import stored

#: Characters of text gathered in a block, and chunks remembered in a task.
BLOCK_CHARS, MEMO = 2_000_000, 400_000
#: Block rows in a row group of the written blocks: a row holds megabytes.
GROUP_BLOCKS = 2
#: Documents gathered in a block, if they are short.
BLOCK_DOCS = 50_000
#: Characters of a text that are cut into chunks at a time.
_SLICE = 1 << 20
#: A link is one integer, A id above B id.
_SHIFT = 20
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Chunks that can share a text, and characters beyond Latin-1.
_PLAIN, _WIDE = re.compile(r"\S(?:.*\S)?", re.DOTALL), re.compile("[^\x00-\xff]")
#: (document, link) pairs told apart at a time.
_PAIRS = 1_000_000
#: Fixed value: the byte-level vocabulary's word pattern.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_BLOCK = ("block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
          "n_links array<long>, digests array<string>, links array<long>, link_docs array<int>, "
          "chunk_links array<int>, chunk_ends array<int>, doc_chunks array<int>, doc_times array<int>, "
          "doc_ends array<int>")
_RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def groups_of(a_ends: Sequence[int], b_ends: Sequence[int]) -> tuple[list[int], list[int]]:
    """How many tokens of either side lie before each offset at which both end,
    from cumulative ends; two neighbours bound a group."""
    a_at, b_at = dict(zip(a_ends, range(1, len(a_ends) + 1))), dict(zip(b_ends, range(1, len(b_ends) + 1)))
    common = sorted(a_at.keys() & b_at.keys())
    return list(map(a_at.__getitem__, common)), list(map(b_at.__getitem__, common))


def links_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs of tokens whose byte ranges overlap, and the end of each overlap."""
    ends = np.union1d(a_ends, b_ends)
    return np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends), ends


class Aligner:
    """Two tokenizers with the byte strings of their tokens, and the chunk table."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has the cores
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        value = {c: b for b, c in enumerate(byte_symbols())}
        special = {t.content for t in self.a.get_added_tokens_decoder().values()}
        tokens = {i: t.encode() if t in special else bytes(value[c] for c in t) for t, i in self.a.get_vocab().items()}
        self.a_bytes = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size()) for p in (self.b.id_to_piece(i),)]
        self.a_len, self.b_len = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.names = list(map(str, range(max(len(self.a_bytes), len(self.b_bytes)))))
        self.fast = self._ranks(path_a, special)
        self.clear()

    def _ranks(self, path_a: str, special: set[str]):
        """The same vocabulary in the faster library, for Latin-1 text (where no two
        Unicode tables differ), if its merges are in the order of their ids."""
        import tiktoken
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if made != sorted(made) or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            return None
        ranks = {self.a_bytes[i]: i for t, i in vocab.items() if t not in special}
        return tiktoken.Encoding("a", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: list[str] = []
        self.sizes = array("q")     # of each chunk: A tokens, B tokens, groups, links; A tokens 0: bytes differ
        self.links = array("q")     # links of all chunks, one after another, a link once for each occurrence
        self.ends = array("q")      # where each chunk's links end

    def _ids(self, text: str) -> tuple[list[int], list[int]]:
        """Ids of blank + text by A and of text by B."""
        a = self.fast.encode_ordinary(" " + text) if self.fast and not _WIDE.search(text) else \
            self.a.encode(" " + text, add_special_tokens=False).ids
        return a, self.b.encode(text)

    def _align(self, chunks: list[str]) -> bool:
        """Add chunks, tokenised and aligned as one text; false (and nothing
        added) if bytes differ somewhere."""
        text = " ".join(chunks)
        a_list, b_list = self._ids(text)
        data = (" " + text).encode()
        if b"".join(map(self.a_bytes.__getitem__, a_list)) != data or b"".join(map(self.b_bytes.__getitem__, b_list)) != data:
            return False
        a, b = np.array(a_list, np.int64), np.array(b_list, np.int64)
        a_ends, b_ends = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        a_cut, b_cut = groups_of(a_ends.tolist(), b_ends.tolist())
        name = self.names.__getitem__
        a_names, b_names = list(map(name, a_list)), list(map(name, b_list))
        made, i, j = [], 0, 0
        for x, y in zip(a_cut, b_cut):
            made.append(f"{a_names[i]}|{b_names[j]}" if x - i == 1 and y - j == 1 else
                        f"{','.join(a_names[i:x])}|{','.join(b_names[j:y])}")
            i, j = x, y
        borders = np.cumsum([1 + len(c) for c in chunks] if text.isascii() else [1 + len(c.encode()) for c in chunks])
        ends = a_ends[np.array(a_cut) - 1]
        li, lj, link_ends = links_of(a_ends, b_ends)
        # every chunk's end is a common end
        counts = [np.searchsorted(e, borders, "right") for e in (a_ends, b_ends, ends, link_ends)]
        group_ends = counts[2].tolist()
        self.groups += [";".join(made[x:y]) for x, y in zip([0, *group_ends], group_ends)]
        self.sizes.frombytes(np.stack([np.diff(c, prepend=0) for c in counts], axis=1).astype(np.int64).tobytes())
        self.ends.frombytes((counts[3] + len(self.links)).astype(np.int64).tobytes())
        self.links.frombytes((a[li] << _SHIFT | b[lj]).tobytes())
        for c in chunks:
            self.known[c] = len(self.known)
        return True

    def _add(self, chunks: list[str]) -> None:
        """Add chunks; the ones whose bytes differ are found by halving."""
        if not self._align(chunks):
            if len(chunks) > 1:
                self._add(chunks[:len(chunks) // 2])
                self._add(chunks[len(chunks) // 2:])
            else:
                self.known[chunks[0]] = len(self.known)
                self.groups.append("")
                self.sizes.extend((0, 0, 0, 0))
                self.ends.append(len(self.links))

    def learn(self, chunks: Iterable[str]) -> None:
        """Align chunks that aren't known.  Chunks stand without the blank before
        them; only those without white space at either end can share a text."""
        narrow, wide = [], []
        for c in set(chunks).difference(self.known):
            if _PLAIN.fullmatch(c):
                (wide if _WIDE.search(c) else narrow).append(c)
            else:
                self._add([c])
        for plain in (narrow, wide):
            for at in range(0, len(plain), 5_000):
                self._add(plain[at:at + 5_000])


@lru_cache(maxsize=1)
def load(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def _chunks(text: str) -> Iterator[list[str]]:
    """The text's chunks, in lists of bounded size."""
    at = 0
    while at < len(text):
        stop = len(text)
        if stop - at > _SLICE:
            border = _CUT.search(text, at + _SLICE)
            stop = border.start() if border else len(text)
        yield _CUT.split(text[at:stop])
        at = stop + 1


class _Block:
    """Documents gathered for one block row."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.chars = aligner, 0
        self.ids: list[int | None] = []
        self.digests: list[str] = []
        self.sizes: list[np.ndarray] = []
        self.chunks: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, ids: Sequence[int | None], texts: Sequence[str | None]) -> None:
        """Add documents; the chunks of short ones are learned together."""
        for lo, hi in _batches(texts):
            part = [t or "" for t in texts[lo:hi]]
            if len(part) > 1:
                split = [_CUT.split(t) for t in part]
                self.aligner.learn(c for chunks in split for c in chunks)
                for doc_id, text, chunks in zip(ids[lo:hi], part, split):
                    self._document(doc_id, text, [chunks], False)
            else:
                self._document(ids[lo], part[0], _chunks(part[0]), True)

    def _document(self, doc_id: int | None, text: str, lists: Iterable[list[str]], learn: bool) -> None:
        al = self.aligner
        self.chars += len(text)
        digest, first, whole = hashlib.sha256(), True, bool(text)
        found: list[np.ndarray] = []
        for chunks in lists if text else ():
            if learn:
                al.learn(chunks)
            numbers = list(map(al.known.__getitem__, chunks))
            digest.update(("" if first else ";").encode() + ";".join(map(al.groups.__getitem__, numbers)).encode())
            first = False
            found.append(np.array(numbers, dtype=np.int64))
        numbers, times = np.unique(np.concatenate(found), return_counts=True) if whole else (np.zeros(0, np.int64),) * 2
        sizes = np.frombuffer(al.sizes, np.int64).reshape(-1, 4)[numbers] if whole else np.zeros((0, 4), np.int64)
        if whole and not sizes[:, 0].all():
            whole, numbers, times, sizes = False, numbers[:0], times[:0], sizes[:0]
        self.ids.append(doc_id)
        self.digests.append(digest.hexdigest() if whole else "")
        self.sizes.append((sizes * times[:, None]).sum(axis=0))
        self.chunks.append(numbers)
        self.times.append(times)

    def row(self, number: int) -> tuple:
        al = self.aligner
        used, local = np.unique(np.concatenate([*self.chunks, np.zeros(0, np.int64)]), return_inverse=True)
        stops = np.frombuffer(al.ends, np.int64)[used] if len(used) else np.zeros(0, np.int64)
        lengths = np.frombuffer(al.sizes, np.int64).reshape(-1, 4)[used, 3] if len(used) else stops
        chunk_ends = np.cumsum(lengths)
        flat = np.frombuffer(al.links, np.int64)[np.arange(int(lengths.sum())) + np.repeat(stops - chunk_ends, lengths)] \
            if len(used) else stops
        links, link_at = np.unique(flat, return_inverse=True)
        # in how many documents a link stands: distinct (document, link) pairs, some documents at a time
        n_docs = np.zeros(len(links), np.int64)
        doc_ends = np.cumsum([len(c) for c in self.chunks])
        expanded = np.concatenate([[0], np.cumsum(lengths[local])])[np.concatenate([[0], doc_ends])]
        lo = 0
        while lo < len(self.ids) and len(links):
            hi = max(lo + 1, int(np.searchsorted(expanded, expanded[lo] + _PAIRS, "right")) - 1)
            c = local[(doc_ends[lo - 1] if lo else 0):doc_ends[hi - 1]]
            n = lengths[c]
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            which = link_at[np.repeat(chunk_ends[c] - n, n) + inner]
            pairs = np.unique(np.repeat(np.arange(hi - lo), np.diff(expanded[lo:hi + 1])) * len(links) + which)
            n_docs += np.bincount(pairs % len(links), minlength=len(links))
            lo = hi
        sizes = np.array(self.sizes, dtype=np.int64).reshape(-1, 4)
        return (number, self.ids, *(sizes[:, k].tolist() for k in range(4)), self.digests, links, n_docs, link_at,
                chunk_ends, local, np.concatenate([*self.times, np.zeros(0, np.int64)]), doc_ends)


def _batches(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Borders of runs of texts of some 300,000 characters; longer texts alone."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > lo and size + n > 300_000:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


def blocks(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Tokenised and aligned documents, one row per block.  Both files must be
    readable on every executor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = load(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        names = [f.split(" ")[0] for f in _BLOCK.split(", ")]
        kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
                 "array<string>": pa.list_(pa.string())}
        types = [kinds[f.split(" ")[1]] for f in _BLOCK.split(", ")]
        held = _Block(aligner)

        def done() -> pa.RecordBatch:
            nonlocal held, number
            row = held.row(number)
            out = pa.RecordBatch.from_arrays([pa.array([v], type=t) for v, t in zip(row, types)], names=names)
            number += 1
            if len(aligner.known) > MEMO:
                aligner.clear()
            held = _Block(aligner)
            return out
        try:
            for batch in batches:
                at = 0
                while at < batch.num_rows:
                    # rows up to the block's end, in slices, so that only some texts are Python strings at a time
                    part = batch.slice(at, 256)
                    ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
                    size, take = held.chars, 0
                    while take < len(ids) and (not take or size < block_chars):
                        size += len(texts[take] or "")
                        take += 1
                    held.add(ids[:take], texts[:take])
                    at += take
                    if held.chars >= block_chars or len(held.ids) >= BLOCK_DOCS:
                        yield done()
            if held.ids:
                yield done()
        finally:
            aligner.clear()  # Python workers outlive tasks
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _BLOCK)


def _scored(key: tuple, block: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """Documents of one block from its row and its links' corpus-wide counts."""
    if not len(block):
        return pd.DataFrame(columns=[f.split(" ")[0] for f in _RESULT.split(", ")])
    b = block.iloc[0]
    n = np.zeros(len(b.links), np.int64)
    best = np.zeros(len(b.links), np.int64)
    n[counts["pos"].to_numpy()] = counts["n"].to_numpy()
    best[counts["pos"].to_numpy()] = counts["best"].to_numpy()
    starts = np.concatenate([[0], np.asarray(b.chunk_ends)]).astype(np.int64)

    def per_doc(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(values[np.asarray(b.chunk_links, dtype=np.int64)])])
        per_chunk = sums[starts[1:]] - sums[starts[:-1]]
        run = np.concatenate([[0], np.cumsum(per_chunk[np.asarray(b.doc_chunks, dtype=np.int64)] * np.asarray(b.doc_times))])
        ends = np.concatenate([[0], np.asarray(b.doc_ends)]).astype(np.int64)
        return run[ends[1:]] - run[ends[:-1]]
    return pd.DataFrame({"doc_id": pd.array(b.doc_ids, dtype="Int64"), "n_a": b.n_a, "n_b": b.n_b, "n_groups": b.n_groups,
                         "n_links": b.n_links, "n_best": per_doc(best), "count_sum": per_doc(n),
                         "groups_sha256": b.digests})


def align(docs: DataFrame, path_a: str, path_b: str, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Per document: doc_id, its tokens, groups and links, how many links have
    their A id's highest corpus-wide count (ties included), the sum of the
    links' counts, and the digest of its groups."""
    made = stored(blocks(docs, path_a, path_b, block_chars), "aligned", GROUP_BLOCKS)
    held = made.select("block", F.posexplode(F.arrays_zip("links", "link_docs")).alias("pos", "e")) \
        .select("block", "pos", F.col("e.links").alias("link"), F.col("e.link_docs").alias("docs"))
    counts = held.groupBy("link").agg(F.sum("docs").alias("n"))
    a_id = F.shiftright("link", _SHIFT)
    top = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("most"))
    # one row per entry of vocabulary A at most
    scored = counts.withColumn("a", a_id).join(F.broadcast(top), "a") \
        .select("link", "n", (F.col("n") == F.col("most")).cast("int").alias("best"))
    back = held.select("block", "pos", "link").join(scored, "link") \
        .select(F.col("block").alias("of"), "pos", "n", "best")
    return made.groupBy("block").cogroup(back.groupBy("of")).applyInPandas(_scored, _RESULT)


def groups(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """The groups themselves: doc_id, a_ids, b_ids per document in text order
    (arrays of arrays); documents without tokens get empty arrays."""
    def of(aligner: Aligner, text: str) -> tuple[list, list]:
        a_ids, b_ids = [], []
        for chunks in _chunks(text):
            aligner.learn(chunks)
            for k in map(aligner.known.__getitem__, chunks):
                if not aligner.sizes[4 * k]:
                    return [], []
                for group in aligner.groups[k].split(";"):
                    a, b = group.split("|")
                    a_ids.append([int(x) for x in a.split(",")])
                    b_ids.append([int(x) for x in b.split(",")])
        return a_ids, b_ids

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        aligner = load(path_a, path_b)
        for batch in batches:
            made = [of(aligner, text or "") for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "a_ids": [a for a, _ in made], "b_ids": [b for _, b in made]})
            if len(aligner.known) > MEMO:
                aligner.clear()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text") \
        .mapInPandas(run, "doc_id long, a_ids array<array<int>>, b_ids array<array<int>>")
