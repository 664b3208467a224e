r"""Chat formatting by token-level assembly.

Every turn is encoded on its own with a byte-level vocabulary and placed
between reserved ids (one per control string), so no merge can cross a segment
border and a control string in a text can never become a control token.  The
loss mask of a conversation follows from prefix sums of segment lengths.

Template, per turn: the role's opening mark, the text, its closing mark.  Roles
without marks of their own are written as ``[ROLE]role[/ROLE]text[END]``.
Inside roles and texts a backslash is doubled and a backslash is put after the
first character of every control string; ``unescaped`` reverses both.

A formatted conversation is its turn rows in order; ``start`` and ``mask_from``
/ ``mask_to`` are token offsets within the conversation.  A conversation is
never gathered into one value: reading back streams sorted turn rows and holds
one turn and two digest states, so a conversation with a third of all rows
costs one long stream and no memory.

Defined results: a null text or role counts as empty; turns are ordered by
turn (nulls first), then role, then text; repeated rows are repeated turns;
rows with a null conv_id form one conversation; an empty table formats nothing.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Control strings; their reserved ids follow the vocabulary in this order.
CONTROLS = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[END]"]
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER = ("[ROLE]", "[/ROLE]", "[END]")
TRAINED_ROLE = "assistant"
#: Number of ids in the rank file; the first reserved id.
FIRST_RESERVED = 50_256
#: The public split pattern of the rank files.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

_ESCAPE = re.compile(r"\\|" + "|".join(map(re.escape, CONTROLS)))
_UNESCAPE = re.compile(r"\\(\\?)")


def escaped(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescaped(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


class Assembler:
    """Encodes turns to ids and reads ids back."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.enc = tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.mark = {c: FIRST_RESERVED + k for k, c in enumerate(CONTROLS)}
        self.mark_of = {i: c for c, i in self.mark.items()}

    def turn(self, role: str, text: str) -> tuple[np.ndarray, int, int, int]:
        """Ids of one turn, the loss span within it and the number of code
        points of the turn's written form."""
        body = escaped(text)
        if role in MARKS:
            head, tail = [MARKS[role][0]], MARKS[role][1]
            segments = [[self.mark[head[0]]], self.enc.encode_ordinary(body), [self.mark[tail]]]
            chars = len(head[0]) + len(body) + len(tail)
        else:
            name = escaped(role)
            segments = [[self.mark[OTHER[0]]], self.enc.encode_ordinary(name), [self.mark[OTHER[1]]],
                        self.enc.encode_ordinary(body), [self.mark[OTHER[2]]]]
            chars = sum(map(len, OTHER)) + len(name) + len(body)
        ends = np.cumsum([len(s) for s in segments])
        trained = role == TRAINED_ROLE
        return (np.concatenate([np.asarray(s, dtype=np.int32) for s in segments]),
                int(ends[-3]) if trained else 0, int(ends[-2]) if trained else 0, chars)

    def text(self, ids: np.ndarray) -> str:
        return unescaped(self.enc.decode_bytes(ids.tolist()).decode("utf-8"))

    def read(self, ids: np.ndarray) -> tuple[str, str]:
        """Role and text of one turn, from its ids alone."""
        marks = np.flatnonzero(ids >= FIRST_RESERVED)
        first = self.mark_of[int(ids[0])]
        for role, (head, _) in MARKS.items():
            if first == head:
                return role, self.text(ids[1:marks[1]])
        return self.text(ids[1:marks[1]]), self.text(ids[marks[1] + 1:marks[2]])


@lru_cache(maxsize=2)
def load(path: str) -> Assembler:
    return Assembler(path)


def format_turns(turns: DataFrame, path: str) -> DataFrame:
    """Token rows: conversation, turn, role and text (the order), ``ids`` (int32
    bytes), ``n_tokens``, ``mask_from``, ``mask_to`` within the turn, and
    ``chars``.  No shuffle: each turn is assembled where it is read."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asm = load(path)
        for b in batches:
            made = [asm.turn(r or "", t or "") for r, t in zip(b["role"], b["text"])]
            yield pd.DataFrame({
                "no_conv": b["no_conv"], "conv": b["conv"], "no_turn": b["no_turn"], "at": b["at"],
                "role": [r or "" for r in b["role"]], "text": [t or "" for t in b["text"]],
                "ids": [m[0].tobytes() for m in made], "n_tokens": [len(m[0]) for m in made],
                "mask_from": [m[1] for m in made], "mask_to": [m[2] for m in made], "chars": [m[3] for m in made]})
    return turns.select(
        F.col("conv_id").isNull().alias("no_conv"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv"),
        F.col("turn").isNull().alias("no_turn"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("at"),
        "role", "text",
    ).mapInPandas(run, "no_conv boolean, conv long, no_turn boolean, at long, role string, text string, "
                       "ids binary, n_tokens int, mask_from int, mask_to int, chars long")


def with_offsets(rows: DataFrame) -> DataFrame:
    """``start`` of each turn and its loss span within the conversation, by
    prefix sums over the turns before it."""
    w = Window.partitionBy("no_conv", "conv").orderBy(F.desc("no_turn"), "at", "role", "text") \
        .rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_tokens").over(w), F.lit(0))
    return rows.withColumn("start", start).withColumn("mask_from", F.col("start") + F.col("mask_from")) \
        .withColumn("mask_to", F.col("start") + F.col("mask_to"))


def read_back(rows: DataFrame, path: str) -> DataFrame:
    """Digests of each conversation, read from its token rows and mask.
    ``rows`` must hold each conversation sorted within one partition, as
    ``with_offsets`` leaves them; they are streamed."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        asm = load(path)
        now, state = None, None
        for b in batches:
            done = []
            for no_conv, conv, ids, lo, hi, start, chars in zip(
                    b["no_conv"], b["conv"], b["ids"], b["mask_from"], b["mask_to"], b["start"], b["chars"]):
                if now != (no_conv, conv):
                    if now is not None:
                        done.append(_row(now, state))
                    now, state = (no_conv, conv), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = np.frombuffer(ids, dtype=np.int32)
                role, text = asm.read(ids)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if hi > lo:
                    said = asm.text(ids[lo - start:hi - start])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += chars
            yield _frame(done)
        if now is not None:
            yield _frame([_row(now, state)])
    narrow = rows.select("no_conv", "conv", "ids", "mask_from", "mask_to", "start", "chars")
    return narrow.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                   "loss_sha256 string, formatted_chars long")


_COLUMNS = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]


def _row(key: tuple, s: list) -> tuple:
    return (None if key[0] else key[1], s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=_COLUMNS)
    out["conv_id"] = out["conv_id"].astype("Int64")
    return out


def conversation_digests(turns: DataFrame, path: str) -> DataFrame:
    rows = with_offsets(format_turns(turns, path))
    # the window has dealt and sorted the rows by conversation already
    return read_back(rows, path)
