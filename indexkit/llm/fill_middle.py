"""Fill-in-middle transformation over seekable compressed frames.

Method: a text is stored as independent zstandard frames with cumulative
counts of characters and line ends (``frames``).  Two lines are drawn per
document from a hash of its id; the counts name the frames in which they end,
only those are decompressed to find the cuts, and the output is spliced from
whole frames, the cut frames' parts and one small frame per mark.  Digests
stream frames in order, so neither a text nor an output is ever joined in
memory after the first step.

Defined results: a null text counts as empty; an empty text, one that contains
a mark, or one outside the share to transform stays plain (its cuts are null);
a null id is hashed as empty text; repeated rows are transformed alike; an
empty table gives an empty result.  All columns but the text pass through; a
column that has the name of an added one is replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indexkit.llm.common import mapped_rows
from indexkit.llm.frames import FRAME_CHARS, Frames

PREFIX, SUFFIX, MIDDLE = MARKS = ("<P>", "<S>", "<M>")
#: Percent of documents transformed, and of those in suffix-first order.
RATE, SPM_RATE, SEED = 100, 50, 7

_STORED = [("frames", "array<binary>"), ("frame_chars", "array<long>"), ("frame_ends", "array<long>")]


def store(docs: DataFrame, text: str = "text", frame_chars: int = FRAME_CHARS) -> DataFrame:
    """Texts as frames: ``frames``, the running counts ``frame_chars`` and
    ``frame_ends``, ``n`` (lines, the last one with or without its end) and
    ``marked`` (the text contains a mark).  Written as a table, the counts are
    read without the frames."""
    def row(value: str | None) -> tuple:
        value = value or ""
        f = Frames.of(value, frame_chars)
        return (f.data, f.chars, f.ends, f.n_ends + bool(value and not value.endswith("\n")),
                any(m in value for m in MARKS))
    return mapped_rows(docs, [text], [text], [*_STORED, ("n", "long"), ("marked", "boolean")], row,
                   lambda r: sum(map(len, r[0])) + 200)


def _draws(doc_id: Column, seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def plan(stored: DataFrame, rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED) -> DataFrame:
    """``form`` and the two cuts in lines, ``cut_low`` and ``cut_high``, from the
    counts alone."""
    h1, h2, h3, h4 = _draws(F.col("doc_id"), seed)
    plain = (F.col("n") == 0) | F.col("marked") | (h3 % 100 >= rate)
    first, second = h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)
    return stored.withColumns({
        "form": F.when(plain, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm"),
        "cut_low": F.when(~plain, F.least(first, second)),
        "cut_high": F.when(~plain, F.greatest(first, second))})


def splice(text: Frames, form: str, low: int, high: int) -> tuple[Frames, int, int]:
    """The output of one document, its prefix's and its middle's characters."""
    p, q = text.after_units(low), text.after_units(high)
    mark = {m: Frames.of(m) for m in MARKS}
    out = Frames()
    if form == "psm":
        out.append(mark[PREFIX]).append(text, 0, p).append(mark[SUFFIX]).append(text, q)
    else:
        out.append(mark[SUFFIX]).append(text, q).append(mark[PREFIX]).append(text, 0, p)
    return out.append(mark[MIDDLE]).append(text, p, q), p, q - p


def restore(out: Frames, form: str) -> Frames:
    """The text rebuilt from an output and its form: the marks are searched in
    one pass, then the three parts are spliced in their order."""
    if form == "plain":
        return out
    if form == "psm":
        _, s, m = out.find([PREFIX, SUFFIX, MIDDLE])
        prefix, suffix = (len(PREFIX), s), (s + len(SUFFIX), m)
    else:
        _, p, m = out.find([SUFFIX, PREFIX, MIDDLE])
        suffix, prefix = (len(SUFFIX), p), (p + len(PREFIX), m)
    return Frames().append(out, *prefix).append(out, m + len(MIDDLE)).append(out, *suffix)


def transform(planned: DataFrame) -> DataFrame:
    """Frames of the text replaced by frames of the output; ``prefix_chars`` and
    ``middle_chars`` beside them (null for plain documents)."""
    def row(data: list, chars: list, ends: list, form: str, low: int | None, high: int | None) -> tuple:
        text = Frames(data, chars, ends)
        if form == "plain":
            return text.data, text.chars, text.ends, None, None
        out, p, m = splice(text, form, low, high)
        return out.data, out.chars, out.ends, p, m
    return mapped_rows(planned, [], [n for n, _ in _STORED] + ["form", "cut_low", "cut_high"],
                   [*_STORED, ("prefix_chars", "long"), ("middle_chars", "long")], row,
                   lambda r: sum(map(len, r[0])) + 200)


def sha256(text: Frames) -> str:
    digest = hashlib.sha256()
    for piece in text.stream():
        digest.update(piece)
    return digest.hexdigest()


def digests(transformed: DataFrame) -> DataFrame:
    """``output_sha256`` and ``restored_sha256``, both streamed frame by frame."""
    def row(data: list, chars: list, ends: list, form: str) -> tuple:
        out = Frames(data, chars, ends)
        whole = sha256(out)
        return whole, whole if form == "plain" else sha256(restore(out, form))
    return mapped_rows(transformed, [n for n, _ in _STORED], [n for n, _ in _STORED] + ["form"],
                   [("output_sha256", "string"), ("restored_sha256", "string")], row, lambda r: 300)


def texts(transformed: DataFrame, name: str = "output") -> DataFrame:
    """The outputs as plain strings, for those who want them so."""
    def row(data: list) -> tuple:
        return (b"".join(Frames(data).stream()).decode("utf-8"),)
    return mapped_rows(transformed, [n for n, _ in _STORED], ["frames"], [(name, "string")], row, lambda r: len(r[0]) + 100)
