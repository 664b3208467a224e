"""Fill-in-middle over seekable frames: round trips, seeks and defined results."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from indexkit.llm import fill_middle
from indexkit.llm.frames import Frames

DOCS = "doc_id long, text string"
ODD = [(1, None), (2, ""), (3, "\n"), (4, "one line"), (5, "a\nb\nc"), (6, "a\nb\nc\n"), (7, "has <S> inside\nx\n"),
       (8, "<P\n><\nS>\n<M\n"), (9, "é🎉\n" * 3000), (10, "\n\n\n\n"), (10, "\n\n\n\n"), (None, "no id\nat all\n"),
       (11, "x" * 200_000 + "\n" + "y\n" * 50_000), (12, "tail without end\nz" * 9)]


def expected(doc_id, text, seed=7):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(digest[8 * k:8 * k + 8], 16) for k in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, n, "plain", None, None, text
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h4 % 100 < 50:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("frame_chars", [1, 7, 1000, 1 << 16])
def test_frames_seek_and_splice(frame_chars):
    rng = random.Random(frame_chars)
    for _ in range(30):
        text = "".join(rng.choice("ab\n é🎉") for _ in range(rng.randint(0, 60)))
        f = Frames.of(text, frame_chars)
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        assert b"".join(f.stream()).decode() == text and f.n_chars == len(text) and f.n_ends == text.count("\n")
        for k in range(len(units) + 1):
            assert f.after_units(k) == len("".join(units[:k]))
        lo, hi = sorted((rng.randint(0, len(text)), rng.randint(0, len(text))))
        part = Frames().append(f, lo, hi)
        assert b"".join(part.stream()).decode() == text[lo:hi]
        assert part.n_chars == hi - lo and part.n_ends == text[lo:hi].count("\n")


def test_only_the_cut_frame_is_decompressed(monkeypatch):
    f = Frames.of("line\n" * 10_000, 500)
    read = []
    piece = Frames.piece
    monkeypatch.setattr(Frames, "piece", lambda self, k: read.append(k) or piece(self, k))
    assert f.after_units(7_777) == 5 * 7_777
    assert len(read) == 1
    whole = Frames().append(f, 1_250, 30_000)
    assert len(read) == 2 and sum(x in f.data for x in whole.data) == len(whole.data) - 1


@pytest.mark.parametrize("frame_chars", [1, 5, 1 << 16])
def test_marks_across_frames(frame_chars):
    text = "<P\n><\nS>\n<M\n"
    f = Frames.of(text, frame_chars)
    for form in ("psm", "spm"):
        for low in range(5):
            for high in range(low, 5):
                out, _, _ = fill_middle.splice(f, form, low, high)
                assert b"".join(fill_middle.restore(out, form).stream()).decode() == text


@pytest.mark.parametrize("frame_chars", [64, 1 << 16])
def test_operator_equals_brute_force(spark, frame_chars):
    df = spark.createDataFrame([r for r in ODD if len(r[1] or "") < 20_000 or frame_chars > 64], DOCS).repartition(3)
    made = fill_middle.transform(fill_middle.plan(fill_middle.store(df, frame_chars=frame_chars)))
    got = sorted([tuple(r) for r in fill_middle.digests(made).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256").collect()], key=repr)
    want = sorted([(*e[:5], sha(e[5]), sha(r[1] or "")) for r in df.collect() for e in [expected(*r)]], key=repr)
    assert got == want
    outputs = sorted([(r.doc_id, r.output) for r in fill_middle.texts(made).collect()], key=repr)
    assert outputs == sorted([(r[0], expected(*r)[5]) for r in df.collect()], key=repr)


def test_rate_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame(ODD, DOCS).withColumn("frames", F.lit("x")).withColumn("lang", F.lit("en"))
    out = fill_middle.digests(fill_middle.transform(fill_middle.plan(fill_middle.store(df), rate=0)))
    assert {r.form for r in out.collect()} == {"plain"} and "lang" in out.columns
    none = spark.createDataFrame([], DOCS)
    assert fill_middle.digests(fill_middle.transform(fill_middle.plan(fill_middle.store(none)))).count() == 0
