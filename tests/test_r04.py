"""Findings of round 4: contexts of whole characters, blocks in bounded row groups,
wide stages that are compiled."""

from __future__ import annotations

import random

import numpy as np
import pytest

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------ F4: contexts of whole characters

def _wide_corpus(seed: int, apart: bool) -> str:
    """Words of three rare characters; the third follows from the first, the
    second from nothing (``apart``: the third follows from nothing too)."""
    rng = random.Random(seed)
    first, second, third = (range(0x4E00 + 100 * k, 0x4E00 + 100 * k + 40) for k in range(3))
    out = []
    for _ in range(60):
        i = rng.randrange(40)
        out.append(chr(first[i]) + chr(rng.choice(second)) + chr(third[rng.randrange(40) if apart else i]))
    return " ".join(out)


@pytest.fixture(scope="module")
def trusted(spark):
    latin = "".join(chr(c) for c in range(33, 127))
    rows = [(latin * 6, 0)] * 20 + [(_wide_corpus(k, False), 0) for k in range(60)] + [("", 0), (None, 0), ("ça \U0001F600 était", 0)]
    return spark.createDataFrame(rows, "text string, fold int")


@pytest.fixture(scope="module")
def model(trusted):
    from indexkit.llm import kneser_ney as KN
    return KN.fit(trusted)[0]


def test_rare_characters_are_predicted_from_three_characters(model):
    usual, junk = _wide_corpus(1000, False), _wide_corpus(1000, True)
    assert len(usual) == len(junk) and model.score(usual)[0] > model.score(junk)[0] + 30


def test_wide_probabilities_sum_to_one(model):
    from indexkit.llm import kneser_ney as KN
    text = _wide_corpus(7, False) + _wide_corpus(8, True) + "é\U0001F600x一"
    log, seen = model.log10(), 0
    for grams, (at, ctx, part, low) in model.coder.pieces(text):
        for i in range(0, len(at), 7):
            every = np.arange(KN.SYMBOLS)
            whole = lambda x: np.full(KN.SYMBOLS, x)
            base = 10.0 ** log[grams[at[i]] // KN.SYMBOLS * KN.SYMBOLS + every].astype("f8")
            p = model.wide.probabilities(whole(ctx[i]), part[i] // KN.SYMBOLS * KN.SYMBOLS + every, whole(low[i]), base)
            assert abs(p.sum() - 1) < 1e-3
            seen += 1
    assert seen > 50


def test_wide_grams_hold_the_characters_before(monkeypatch):
    from indexkit.llm import kneser_ney as KN
    coder = KN.Coder(list(range(33, 33 + 44)) + [0x3B1, 0x3B2])
    text = "!\"α#$%&β\U0001F600"
    want, at, before = [], 0, [None] * 3
    for c in [*text, None]:
        codes = coder.coded(c).tolist() if c else [0]
        lengths = [len(coder.coded(x)) if x else 1 for x in before]
        for k in range(len(codes)):
            beyond = [sum(lengths[3 - j:]) + k > 3 for j in (1, 2, 3)]
            if beyond[2]:
                ctx = 0
                for x in before:
                    ctx = ctx << 21 | (ord(x) + 1 if x else 0)
                part = 0
                for s in codes[:k + 1]:
                    part = part * KN.SYMBOLS + s
                want.append((at + k, ctx, part, 1 + beyond.index(True)))
        at, before = at + len(codes), [*before[1:], c]
    whole = [found for _, found in coder.pieces(text)]
    assert sorted(zip(*(x.tolist() for x in whole[0]))) == sorted(want)
    monkeypatch.setattr(KN, "TAKE_CHARS", 2)
    cut = [t for _, found in coder.pieces(text) if found is not None for t in zip(*(x.tolist() for x in found[1:]))]
    assert sorted(cut) == sorted(t[1:] for t in want)


def test_levels_joined_in_spark_give_what_tasks_give(spark, trusted, monkeypatch):
    from indexkit.llm import kneser_ney as KN
    rows = [(1, _wide_corpus(5, False)), (2, _wide_corpus(6, True)), (2, _wide_corpus(6, True)), (3, "plain"), (4, None), (None, "é\U0001F600")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def scored():
        m = KN.fit(trusted)[0]
        got = KN.with_perplexity(docs, m).collect()
        return m, sorted((r["doc_id"] or 0, r["n_symbols"], round(r["log10_prob"], 6), round(r["perplexity"], 6)) for r in got)
    held, want = scored()
    monkeypatch.setattr(KN, "WIDE_ROWS", 0)
    shared, got = scored()
    assert held.wide and not held.shards and shared.shards and not shared.wide
    assert got == want


# ------------------------------------------------------------ F1: blocks in bounded row groups

def test_blocks_of_a_file_are_not_in_one_row_group(spark, monkeypatch):
    import pyarrow.parquet as pq
    import public_tokenizers
    from indexkit.llm import token_alignment as TA
    files, whole = [], TA.stored
    monkeypatch.setattr(TA, "stored", lambda *a: (lambda d: files.extend(d.inputFiles()) or d)(whole(*a)))
    docs = spark.createDataFrame([(k, f"document number {k} of some words") for k in range(60)], "doc_id long, text string").coalesce(1)
    got = TA.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), 100)
    assert got.count() == 60
    made = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in files]
    assert sum(m.num_rows for m in made) > 10
    assert max(m.row_group(i).num_rows for m in made for i in range(m.num_row_groups)) <= 2


# ------------------------------------------------------------ F2: wide stages are compiled

def test_rebuild_runs_no_method_too_large_to_compile(spark, monkeypatch):
    from indexkit.plans import queries_builds as QB
    key, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(key)

    def landed(*a):
        seen.append(int(spark.conf.get(key)))
        raise RuntimeError("enough")
    monkeypatch.setattr(QB, "_land_oews", landed)
    with pytest.raises(RuntimeError, match="enough"):
        QB.q_rebuild_incremental(spark, SF)
    assert seen == [8000] and spark.conf.get(key) == before
