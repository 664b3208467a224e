"""Cross-tokenizer alignment against a plain implementation."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from indexkit.llm import queries, token_alignment
from indexkit.llm.bpe import byte_symbols

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"
ODD = [(1, None), (2, ""), (3, " "), (4, "  two  blanks "), (5, "a\n\n b\tc\r\n"), (6, "naïve — “quoted” 日本語 text 🎉🎉"),
       (7, "has ▁ mark"), (8, "<|endoftext|> </s> <unk><0x41>"), (9, "x" * 5000 + " " + "word " * 3000),
       (10, "the cat the cat"), (10, "the cat the cat"), (None, "the dog"), (11, " nbsp em \x1c odd \x85 space"),
       (12, "hello"), (13, " lead"), (14, "trail "), (15, "é combining")]


def plain(data):
    """Whole texts, one token pair after another; no chunks, no blocks."""
    import sentencepiece
    from tokenizers import Tokenizer
    a, b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    value = {c: k for k, c in enumerate(byte_symbols())}
    seen, made = Counter(), []
    for doc_id, text in data:
        spans, groups, ids = [[], []], [], [[], []]
        if text:
            whole = (" " + text).encode()
            ids = [a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)]
            parts = [[bytes(value[c] for c in a.id_to_token(i)) for i in ids[0]],
                     [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                      for i in ids[1] for p in [b.id_to_piece(i)]]]
            if b"".join(parts[0]) != whole or b"".join(parts[1]) != whole:
                ids, parts = [[], []], [[], []]
            for side in (0, 1):
                at = 0
                for p in parts[side]:
                    spans[side].append((at, at + len(p)))
                    at += len(p)
        ends = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        at = [0, 0]
        for end in ends:
            sides = []
            for k in (0, 1):
                lo = at[k]
                while at[k] < len(spans[k]) and spans[k][at[k]][1] <= end:
                    at[k] += 1
                sides.append(",".join(map(str, ids[k][lo:at[k]])))
            groups.append("|".join(sides))
        links, j0 = [], 0
        for i, (s, e) in zip(ids[0], spans[0]):
            while j0 < len(spans[1]) and spans[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][0] < e:
                links.append((i, ids[1][j]))
                j += 1
        seen.update(set(links))
        made.append((doc_id, len(ids[0]), len(ids[1]), groups, links))
    best = Counter()
    for (x, _), n in seen.items():
        best[x] = max(best[x], n)
    return Counter((d, na, nb, len(g), len(ls), sum(seen[x] == best[x[0]] for x in ls), sum(seen[x] for x in ls),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for d, na, nb, g, ls in made)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("block_chars", [1, 40, token_alignment.BLOCK_CHARS])
def test_alignment_equals_plain(spark, block_chars):
    df = spark.createDataFrame(ODD, DOCS).repartition(3)
    assert rows(token_alignment.align(df, A, B, block_chars)) == plain(ODD)


def test_query_equals_plain(spark):
    data = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op11_token_alignment(spark, SF)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows(got) == plain(data)


def test_memo_is_emptied_between_blocks(spark, monkeypatch):
    aligner = token_alignment.Aligner(A, B)
    block = token_alignment._Block(aligner)
    block.add(*zip(*ODD))
    first = block.row(0)
    aligner.clear()
    aligner.learn(["other", "words", "cat"])
    again = token_alignment._Block(aligner)
    again.add(*zip(*ODD))
    second = again.row(0)
    assert [list(x) for x in first[1:9]] == [list(x) for x in second[1:9]]


def test_fast_library_gives_the_named_files_ids():
    import random
    aligner = token_alignment.Aligner(A, B)
    assert aligner.fast is not None
    rng = random.Random(4)
    for _ in range(2000):
        text = "".join(chr(rng.choice([32, 32, 10, 9, 39, rng.randint(0, 127), rng.randint(128, 255), rng.randint(97, 122)])) for _ in range(60))
        assert aligner.fast.encode_ordinary(" " + text) == aligner.a.encode(" " + text, add_special_tokens=False).ids


def test_chunks_aligned_together_or_alone():
    words = ["alpha", "naïve", "x▁y", "don't", "日本語", "\ttab", "end\n", "🎉", "1234,5"]
    one, many = token_alignment.Aligner(A, B), token_alignment.Aligner(A, B)
    many.learn(words)
    for w in words:
        one.learn([w])
    for w in words:
        i, j = one.known[w], many.known[w]
        assert one.groups[i] == many.groups[j] and one.sizes[4 * i:4 * i + 4] == many.sizes[4 * j:4 * j + 4]
        n = one.sizes[4 * i + 3]
        assert one.links[one.ends[i] - n:one.ends[i]] == many.links[many.ends[j] - n:many.ends[j]]


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DOCS)
    assert token_alignment.align(empty, A, B).count() == 0
    clash = spark.createDataFrame(ODD, DOCS).withColumn("block", F.lit(1)).withColumn("links", F.lit("x"))
    assert rows(token_alignment.align(clash, A, B)) == plain(ODD)


def test_groups_rebuild_both_id_lists(spark):
    got = {r.doc_id: r for r in token_alignment.groups(spark.createDataFrame(ODD[:10], DOCS), A, B).collect()}
    import sentencepiece
    ids = sentencepiece.SentencePieceProcessor(model_file=B).encode("the cat the cat")
    assert [x for g in got[10].b_ids for x in g] == ids
    assert len(got[10].a_ids) == len(got[10].b_ids)
    assert got[1].a_ids == [] and got[7].b_ids == []
