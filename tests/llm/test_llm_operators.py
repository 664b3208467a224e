"""Training-data operators on Spark: brute force, edge cases, defined results."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from indexkit.llm import bpe, chat_format, components, context_mixing, exact_dedup, kneser_ney, language_id, m_tree, \
    ngram_join, packing, queries, url_rules
from indexkit.llm.common import without_keys

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls in every column, empty and blank texts, repeated rows, clashing ids.
ODD = [(1, None, "en", "a", 0), (2, "", None, None, None), (3, " \t\n", "en", "a", 3), (4, "Alpha  beta\n", "en", "b", 12),
       (5, "alpha beta", "de", "b", 10), (6, "Alpha beta", "en", None, 10), (6, "Alpha beta", "en", None, 10),
       (None, "gamma 12 !", "fr", "c", 10), (8, "123 !!", "en", "c", 6), (9, "word " * 5000, "en", "c", 25000),
       (7, "Alphabeta", "en", "b", 9)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def clash(odd):
    """Extra columns named like those the operators add or use."""
    return odd.selectExpr("*", "1 AS kept", "'x' AS digest", "2 AS lang_pred", "3 AS perplexity", "4 AS cls",
                          "5 AS mark", "6 AS rid", "7 AS size", "8 AS cluster", "9 AS __hit")


def rows(df):
    return [tuple(r) for r in df.collect()]


# ---- exact dedup
def _dedup_expected(data):
    norm = {k: re.sub(r"[\x20\x09-\x0D]", "", t or "") for k, (_, t, *_) in enumerate(data)}
    groups = defaultdict(list)
    for k, t in norm.items():
        groups[t].append(k)
    out = []
    for t, ks in groups.items():
        best = min(ks, key=lambda k: (-len(data[k][1] or ""), data[k][0] is None, data[k][0] or 0, k))
        out += [(data[k][0], data[best][0], len(ks), k == best, hashlib.sha256(t.encode()).hexdigest()) for k in ks]
    return out


def test_exact_dedup_equals_brute_force(spark, odd, none, clash):
    for df in (odd, clash):
        got = rows(exact_dedup.deduplicate(df, exact_dedup.stable_half(F.col("doc_id")), shard_keys=3))
        want = _dedup_expected(ODD)
        key = lambda r: tuple(map(str, r[:3] + r[4:]))
        assert sorted(map(key, got)) == sorted(map(key, want))
        for _, g in defaultdict(list, {h: [r for r in got if r[4] == h] for h in {r[4] for r in got}}).items():
            assert sum(r[3] for r in g) == 1
    assert rows(exact_dedup.deduplicate(none, F.lit(True))) == []


def test_dedup_keeps_one_row_and_every_column(clash, none):
    kept = exact_dedup.deduplicate_rows(clash)
    assert kept.columns == clash.columns
    want = Counter(r[4] for r in _dedup_expected(ODD) if r[3])
    got = Counter(hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest() for t, in rows(kept.select("text")))
    assert got == want
    assert exact_dedup.deduplicate_rows(none).count() == 0


def test_a_failing_byte_check_splits_the_bucket(spark):
    docs = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "doc_id long, text string")
    result = exact_dedup.deduplicate(docs, F.lit(False)).withColumn("row_id", F.lit(0).cast("long"))
    bad = docs.filter("doc_id = 1").select(F.unhex(F.sha2("text", 256)).alias("digest"))
    again = exact_dedup._split(docs, bad, result)
    assert sorted(r[:4] for r in rows(again)) == [(1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True)]


def test_without_keys_is_a_null_safe_anti_join(spark):
    left = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    assert sorted(map(str, rows(without_keys(left, spark.createDataFrame([(2,), (None,)], "k int"), ["k"])))) == ["(1,)"]
    assert without_keys(left, left.limit(0), ["k"]).count() == 4


# ---- BPE
def test_bpe_query_equals_the_library(spark, odd, none, clash):
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = rows(bpe.encode_documents(clash, path, with_ids=True))
    assert len(got) == len(ODD)
    for (i, t, *_), (doc, n, ids_hash, text_hash, ids, decoded) in zip(ODD, got):
        want = tok.encode(t or "", add_special_tokens=False).ids
        assert (doc, n, list(ids)) == (i, len(want), want)
        assert ids_hash == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert text_hash == hashlib.sha256(tok.decode(want, skip_special_tokens=False).encode()).hexdigest()
        assert decoded == tok.decode(want, skip_special_tokens=False)
    assert bpe.encode_documents(none, path).count() == 0


# ---- top-k search
def test_top_k_equals_brute_force(spark):
    rng = random.Random(0)
    vecs = [(k, [rng.uniform(-1, 1) for _ in range(5)]) for k in range(0, 450, 3)]
    vecs += [(500, vecs[0][1]), (600, vecs[0][1]), (600, vecs[0][1]), (None, vecs[1][1]), (700, None), (800, [1.0, None, 0.0, 0.0, 0.0]),
             (900, [float("nan")] * 5), (1000, [float("inf")] * 5), (1100, [1.0, 2.0])]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>").withColumn("shard", F.lit(1))
    got = rows(m_tree.top_k(df, df.filter("vec_id % 100 = 0"), 10, shard_rows=40))
    ok = [(i, [math.floor(1024 * x) for x in v]) for i, v in vecs if v and all(x is not None and math.isfinite(x) for x in v)]
    want = set()
    for q, v in {(i, tuple(v)) for i, v in ok if i is not None and i % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for i, w in ok if i != q and len(w) == len(v))
        want |= {(q, r, s[3], -s[0]) for r, s in enumerate(scored[:10], 1)}
    assert set(got) == want
    assert m_tree.top_k(df.limit(0), df.limit(0)).count() == 0


# ---- packing
def test_packing_is_whole_and_without_conflicts(spark, odd, none, clash):
    assert packing.pack(packing.packable(none)).count() == 0
    got = packing.pack(packing.packable(clash), window=100, shard_items=8).collect()
    size = Counter()
    for r in got:
        size[(r.doc_id, r.cluster)] += r.n_tokens
    want = Counter()
    for i, c, n in rows(packing.packable(odd).select("doc_id", F.col("cluster").cast("string"), "size")):
        want[(i, c)] += n
    assert size == want
    bins = defaultdict(list)
    for r in got:
        bins[r.bin_id].append(r)
    for held in bins.values():
        held.sort(key=lambda r: r.bin_offset)
        assert held[0].bin_offset == 0 and held[-1].bin_offset + held[-1].n_tokens <= 100
        assert all(a.bin_offset + a.n_tokens == b.bin_offset for a, b in zip(held, held[1:]))
        assert len({r.source for r in held}) == len(held) == len({r.cluster for r in held})


# ---- chat
def test_chat_digests_equal_brute_force(spark):
    data = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST]"), (1, None, None, None), (None, 0, "tool", "[END]\\"),
            (2, 0, "assistant", ""), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"), (3, 5, "assistant", "é" * 9000)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit(1))
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = {r[0]: r[1:5] for r in rows(chat_format.conversation_digests(df, path))}
    for conv in (1, None, 2, 3):
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in data if c == conv))
        said = "".join(x for *_, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[conv] == (len(turns), sha("".join(f"{r}\n{x}\n" for *_, r, x in turns)), len(said), sha(said))
    assert chat_format.conversation_digests(df.limit(0), path).count() == 0


# ---- url rules
URLS = [("http://a.COM/x", "a.com", "/x", "com/", "allow"), ("https://example.com/en/1", "example.com", "/en/1", "example.com/en/", "block"),
        ("https://www.example.com/en/1?q#f", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://b.net/es/", "b.net", "/es/", "net/es/", "block"), ("http://b.net/de/", "b.net", "/de/", None, "allow"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), (None, "", "", None, "allow"),
        ("no scheme/com/", "", "", None, "allow"), ("x://É.Net/fr/", "É.net", "/fr/", "net/fr/", "block"),
        ("http://com", "com", "", None, "allow"), ("http://a.org?x=http://b.net/es/", "a.org", "", None, "allow")]


def test_listed_rules_and_parsing(spark):
    pages = spark.createDataFrame([(k, u[0], "host") for k, u in enumerate(URLS)], "page_id long, url string, tokens string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted(rows(url_rules.judge(pages, labels).select("page_id", "host", "path", "rule", "verdict")))
    assert got == [(k, *u[1:]) for k, u in enumerate(URLS)]
    assert url_rules.judge(pages.limit(0), labels).count() == 0


def test_mined_rules_block_what_the_labels_show(spark):
    urls = [(k, f"https://spam-{k % 3}.org/win/{k}" if k % 2 else f"https://good.org/en/{k}") for k in range(400)] + [(401, None)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(k, 1 - k % 2, 0) for k in range(200)] + [(7, None, None), (None, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.verdict, r.confidence) for r in url_rules.judge(pages, labels).collect()}
    assert all(got[k][0] == ("block" if k % 2 else "allow") for k in range(400))
    assert got[401] == ("allow", None)
    index = url_rules.inverted_index([{"tokens": frozenset("ab"), "confidence": 1.0}, {"tokens": frozenset("ac"), "confidence": 1.0}])
    assert sorted(index) == ["b", "c"]


# ---- LM scoring
def test_lm_base_equals_brute_force(spark, odd, none, clash, monkeypatch):
    monkeypatch.setattr(context_mixing, "DICTIONARY", 2)
    held = F.coalesce(F.col("doc_id") == 5, F.lit(False))
    got = context_mixing.score(clash, held).collect()
    tok = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    c = Counter(w for i, t, *_ in ODD if i != 5 for w in tok(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), i == 5, len(tok(t)), sum(c[w] > 0 for w in tok(t)), n,
                   round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in tok(t)), 6)) for i, t, *_ in ODD)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert context_mixing.score(none, held).count() == 0
    untrained = context_mixing.score(odd, F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score < 0 for r in untrained)


def test_gathered_table_equals_one_pass_over_all_texts(spark):
    texts = [f"alpha beta w{k % 17} gamma alpha" for k in range(200)]
    words, weights = [b"alpha", b"beta", b"gamma"], np.array([400, 200, 200, 200, 200])
    mixer = context_mixing.Mixer(words, np.array([400, 200, 200]), weights, None)
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    got = context_mixing.collected(context_mixing.context_counts(docs, mixer), context_mixing.TABLE_BITS)
    ids, lengths, _ = context_mixing._laid(mixer.ready(), texts)
    counts = np.zeros((1 << context_mixing.TABLE_BITS, 2), dtype=np.int32)
    mixer.count(ids, lengths, counts)
    want = context_mixing.predictors(counts[:, 0], counts[:, 1])
    assert (got == want).all() and (got[:, 1] > 0).sum() > 20


# ---- language id
def test_language_id_on_held_out_documents(spark, none, clash):
    sf = "/root/testdata/sf0.01"
    got = queries.op10_language_crf(spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = got.filter("held_out").join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"),
                                                           F.max("score")).first()
    assert held[0] > 0.97 and held[1] >= 0 and held[2] <= 1
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs, F.lit(True))
    odd_result = {str(r.doc_id) + (r.text or "")[:3]: (r.lang_pred, r.lang_score) for r in language_id.predict(clash, model).collect()}
    assert odd_result["1"] == odd_result["2"] == odd_result["8123"] == ("und", 0.0) and odd_result["9wor"][0] != "und"
    assert language_id.predict(none, model).count() == 0
    empty = language_id.fit(none, F.lit(True))
    assert {r.lang_pred for r in language_id.predict(clash, empty).collect()} == {"und"}


# ---- Kneser-Ney
def test_every_language_has_a_place_in_the_tree():
    langs = [f"l{k:04}" for k in range(1500)]
    tree = language_id.fields(langs)
    assert sorted(s[0] for states in tree for s in states if len(s) == 1) == langs
    assert [l for s in tree[0] for l in s] == langs and max(map(len, tree)) <= language_id.FAN
    inner = [s for states in tree for s in states if len(s) > 1]
    assert sorted(inner) == sorted([l for s in states for l in s] for states in tree[1:])
    assert language_id.fields([]) == [[]] and language_id.fields(["a"]) == [[["a"]]]


def test_language_sample_breaks_ties_and_reaches_late_passages(spark):
    data = [(None, f"gleich wort{k}", "de") for k in range(400)] + [(1, "same row", "en")] * 400
    data += [(k, "early " * 2000 + "late " * 2000, "fr") for k in range(3)]
    got = rows(language_id.sample(spark.createDataFrame(data, "doc_id long, text string, lang string"), F.lit(True)))
    assert Counter(r[0] for r in got) == {"de": language_id.TRAIN_DOCS, "en": 1, "fr": 3}
    for _, _, _, parts in (r for r in got if r[0] == "fr"):
        assert sum(map(len, parts)) == language_id.TRAIN_CHARS
        assert {"early", "late"} <= {w for part in language_id._span_words(parts) for w in part} <= {"early", "late"}


def test_a_tree_of_fields_tells_all_languages_apart(spark, monkeypatch):
    monkeypatch.setattr(language_id, "FAN", 2)
    letters = ["abcd", "efgh", "ijkl", "mnop", "qrst"]
    def text(k, seed):
        rng = random.Random(seed)
        return " ".join("".join(rng.choices(letters[k], k=4)) for _ in range(40))
    docs = spark.createDataFrame([(k * 20 + i, text(k, k * 20 + i), f"lang{k}") for k in range(5) for i in range(20)],
                                 "doc_id long, text string, lang string")
    tree = language_id.fit(docs, F.lit(True))
    assert len(tree.shared) > 1
    assert language_id.predict(docs, tree).filter("lang = lang_pred AND lang_score > 0.5").count() == 100


def test_kneser_ney_tables_sum_to_one(spark):
    text = spark.createDataFrame([("the cat sat on the mat",), ("the dog sat",), ("",), (None,)], "text string").withColumn("fold", F.lit(0))
    chars = kneser_ney.alphabet(text)
    assert chars[0] == ord("t") or len(chars) > 5
    coder = kneser_ney.Coder(chars)
    counts = {r.gram: r.n for r in kneser_ney.gram_counts(text, coder).collect()}
    want = Counter(int(g) for t, _ in rows(text) for piece in coder.grams(t or "") for g in piece)
    assert counts == dict(want)
    log = kneser_ney.fit(text)[0].log10().reshape(-1, kneser_ney.SYMBOLS)
    assert abs((10.0 ** log.astype("f8")).sum(axis=1) - 1).max() < 1e-3


def test_quality_keeps_clean_and_finds_junk(spark, odd, none, clash):
    sf = "/root/testdata/sf0.01"
    judged = queries.op4_quality_kneser_ney(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    share = {r.quality: r.s for r in judged.groupBy("quality").agg(F.avg(F.col("accepted").cast("int")).alias("s")).collect()}
    assert share[1] > 0.98 and share[0] < 0.6
    labels = spark.createDataFrame([(4, 1, 0), (4, 1, 0), (5, 1, 0), (6, 0, 0), (None, 1, None)], "doc_id long, quality int, toxic int")
    got = kneser_ney.classify(clash, labels)
    assert got.count() == len(ODD) and got.filter("perplexity <= 0 OR perplexity IS NULL").count() == 0
    assert kneser_ney.classify(none, labels).count() == 0
    assert kneser_ney.classify(odd, labels.limit(0)).filter("NOT accepted").count() == 0


# ---- near duplicates
def _near_docs():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]
    out = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([30, 80, 200]))]
        for _ in range(9):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
    out += ["", None, " ", "one two", "One  two\n", "one two three", "a b c d e", "a b c d e"]
    return [(k * 7 % 1000, t) for k, t in enumerate(out)]


def _near_expected(data):
    sets, classes = [], defaultdict(list)
    for i, t in data:
        w = (t or "").lower().split()
        n = min(5, len(w))
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else frozenset())
        classes[sets[-1]].append(i)
    keys = list(classes)
    parent = {k: k for k in keys}

    def root(k):
        while parent[k] is not k:
            k = parent[k]
        return k
    linked = defaultdict(list)
    for x, a in enumerate(keys):
        for b in keys[x + 1:]:
            both = len(a & b)
            if 5 * both >= 4 * (len(a) + len(b) - both) and both:
                linked[a].append(b)
                linked[b].append(a)
                parent[root(a)] = root(b)
    head = defaultdict(list)
    for k in keys:
        head[root(k)] += classes[k]
    return sorted((i, min(head[root(s)]), min(classes[s]), sum(len(classes[b]) for b in linked[s]) + len(classes[s]) - 1,
                   len(linked[s])) for (i, _), s in zip(data, sets))


@pytest.mark.parametrize("block", [512, 2])
def test_near_duplicates_equal_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    data = _near_docs()
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("cls", F.lit(1)).withColumn("root", F.lit(1))
    assert sorted(rows(ngram_join.join(docs))) == _near_expected(data)


def test_near_duplicate_stage_keeps_the_least_id(spark, none, clash):
    data = _near_docs()
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("kept", F.lit(1))
    kept = ngram_join.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r[1] for r in _near_expected(data)})
    assert ngram_join.drop_near_duplicates(none).count() == 0
    assert ngram_join.drop_near_duplicates(clash).columns == clash.columns


def test_near_duplicate_stage_tells_rows_apart_by_id_and_text(spark):
    def text(seed):
        return " ".join(random.Random(seed).choices([f"w{i}" for i in range(500)], k=60))

    data = [(1, text(1)), (None, text(1) + " x"),  # a null id in another head's class
            (None, text(2)), (None, text(3)), (None, text(3) + " x"),  # unique; a class without an id
            (5, text(5)), (6, text(5) + " x"), (6, text(6)),  # an id on a dropped and on a unique text
            (7, text(7)), (7, text(7) + " x"), (8, text(8)), (8, text(8)),  # near copies and a repeated row of one id
            (9, text(9)), (10, text(9) + " x"), (9, text(10)), (3, text(10) + " x")]  # an id that is head and dropped
    got = rows(ngram_join.drop_near_duplicates(spark.createDataFrame(data, "doc_id long, text string")))
    for whole in ([(1, text(1))], [(None, text(2))], [(5, text(5))], [(6, text(6))], [(8, text(8))], [(9, text(9))], [(3, text(10) + " x")]):
        assert [r for r in got if r in whole] == whole
    assert len([r for r in got if r[1].startswith(text(3))]) == len([r for r in got if r[0] == 7]) == 1
    assert len(got) == 9


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    df = spark.createDataFrame([(str(a), str(b)) for a, b in edges], "a string, b string")
    groups = defaultdict(set)
    for node, root in rows(components.components(df)):
        groups[root].add(int(node))
    assert sorted(map(sorted, groups.values())) == [list(range(41)), list(range(100, 140)), [200, 201, 202]]


def test_crc_split_matches_zlib(spark):
    from indexkit.llm.common import crc_mod
    df = spark.createDataFrame([(k,) for k in range(50)], "doc_id long").select("doc_id", crc_mod(F.col("doc_id"), 7).alias("m"))
    assert all(m == zlib.crc32(str(i).encode()) % 7 for i, m in rows(df))


# ---- rows that differ only in white space, and slices
def test_dedup_stage_keeps_the_ranked_row_in_any_order(spark):
    data = [(1, "ab", "en", "x", 2), (1, "a b   ", "en", "y", 6), (1, "a  b  ", "en", "z", 6), (2, "a b   ", "en", "w", 6)]
    found = set()
    for order in ([0, 1, 2, 3], [3, 2, 1, 0], [1, 0, 3, 2], [2, 3, 0, 1]):
        for n in (1, 4):
            df = spark.createDataFrame([data[k] for k in order], DOCS).repartition(n)
            found.add(tuple(rows(exact_dedup.deduplicate_rows(df))))
    assert len(found) == 1
    (kept,), = found
    assert kept[0] == 1 and len(kept[1]) == 6


def test_words_are_cut_only_at_white_space():
    for gap in ("\x01", "\x1f", "\x00"):
        text = "b" * 4_000_000 + gap + "c d"
        assert [w for part in context_mixing.pieces(text) for w in part] == text.encode().split()


def test_text_slices_hold_every_row(spark, monkeypatch):
    import pyarrow as pa

    from indexkit.llm import common
    monkeypatch.setattr(common, "_TEXT_BYTES", 10)
    texts = ["a" * 4, None, "", "b" * 30, "é" * 5, "c", "d"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["i", "t"])
    parts = list(common.text_slices([batch, batch.slice(0, 0)], 1))
    assert [t for _, ts in parts for t in ts] == [t or "" for t in texts]
    assert [i for b, _ in parts for i in b.column(0).to_pylist()] == list(range(7)) and len(parts) > 3
