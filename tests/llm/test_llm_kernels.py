"""Numpy and Python kernels of the training-data operators, without Spark."""

import itertools
import math
import random

import numpy as np
import pandas as pd
import public_tokenizers
import pytest

from indexkit.llm import bpe, chat_format, context_mixing, crf, fuse_filter, kneser_ney, language_id, m_tree, ngram_join, packing


# ---- binary-fuse filter
@pytest.mark.parametrize("n", [0, 1, 2, 7, 100, 5000])
def test_fuse_filter_has_no_false_negative(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(0, 2 ** 64, n, dtype=np.uint64)
    blob = fuse_filter.build(np.concatenate([keys, keys[:3]]))
    assert fuse_filter.contains(blob, keys).all()
    other = rng.integers(0, 2 ** 64, 20_000, dtype=np.uint64)
    assert fuse_filter.contains(blob, other).mean() < 0.02


# ---- BPE
@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_equals_the_library(tokenizer):
    own = bpe.Bpe(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(5)
    pool = "abcdefgh ABC\t\n'sdtm.,!  123ΣσÀéßñü\x1c\x85\u200b日本語İ\u0301e\U0001f600"
    texts = ["", " \n", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>", "<|endoftext|", "I'LL don't WE'RE",
             "ab" * 3000, "thing" * 500 + "x!" * 400, "é" * 999]
    texts += ["".join(rng.choice(pool) for _ in range(rng.randrange(80))) for _ in range(3000)]
    for text in texts:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert own.encode(text) == want
        assert own.both(text)[1] == tokenizer.decode(want, skip_special_tokens=False) == own.decode(want)


def test_bpe_heap_and_scan_merge_alike(monkeypatch):
    own = bpe.Bpe(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(1)
    words = ["".join(rng.choice("aeinrsth") for _ in range(n)) for n in range(1, 120)]
    scanned = [own.merge(w) for w in words]
    monkeypatch.setattr(bpe, "SCAN_PARTS", 0)
    assert [own.merge(w) for w in words] == scanned


# ---- chat
def test_escape_is_reversible_and_hides_controls():
    rng = random.Random(3)
    bits = [*chat_format.CONTROLS, "\\", "<", "/s>", "[", "INST]", "x", "<\\", "é"]
    for _ in range(3000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(9)))
        hidden = chat_format.escaped(text)
        assert chat_format.unescaped(hidden) == text
        assert not any(c in hidden for c in chat_format.CONTROLS)


def test_turns_round_trip_and_mask_spans():
    asm = chat_format.load(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    for role, text in itertools.product(["user", "assistant", "system", "", "to[END]ol", "[INST]"],
                                        ["", "hi", "</s>[INST] ok [/INST]", "\\", "é\U0001f600\n" * 50]):
        ids, lo, hi, _ = asm.turn(role, text)
        assert asm.read(ids) == (role, text)
        assert (asm.text(ids[lo:hi]) if role == "assistant" else "") == (text if role == "assistant" else "")
        assert (hi > lo) == (role == "assistant" and text != "")


# ---- M-tree
@pytest.mark.parametrize("seed", range(4))
def test_m_tree_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    x = np.floor(1024 * rng.normal(size=(900, 6)) * rng.choice([0.01, 1.0], size=(900, 1)))
    x[100:400] = x[0]          # a hot vector: ties go to the smaller id
    ids = rng.permutation(900)
    tree = m_tree.MTree(ids, x, page=16)
    for q_id in (0, 5, 899):
        q = x[np.flatnonzero(ids == q_id)[0]] if q_id else -x[0]
        got_ids, got = tree.search(q_id, q, 10)
        score = x @ q
        want = sorted(((-s, i) for s, i in zip(score, ids) if i != q_id))[:10]
        assert [(-s, i) for s, i in zip(got, got_ids)] == want


def test_m_tree_prunes_clustered_vectors():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 8)) * 5
    x = np.floor(1024 * (centres[rng.integers(20, size=4000)] + 0.01 * rng.normal(size=(4000, 8))))
    tree = m_tree.MTree(np.arange(4000), x)
    tree.search(-1, x[7], 10)
    assert tree.computed < 2000


def test_m_tree_holds_huge_components_exactly():
    x = np.array([[10 ** 30, 1], [10 ** 30, 2], [-(10 ** 30), 5]], dtype=object)
    ids, score = m_tree.MTree(np.arange(3), x).search(9, np.array([1, 10 ** 9], dtype=object), 2)
    assert list(ids) == [1, 0] and list(score) == [10 ** 30 + 2 * 10 ** 9, 10 ** 30 + 10 ** 9]


# ---- packing
def _naive(sizes, sources, clusters, window):
    held, out = [], []
    for size, s, c in zip(sizes, sources, clusters):
        fits = [(window - sum(sizes[k] for k in b), n) for n, b in enumerate(held)
                if sum(sizes[k] for k in b) + size <= window
                and not any(sources[k] == s or (c is not None and clusters[k] == c) for k in b)]
        if fits:
            n = min(fits)[1]
            held[n].append(len(out))
        else:
            n = len(held)
            held.append([len(out)])
        out.append(n)
    return out


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_takes_the_tightest_compatible_bin(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 60) for _ in range(120)), reverse=True)
    sources = [f"s{rng.randrange(6)}" for _ in sizes]
    clusters = [rng.choice([None, 1, 2, 3, 4, 5, 6, 7, 8]) for _ in sizes]
    bins, offsets = packing.best_fit(sizes, sources, clusters, 100)
    assert bins == _naive(sizes, sources, clusters, 100)
    for b in set(bins):
        spans = sorted((o, o + s) for o, s, k in zip(offsets, sizes, bins) if k == b)
        assert spans[0][0] == 0 and all(x[1] == y[0] for x, y in zip(spans, spans[1:])) and spans[-1][1] <= 100


# ---- CRF
def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(2)
    e, trans = rng.normal(size=(4, 1, 3)), rng.normal(size=(3, 3))
    marginal, pairs = crf.forward_backward(e, trans)
    start = np.exp(trans).sum(0)
    want, joint, total = np.zeros((4, 3)), np.zeros((3, 3)), 0.0
    for path in itertools.product(range(3), repeat=4):
        w = start[path[0]] * math.exp(sum(e[t, 0, s] for t, s in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        total += w
        for t, s in enumerate(path):
            want[t, s] += w
        for a, b in zip(path, path[1:]):
            joint[a, b] += w
    assert np.allclose(marginal[:, 0], want / total) and np.allclose(pairs, joint / total)


def test_block_posteriors_equal_plain_forward_backward():
    rng = np.random.default_rng(0)
    lengths = np.array([300, 5, 0, 130, 128, 1])
    e, trans = rng.normal(size=(lengths.sum(), 4)), rng.normal(size=(4, 4))
    mean, each = crf.posteriors(e, lengths, trans, per_word=True)
    at = 0
    for k, n in enumerate(lengths):
        if n:
            one, _ = crf.forward_backward(e[at:at + n][:, None], trans)
            assert np.allclose(one[:, 0], each[at:at + n]) and np.allclose(mean[k], one.mean((0, 1)))
        else:
            assert not mean[k].any()
        at += n


def test_words_of_code_switched_text_are_labelled_apart():
    en = ["the of and thing that with".split()] * 30
    de = ["der die und keit nicht schön".split()] * 30
    weights, trans = crf.train(en + de, [0] * 30 + [1] * 30, 2, sequences=100, rounds=20)
    got = language_id.Model(["en", "de"], weights, trans).label_words("The thing, and that: DER schön keit 12")
    assert [(w, l) for w, l, _ in got] == [("the", "en"), ("thing", "en"), ("and", "en"), ("that", "en"),
                                           ("der", "de"), ("schön", "de"), ("keit", "de")]


def test_long_texts_are_cut_between_words_only():
    text = "abc déf " * 1000
    assert "".join(p for _, p in language_id._pieces(text, 13)) == text
    assert [w for _, p in language_id._pieces(text, 13) for w in language_id.words_of(p)] == language_id.words_of(text)


# ---- Kneser-Ney
def test_kneser_ney_probabilities_sum_to_one_and_pieces_agree(monkeypatch):
    probs = pd.DataFrame({"k": [1, 1, 2, 2], "gram": [1, 2, 6, 9], "p": [0.4, 0.3, 0.5, 0.25]})
    gammas = pd.DataFrame({"k": [1, 2, 2], "ctx": [0, 1, 2], "gamma": [0.3, 0.2, 0.5]})
    model = kneser_ney.Model([97], probs, gammas, symbols=4, order=2)
    log = model.log10()
    assert log.shape == (16,) and np.isclose(10 ** log[6], 0.5)
    whole = model.score("aabxa")
    monkeypatch.setattr(kneser_ney, "TAKE_CHARS", 2)
    assert np.isclose(model.score("aabxa")[0], whole[0]) and model.score("")[1] == 1


# ---- context mixing
def _mixer():
    counts = np.array([50, 20, 5, 1])
    weights = np.array([50, 20, 5, 1, 9, 4])
    m = context_mixing.Mixer([b"a", b"b", b"c", b"d"], counts, weights, None).ready()
    slots = np.zeros((1 << context_mixing.TABLE_BITS, 2), dtype=np.int32)
    ids = np.array([0, 1, 0, 1, 2, 4, 0, 1, 3, 5, 4], dtype=np.int32)
    m.count(ids, np.array([6, 5]), slots)
    m.table = context_mixing.predictors(slots[:, 0], slots[:, 1])
    return m


def test_symbol_probabilities_sum_to_one_after_any_history():
    m = _mixer()
    for history in ([], [0], [0, 1], [3, 5, 2, 0, 1] * 40):
        before = m.score(np.array(history, dtype=np.int32), np.array([len(history)]))[0] if history else 0.0
        after = [m.score(np.array([*history, s], dtype=np.int32), np.array([len(history) + 1]))[0] for s in range(6)]
        assert np.isclose(sum(10 ** (a - before) for a in after), 1.0, atol=1e-4)


def test_a_document_scores_the_same_alone_and_in_a_batch():
    m = _mixer()
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 6, n).astype(np.int32) for n in (1, 700, 30, 2000)]
    together = m.score(np.concatenate(docs), np.array([len(d) for d in docs]))
    alone = [m.score(d, np.array([len(d)]))[0] for d in docs]
    assert np.allclose(together, alone, rtol=1e-4)


def test_bits_are_worked_on_in_blocks_and_score_the_same(monkeypatch):
    m, sizes, slots = _mixer(), [], context_mixing._slots
    monkeypatch.setattr(context_mixing, "_slots", lambda h, *rest: sizes.append(len(h)) or slots(h, *rest))
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 6, n).astype(np.int32) for n in (*[96] * 400, 1, 97, 800, 5000)]
    ids, lengths = np.concatenate(docs), np.array([len(d) for d in docs])
    together = m.score(ids, lengths)
    assert max(sizes) <= 4_000 * m._code.length.max() < 30_000
    counts = np.zeros((1 << context_mixing.TABLE_BITS, 2), dtype=np.int32)
    m.count(ids, lengths, counts)
    assert counts.sum() == 3 * m._code.length[ids].sum()
    monkeypatch.setattr(context_mixing, "BLOCK", 7)
    monkeypatch.setattr(context_mixing, "GROUP", 90)
    again = np.zeros_like(counts)
    m.count(ids, lengths, again)
    assert (again == counts).all() and np.allclose(m.score(ids, lengths), together, rtol=1e-9)


def test_laid_out_words_are_those_of_pieces():
    texts = ["", " ", "A b\x0bc\x0c\r d ", "\tÉ é\x85b\x1cb b", "b b\x00 x x y", "a" * 70 + "\n\n"]
    m = _mixer()
    ids, lengths, others = context_mixing._laid(m, texts)
    number = {w: k for k, w in enumerate(m.words)}
    words = [[w for part in context_mixing.pieces(t) for w in part] for t in texts]
    assert ids.tolist() == [k for ws in words for k in [*(number.get(w, m.other) for w in ws), m.end]]
    assert lengths.tolist() == [len(ws) + 1 for ws in words]
    assert [dict(c) for c in others] == [{w: ws.count(w) for w in ws if w not in number} for ws in words]


def test_spelling_is_a_distribution_over_short_words():
    counts = np.zeros((1 << context_mixing.SPELL_BITS, 2), dtype=np.int32)
    context_mixing.spell_counts([b"the", b"then", b"ten", b"a"], counts)
    table = context_mixing.predictors(counts[:, 0], counts[:, 1], context_mixing.SPELL_TRUST)
    singles = 10 ** context_mixing.spell_log10([bytes([b]) for b in range(256) if b != 32], table)
    assert 0 < singles.sum() < 1
    assert context_mixing.spell_log10([b"then"], table)[0] > context_mixing.spell_log10([b"qxzw"], table)[0]


def test_pieces_split_like_the_whole_text():
    text = "Ab cÉ\x0bx\t" * 50 + "É" * 30
    assert [w for p in context_mixing.pieces(text) for w in p] == \
        [w for w in text.replace("A", "a").encode().split()]


# ---- n-gram join
def test_least_matches_is_the_posterior_bound():
    least = ngram_join.least_matches(0.8, 1e-7)
    assert least[0] == 0 and all(0 < m < 0.8 * n for n, m in zip(range(ngram_join.STEP, 129, ngram_join.STEP), least[1:]))


def test_minhash_estimates_similarity_and_short_texts_are_one_shingle():
    s = ngram_join.Shingler()
    assert len(s("")) == 0 and len(s(" \n")) == 0 and len(s("one two")) == 1 and len(s("a b c d e f")) == 2
    words = [f"w{k}" for k in range(400)]
    a, b = s(" ".join(words)), s(" ".join(words[:360] + ["x"] * 40))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    assert abs((ngram_join.signature(a) == ngram_join.signature(b)).mean() - true) < 0.15


def test_shared_shingles_equals_set_intersection(monkeypatch):
    monkeypatch.setattr(ngram_join, "COLUMNS", 16)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40)).astype(np.uint64) for _ in range(9)]
    for left, right in ((np.arange(9), None), (np.arange(4), np.arange(4, 9))):
        right = left if right is None else right
        got = ngram_join.shared_shingles(sets, left, right)
        want = [[len(np.intersect1d(sets[i], sets[j])) for j in right] for i in left]
        if right is left:
            np.fill_diagonal(got, 0)
            want = np.array(want)
            np.fill_diagonal(want, 0)
        assert (got == np.array(want)).all()
