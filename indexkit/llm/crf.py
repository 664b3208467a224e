"""Linear-chain conditional random field over words: numpy kernels.

States are languages.  A word's emission score is the sum of hashed feature
weights: character n-grams of the word between border marks (those touching a
border are its affixes) and the word itself (the lexicon).  Transition weights
between the languages of neighbouring words are learned with them.  Inference
is forward-backward, cut into blocks of ``BLOCK`` words: first the transfer
matrix of every block, then the short chain of blocks of each text, then the
words inside all blocks at once, so a text of any length costs a fixed number
of vector steps per block and is never cut.
"""

from __future__ import annotations

import numpy as np

BITS = 17
GRAMS = (1, 2, 3, 4)
BLOCK = 128
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words in one flat array, and where each word's begin."""
    flat = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    length = np.fromiter((len(w) + 2 for w in words), dtype=np.int64, count=len(words))
    start = np.concatenate([[0], np.cumsum(length)[:-1]]).astype(np.int64)
    end = np.repeat(start + length, length)
    at = np.arange(len(flat))
    shift = np.uint64(64 - BITS)
    owner, found = [], []
    word_of = np.repeat(np.arange(len(words)), length)
    with np.errstate(over="ignore"):
        for n in GRAMS:
            ok = np.flatnonzero(at + n <= end)
            h = np.full(len(ok), n, dtype=np.uint64)
            for k in range(n):
                h = (h ^ flat[ok + k]) * _P1
                h ^= h >> np.uint64(29)
            found.append((h * _P2) >> shift)
            owner.append(word_of[ok])
        place = (at - np.repeat(start, length)).astype(np.uint64)
        whole = np.add.reduceat((flat + place * _P2) * _P1 ^ (flat << np.uint64(17)) * (place + np.uint64(3)), start)
        found.append(((whole ^ (whole >> np.uint64(31))) * _P2) >> shift)
        owner.append(np.arange(len(words)))
    owner, found = np.concatenate(owner), np.concatenate(found).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return found[order], np.searchsorted(owner[order], np.arange(len(words)))


def emissions(words: list[str], weights: np.ndarray) -> np.ndarray:
    if not words:
        return np.zeros((0, weights.shape[1]), dtype=np.float32)
    found, start = features(words)
    return np.add.reduceat(weights[found], start, axis=0)


def forward_backward(e: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals [T, S, L] and expected transitions [L, L] of S sequences of
    equal length with emission scores ``e`` [T, S, L]."""
    t_max, s, labels = e.shape
    f = np.exp(e - e.max(axis=2, keepdims=True))
    a = np.exp(trans)
    alpha = np.empty_like(f)
    now = np.ones((s, labels))
    for t in range(t_max):
        now = now @ a * f[t]
        now /= now.sum(1, keepdims=True)
        alpha[t] = now
    marginal = np.empty_like(f)
    beta = np.ones((s, labels))
    pairs = np.zeros((labels, labels))
    for t in range(t_max - 1, -1, -1):
        m = alpha[t] * beta
        marginal[t] = m / m.sum(1, keepdims=True)
        out = f[t] * beta
        if t:
            total = (alpha[t - 1] @ a * out).sum(1, keepdims=True)
            pairs += a * ((alpha[t - 1] / total).T @ out)
        beta = out @ a.T
        beta /= beta.sum(1, keepdims=True)
    return marginal, pairs


def _spliced(by_label: list[list[list[str]]], rng: np.random.Generator, sequences: int, length: int) -> tuple:
    """Code-switched sequences: word numbers and labels [length, sequences], the
    features of the numbered words, where each word's begin and how many it has."""
    number: dict[str, int] = {}
    word = np.empty((length, sequences), dtype=np.int64)
    gold = np.empty((length, sequences), dtype=np.int64)
    for s in range(sequences):
        t = 0
        while t < length:
            k = int(rng.integers(len(by_label)))
            text = by_label[k][int(rng.integers(len(by_label[k])))]
            take = min(length - t, int(rng.geometric(1 / 16)))
            at = int(rng.integers(max(1, len(text) - take + 1)))
            for w in text[at:at + take]:
                word[t, s] = number.setdefault(w, len(number))
                gold[t, s] = k
                t += 1
    found, start = features(list(number))
    return word, gold, found, start, np.diff(np.append(start, len(found)))


def train(texts: list[list[str]], labels: list[int], n_labels: int, seed: int = 7, sequences: int = 1500,
          length: int = 48, rounds: int = 40, rate: float = 0.15, decay: float = 1e-4, batches: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Feature and transition weights by gradient ascent on the conditional
    likelihood of code-switched sequences spliced from labelled texts: in every
    round a step for each of ``batches`` batches of ``sequences``."""
    rng = np.random.default_rng(seed)
    weights = np.zeros((1 << BITS, n_labels), dtype=np.float32)
    trans = np.zeros((n_labels, n_labels))
    by_label = [[t for t, l in zip(texts, labels) if l == k and t] for k in range(n_labels)]
    if n_labels < 2 or not all(by_label):
        return weights, trans
    drawn = [_spliced(by_label, rng, sequences, length) for _ in range(batches)]
    speed = np.full_like(weights, 1e-6)
    trans_speed = np.full_like(trans, 1e-6)
    for _ in range(rounds):
        for word, gold, found, start, per_word in drawn:
            e = np.add.reduceat(weights[found], start, axis=0)[word].astype(np.float64)
            marginal, pairs = forward_backward(e, trans)
            miss = (np.eye(n_labels)[gold] - marginal).reshape(-1, n_labels)
            grad = np.empty_like(weights)
            flat = word.ravel()
            for k in range(n_labels):
                by_word = np.bincount(flat, weights=miss[:, k], minlength=len(per_word))
                grad[:, k] = np.bincount(found, weights=np.repeat(by_word, per_word), minlength=1 << BITS)
            grad = grad / sequences - decay * weights
            speed += grad * grad
            weights += rate * grad / np.sqrt(speed)
            seen = np.zeros((n_labels, n_labels))
            np.add.at(seen, (gold[:-1].ravel(), gold[1:].ravel()), 1)
            tg = (seen - pairs) / sequences - decay * trans
            trans_speed += tg * tg
            trans += rate * tg / np.sqrt(trans_speed)
    return weights, trans


def posteriors(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray, per_word: bool = False
               ) -> tuple[np.ndarray, np.ndarray | None]:
    """Mean marginal of each text [D, L] (zeros for a text without words) and,
    on demand, the marginals of all words [N, L].  ``e`` holds the words of all
    texts one after another."""
    labels, docs = trans.shape[0], len(lengths)
    mean = np.zeros((docs, labels))
    total = int(lengths.sum())
    if not total:
        return mean, (np.zeros((0, labels)) if per_word else None)
    a = np.exp(trans - trans.max())
    blocks = -(-lengths // BLOCK)
    lanes = int(blocks.sum())
    first_lane = np.concatenate([[0], np.cumsum(blocks)[:-1]])
    doc_of = np.repeat(np.arange(docs), lengths)
    within = np.arange(total) - np.repeat(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    lane, step = first_lane[doc_of] + within // BLOCK, within % BLOCK
    f = np.ones((BLOCK, lanes, labels))
    f[step, lane] = np.exp(e - e.max(axis=1, keepdims=True))
    live = np.zeros((BLOCK, lanes), dtype=bool)
    live[step, lane] = True
    full = live.all(axis=1)

    move = np.broadcast_to(np.eye(labels), (lanes, labels, labels)).copy()
    for t in range(BLOCK):
        on = slice(None) if full[t] else np.flatnonzero(live[t])
        new = (move[on].reshape(-1, labels) @ a).reshape(-1, labels, labels) * f[t][on][:, None, :]
        move[on] = new / new.sum((1, 2), keepdims=True)

    enter = np.ones((lanes, labels))
    leave = np.ones((lanes, labels))
    most = int(blocks.max())
    for j in range(1, most):
        on = first_lane[blocks > j] + j
        v = np.einsum("nl,nlm->nm", enter[on - 1], move[on - 1])
        enter[on] = v / v.sum(1, keepdims=True)
    for j in range(most - 2, -1, -1):
        on = first_lane[blocks > j + 1] + j
        v = np.einsum("nlm,nm->nl", move[on + 1], leave[on + 1])
        leave[on] = v / v.sum(1, keepdims=True)

    alpha = np.empty_like(f)
    now = enter
    for t in range(BLOCK):
        new = now @ a * f[t]
        new /= new.sum(1, keepdims=True)
        now = new if full[t] else np.where(live[t][:, None], new, now)
        alpha[t] = now
    beta = leave
    for t in range(BLOCK - 1, -1, -1):
        m = alpha[t] * beta
        alpha[t] = m / m.sum(1, keepdims=True)
        new = (f[t] * beta) @ a.T
        new /= new.sum(1, keepdims=True)
        beta = new if full[t] else np.where(live[t][:, None], new, beta)
    alpha[~live] = 0
    has = lengths > 0
    mean[has] = np.add.reduceat(alpha.sum(0), first_lane[has], axis=0) / lengths[has][:, None]
    return mean, (alpha[step, lane] if per_word else None)
