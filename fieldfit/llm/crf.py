"""A linear-chain conditional random field over words, in numpy.

Scores of a word come from hashed features: its affixes and inner character n-grams
(n-grams of the word between two border marks), and a lexicon of whole words. Label
transitions are learned. Marginals come from forward-backward, computed for many
texts at once, one step per word position.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import regex

ORDERS = (2, 3, 4)
BITS = 17
GRAM_ROUNDS, CHAIN_ROUNDS = 30, 15
RATE, SHRINK = 0.4, 1e-3
WINDOW = 64

# Letters with their combining marks; number characters such as Roman numerals are no letters.
words_of = regex.compile(r"\p{M}*+\p{L}[\p{L}\p{M}]*+").findall


class Numbers(dict):
    """Numbers for words in order of first use."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def numbered(texts, numbers: Numbers) -> list[np.ndarray]:
    """Word numbers of every text, lower case; numbers grow as words come up."""
    get = numbers.__getitem__
    return [np.array(list(map(get, words_of((t or "").lower()))), np.int32) for t in texts]


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) pairs of all words: n-grams with borders, and the word itself."""
    marks = np.frombuffer(("<" + "><".join(words) + ">").encode("utf-32-le", "surrogatepass"), np.uint32)
    first = marks == ord("<")
    owner = np.cumsum(first, dtype=np.int32) - 1
    mask = np.uint32((1 << BITS) - 1)
    who, what = [], []
    with np.errstate(over="ignore"):
        for k in ORDERS:
            if len(marks) < k:
                continue
            n = len(marks) - k + 1
            h = np.full(n, 0x9E3779B1 * k & 0xFFFFFFFF, np.uint32)
            for j in range(k):
                h = (h ^ marks[j : n + j]) * np.uint32(0x85EBCA6B)
                h ^= h >> np.uint32(15)
            inside = owner[:n] == owner[k - 1 :]
            who.append(owner[:n][inside])
            what.append(h[inside] & mask)
        place = np.arange(len(marks), dtype=np.uint32) - np.flatnonzero(first).astype(np.uint32)[owner]
        terms = marks * (place * np.uint32(0xC2B2AE35) + np.uint32(0x27D4EB2F))
        whole = np.add.reduceat(terms ^ terms >> np.uint32(13), np.flatnonzero(first), dtype=np.uint32)
        whole *= np.uint32(0x9E3779B1)
    who.append(np.arange(len(words), dtype=np.int32))
    what.append((whole >> np.uint32(32 - BITS)) + np.uint32(1 << BITS))  # the lexicon has a table of its own
    return np.concatenate(who), np.concatenate(what).astype(np.int32)


@dataclass
class Model:
    """Labels, feature weights (features x labels) and log transitions (from x to)."""

    labels: list[str]
    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of words for every label, a block of words at a time."""
        out = np.zeros((len(words), len(self.labels)), np.float32)
        for at in range(0, len(words), 50_000):
            part = words[at : at + 50_000]
            who, what = word_features(part)
            for k in range(len(self.labels)):
                out[at : at + len(part), k] = np.bincount(who, self.weights[what, k], len(part))
        return out

    def marginals(self, sequences: list[np.ndarray], scores: np.ndarray) -> list[np.ndarray]:
        """Expected number of words per label for every sequence of word numbers."""
        return forward_backward(sequences, scores, self.moves)[0]


def forward_backward(sequences, scores, moves, each=False):
    """Sums of the marginals of every sequence; with ``each`` also those of every word
    (in order of the sequences) and the expected transitions."""
    k = scores.shape[1]
    sizes = np.array([len(s) for s in sequences], np.int64)
    order = np.argsort(-sizes, kind="stable")
    offsets = np.concatenate(([0], np.cumsum(sizes)))[:-1][order]
    tokens = np.concatenate(sequences) if len(sequences) else np.zeros(0, np.int32)
    sums = np.zeros((len(sequences), k))
    if not len(tokens):
        return sums, None, None
    likely = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float32)
    step = np.exp(moves - moves.max()).astype(np.float32)
    longest = int(sizes.max())
    # texts still running at each position: the first so many of the order
    running = len(sizes) - np.searchsorted(np.sort(sizes), np.arange(longest), side="right")
    alpha = np.empty((len(tokens), k), np.float32)
    now = None
    for t in range(longest):
        n = running[t]
        at = offsets[:n] + t
        now = likely[tokens[at]] if t == 0 else (now[:n] @ step) * likely[tokens[at]]
        now = now / now.sum(axis=1, keepdims=True)
        alpha[at] = now
    pairs = np.zeros((k, k)) if each else None
    back = np.ones((0, k), np.float32)
    for t in range(longest - 1, -1, -1):
        n = running[t]
        at = offsets[:n] + t
        beta = np.ones((n, k), np.float32)
        if len(back):
            m = len(back)
            ahead = likely[tokens[at[:m] + 1]] * back
            if each:
                joint = alpha[at[:m], :, None] * step * ahead[:, None, :]
                pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            beta[:m] = ahead @ step.T
            beta[:m] /= beta[:m].sum(axis=1, keepdims=True)
        back = beta
        post = alpha[at] * beta
        post /= post.sum(axis=1, keepdims=True)
        sums[order[:n]] += post
        if each:
            alpha[at] = post  # the forward value of this position is not needed again
    return sums, alpha if each else None, pairs


def fit(texts: list[str], langs: list[str]) -> Model:
    """Learn from texts with one label each.

    First the word scores, with every word labelled like its text. Then the words
    are labelled anew by the chain, so that passages in another language get their
    own labels, and scores and transitions are learned together on those.
    """
    labels = sorted(set(langs))
    k = len(labels)
    numbers = Numbers()
    sequences = numbered(texts, numbers)
    gold = [np.full(len(s), labels.index(lang)) for s, lang in zip(sequences, langs)]
    kept = [i for i, s in enumerate(sequences) if len(s)]
    model = Model(labels, np.zeros((2 << BITS, k), np.float32), np.zeros((k, k), np.float32))
    if not kept or k < 2:
        return model
    tokens, truth = np.concatenate([sequences[i] for i in kept]), np.concatenate([gold[i] for i in kept])
    who, what = word_features(list(numbers))
    scale = 1.0 / len(tokens)
    squares = np.zeros_like(model.weights)

    def scores() -> np.ndarray:
        return np.stack([np.bincount(who, model.weights[what, j], len(numbers)) for j in range(k)], axis=1)

    def counts(of: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(tokens, of[:, j], len(numbers)) for j in range(k)], axis=1)

    def learn(gap: np.ndarray) -> None:
        """One adaptive gradient step on the feature weights."""
        g = np.stack([np.bincount(what, gap[who, j], len(model.weights)) for j in range(k)], axis=1) * scale
        g -= SHRINK * scale * model.weights * 100
        squares[:] = squares * 0.9 + g * g
        model.weights += (RATE * g / (np.sqrt(squares) + 1e-6)).astype(np.float32) * 0.5

    wanted = counts(np.eye(k)[truth])
    often = wanted.sum(axis=1, keepdims=True)
    for _ in range(GRAM_ROUNDS):
        p = scores()
        p = np.exp(p - p.max(axis=1, keepdims=True))
        learn(wanted - often * p / p.sum(axis=1, keepdims=True))
    # words relabelled by the chain, starting from a mild liking to stay
    model.moves[:] = np.where(np.eye(k, dtype=bool), 0.0, -4.0)
    cut = [sequences[i][a : a + WINDOW] for i in kept for a in range(0, len(sequences[i]), WINDOW)]
    _, each, _ = forward_backward(cut, scores(), model.moves, each=True)
    best = each.argmax(axis=1)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in cut])))[:-1]
    inner = np.ones(len(tokens), bool)
    inner[starts] = False
    seen = np.zeros((k, k))
    np.add.at(seen, (best[:-1][inner[1:]], best[1:][inner[1:]]), 1)
    wanted = counts(np.eye(k)[best])
    move_squares = np.zeros((k, k))
    for _ in range(CHAIN_ROUNDS):
        _, each, pairs = forward_backward(cut, scores(), model.moves, each=True)
        learn(wanted - counts(each))
        g = (seen + 0.5 - pairs) * scale
        move_squares = move_squares * 0.9 + g * g
        model.moves += (0.2 * g / (np.sqrt(move_squares) + 1e-6)).astype(np.float32)
    return model
