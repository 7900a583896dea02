"""A linear-chain conditional random field over words, in numpy.

A word's features are its character n-grams with marks at both ends (so prefixes and suffixes are
features of their own) and, for words seen in training, the word itself. Weights lie in a hashed
table. Labels of neighbouring words are tied by learned transitions; forward-backward gives each
word's label probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

WORD = re.compile("[^\\W\\d_]+")
BUCKETS = 1 << 16
LONGEST_GRAM = 4
_MULT = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # (BUCKETS, labels)
    transitions: np.ndarray  # (labels, labels), from row to column
    start: np.ndarray
    lexicon: frozenset[str]

    def emissions(self, words: list[str]) -> np.ndarray:
        """Scores of each word for each label."""
        if not words:
            return np.zeros((0, len(self.labels)), "f4")
        table = np.vstack([self.weights, np.zeros_like(self.weights[:1])])
        points, sizes, owner = marked_points(words)
        places = np.zeros((len(points), len(self.labels)), "f4")
        for bucket in gram_buckets(points, owner):
            places[:len(bucket)] += table[bucket]
        scores = np.add.reduceat(places, np.cumsum(sizes) - sizes)
        known, bucket = word_buckets(words, self.lexicon, points, sizes)
        scores[known] += table[bucket]
        return scores


def marked_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words with a mark at both ends, each word's points, each point's word."""
    marked = [f"\x02{w}\x03" for w in words]
    sizes = np.fromiter(map(len, marked), "i8", len(marked))
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype("u8")
    return points, sizes, np.repeat(np.arange(len(words)), sizes)


def gram_buckets(points: np.ndarray, owner: np.ndarray) -> Iterator[np.ndarray]:
    """For each n-gram size the bucket by starting point; BUCKETS where it would leave its word."""
    rolled = np.zeros(len(points), "u8")
    for n in range(1, LONGEST_GRAM + 1):
        width = len(points) - n + 1
        rolled = rolled[:width] * np.uint64(1_000_003) + points[n - 1:]
        yield np.where(owner[:width] == owner[n - 1:], _bucket(rolled + np.uint64(n << 40)), BUCKETS)


def word_buckets(words: list[str], lexicon: frozenset[str], points: np.ndarray,
                 sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the words in the lexicon, and their buckets as whole words."""
    known = np.array([i for i, w in enumerate(words) if w in lexicon], "i8")
    begins = (np.cumsum(sizes) - sizes)[known]
    whole = np.zeros(len(known), "u8")
    for step in range(int(sizes[known].max()) if len(known) else 0):
        here = step < sizes[known]
        whole[here] = whole[here] * np.uint64(31_337_357) + points[begins[here] + step]
    return known, _bucket(whole + np.uint64(9 << 40))


def features(words: list[str], lexicon: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features and the word each belongs to, in order of words."""
    points, sizes, owner = marked_points(words)
    known, whole = word_buckets(words, lexicon, points, sizes)
    found, owners = [whole], [known]
    for bucket in gram_buckets(points, owner):
        inside = bucket < BUCKETS
        found.append(bucket[inside])
        owners.append(owner[:len(bucket)][inside])
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(found)[order], owner[order]


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MULT
    return ((h ^ (h >> np.uint64(32))) & np.uint64(BUCKETS - 1)).astype("i8")


def marginals(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray,
              start: np.ndarray) -> np.ndarray:
    """Label probabilities (sequences, words, labels) by forward-backward; rows padded at the end."""
    n, longest, k = scores.shape
    seen = np.exp(scores - scores.max(axis=2, keepdims=True))
    moves = np.exp(transitions - transitions.max()).astype(scores.dtype)
    ahead = np.empty_like(seen)
    now = np.exp(start - start.max()).astype(scores.dtype) * seen[:, 0]
    ahead[:, 0] = now = now / now.sum(axis=1, keepdims=True)
    for t in range(1, longest):
        now = (now @ moves) * seen[:, t]
        ahead[:, t] = now = now / now.sum(axis=1, keepdims=True)
    after = np.ones((n, k), scores.dtype)
    for t in range(longest - 2, -1, -1):
        after = (seen[:, t + 1] * after) @ moves.T
        after /= after.sum(axis=1, keepdims=True)
        after[t + 1 >= lengths] = 1.0 / k
        ahead[:, t] *= after
    ahead /= ahead.sum(axis=2, keepdims=True)
    return ahead


def padded(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """(sum of lengths, labels) as (sequences, longest, labels)."""
    out = np.zeros((len(lengths), int(lengths.max()), flat.shape[1]), flat.dtype)
    out[np.arange(out.shape[1])[None, :] < lengths[:, None]] = flat
    return out


def fit(texts: list[tuple[str, str]], epochs: int = 4, batch: int = 64, rate: float = 0.15,
        decay: float = 1e-5, min_lexicon: int = 3, seed: int = 7) -> Model:
    """Trains on (text, label). Sequences are made of runs of words from different texts, so that
    switches of the label within a sequence are learned as well as its staying the same.
    """
    rng = np.random.default_rng(seed)
    labels = sorted({label for _, label in texts})
    number = {label: i for i, label in enumerate(labels)}
    runs, counts = [], {}
    for text, label in texts:
        words = WORD.findall(text.lower())
        for w in words:
            counts[w] = counts.get(w, 0) + 1
        at = 0
        while at < len(words):
            size = int(rng.integers(4, 25))
            runs.append((words[at:at + size], number[label]))
            at += size
    lexicon = frozenset(w for w, n in counts.items() if n >= min_lexicon)
    k = len(labels)
    model = Model(labels, np.zeros((BUCKETS, k), "f4"), np.zeros((k, k), "f4"), np.zeros(k, "f4"),
                  lexicon)
    if not runs:
        return model
    squares = [np.full_like(p, 1e-6) for p in (model.weights, model.transitions, model.start)]
    summed = [np.zeros_like(p, dtype="f8") for p in (model.weights, model.transitions, model.start)]
    steps = 0
    for _ in range(epochs):
        order, made = rng.permutation(len(runs)), []
        at = 0
        while at < len(order):
            size = int(rng.choice([1, 1, 2, 3]))
            made.append([runs[i] for i in order[at:at + size]])
            at += size
        for first in range(0, len(made), batch):
            part = made[first:first + batch]
            words = [w for seq in part for own, _ in seq for w in own]
            gold = np.array([y for seq in part for own, y in seq for _ in own])
            lengths = np.array([sum(len(own) for own, _ in seq) for seq in part])
            bucket, owner = features(words, lexicon)
            flat = np.add.reduceat(model.weights[bucket],
                                   np.searchsorted(owner, np.arange(len(words))))
            grads = gradients(model, flat, gold, lengths, bucket, owner)
            for p, g, s, total in zip((model.weights, model.transitions, model.start), grads,
                                      squares, summed, strict=True):
                g = g / len(part) + decay * p
                s += g * g
                p -= rate * g / np.sqrt(s)
                total += p
            steps += 1
    return Model(labels, *((t / steps).astype("f4") for t in summed), lexicon)


def gradients(model: Model, flat: np.ndarray, gold: np.ndarray, lengths: np.ndarray,
              bucket: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected minus observed counts of features, transitions and starts."""
    k = len(model.labels)
    scores = padded(flat, lengths)
    inside = np.arange(scores.shape[1])[None, :] < lengths[:, None]
    prob = marginals(scores, lengths, model.transitions, model.start)
    observed = np.eye(k, dtype="f4")[gold]
    error = prob[inside] - observed
    weights = np.zeros_like(model.weights)
    np.add.at(weights, bucket, error[owner])
    pairs = pair_counts(scores, lengths, model.transitions, model.start)
    ends = np.cumsum(lengths)
    link = np.ones(len(gold) - 1, bool)
    link[ends[:-1] - 1] = False
    np.subtract.at(pairs, (gold[:-1][link], gold[1:][link]), 1.0)
    begins = ends - lengths
    return weights, pairs, prob[:, 0].sum(axis=0) - observed[begins].sum(axis=0)


def pair_counts(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray,
                start: np.ndarray) -> np.ndarray:
    """Expected number of each move from label to label."""
    n, longest, k = scores.shape
    seen = np.exp(scores - scores.max(axis=2, keepdims=True))
    moves = np.exp(transitions - transitions.max())
    ahead = np.empty_like(seen)
    ahead[:, 0] = np.exp(start - start.max()) * seen[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, longest):
        ahead[:, t] = (ahead[:, t - 1] @ moves) * seen[:, t]
        ahead[:, t] /= ahead[:, t].sum(axis=1, keepdims=True)
    after = np.full((n, k), 1.0 / k, seen.dtype)
    total = np.zeros((k, k), "f4")
    for t in range(longest - 2, -1, -1):
        after[t + 2 >= lengths] = 1.0 / k  # what follows the word after this one
        right = seen[:, t + 1] * after
        joint = ahead[:, t, :, None] * moves[None] * right[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        total += joint[t + 1 < lengths].sum(axis=0)
        after = right @ moves.T
        after /= after.sum(axis=1, keepdims=True)
    return total
