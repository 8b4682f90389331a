"""A two-state linear-chain conditional random field over words (0 clean, 1 toxic).

Features of a word are the word and its prefixes. Which of them go with the label
is found by a test on the labelled documents, and words of toxic documents that
have such a feature are the labelled toxic words. Because there are two states, the
forward and backward messages are ratios, so whole batches of sequences advance with
a few vector operations per position.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np

WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (3, 4, 5, 6, 7, 8)
CACHE_WORDS = 300_000


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def marginals(odds: np.ndarray, lengths: np.ndarray, step: np.ndarray) -> np.ndarray:
    """P(state 1) of every position. ``odds``: (positions, sequences) of exp(score of state 1 minus
    state 0); ``step[a, b]``: weight of going from a to b. Positions beyond a length are ignored."""
    n, m = odds.shape
    forward, back = np.empty((n, m)), np.empty((n, m))
    r = forward[0] = odds[0]
    for t in range(1, n):
        r = forward[t] = odds[t] * ((step[0, 1] + r * step[1, 1]) / (step[0, 0] + r * step[1, 0]))
    b = np.ones(m)
    for t in range(n - 1, -1, -1):
        if t + 1 < n:
            x = odds[t + 1] * b
            b = (step[1, 0] + step[1, 1] * x) / (step[0, 0] + step[0, 1] * x)
        b = np.where(t >= lengths - 1, 1.0, b)
        back[t] = b
    x = forward * back
    return x / (1.0 + x)


@dataclass
class Model:
    weights: dict[str, float]
    bias: float
    step: np.ndarray
    scale: tuple[float, float, float] = (-20.0, 2.0, 0.0)    # of a document: constant, toxic words, length
    known: dict[str, float] = field(default_factory=dict, repr=False)
    _ratios: tuple[list, list] = field(default_factory=lambda: ([], []), repr=False)

    def score(self, word: str) -> float:
        """Score of state 1 minus state 0."""
        s = self.known.get(word)
        if s is None:
            s = self.bias + sum(self.weights.get(f, 0.0) for f in features(word))
            if len(self.known) < CACHE_WORDS:
                self.known[word] = s
        return s

    def tag(self, sequences: list[list[str]]) -> list[np.ndarray]:
        """P(toxic) of every word of every sequence."""
        scores = [np.fromiter(map(self.score, s), dtype=float, count=len(s)) for s in sequences]
        out: list[np.ndarray] = [np.zeros(0)] * len(scores)
        plain = [i for i, s in enumerate(scores) if len(s) and (s == self.bias).all()]
        for i in plain:
            out[i] = self._plain(len(scores[i]))
        rest = sorted((i for i, s in enumerate(scores) if len(s) and not len(out[i])), key=lambda i: len(scores[i]))
        for a in range(0, len(rest), 64):
            part = rest[a:a + 64]
            lengths = np.array([len(scores[i]) for i in part])
            odds = np.ones((lengths.max(), len(part)))
            for j, i in enumerate(part):
                odds[:lengths[j], j] = np.exp(np.clip(scores[i], -30, 30))
            p = marginals(odds, lengths, self.step)
            for j, i in enumerate(part):
                out[i] = p[:lengths[j], j]
        return out

    def document(self, p: np.ndarray) -> float:
        """Score of a document from the marginals of its words."""
        a, b, c = self.scale
        x = a + b * np.log1p(p.sum()) + c * np.log1p(len(p))
        return float(1.0 / (1.0 + np.exp(-np.clip(x, -50, 50))))

    def _plain(self, n: int) -> np.ndarray:
        """Marginals of ``n`` words without any feature. The forward ratio depends on the place from
        the start alone and the backward ratio on the place from the end, so both are kept and grown."""
        (a, b), (c, d) = self.step.tolist()
        odds = float(np.exp(np.clip(self.bias, -30, 30)))
        forward, back = self._ratios
        while len(forward) < n:
            r, q = (forward[-1], odds * back[-1]) if forward else (None, None)
            forward.append(odds if r is None else odds * ((b + r * d) / (a + r * c)))
            back.append(1.0 if q is None else (c + d * q) / (a + b * q))
        x = np.array(forward[:n]) * np.array(back[:n])[::-1]
        return x / (1.0 + x)

    def __getstate__(self):
        return {"weights": self.weights, "bias": self.bias, "step": self.step, "scale": self.scale}

    def __setstate__(self, state):
        self.__dict__.update(state, known={}, _ratios=([], []))


class Vocabulary:
    """Numbers for words and features, so that documents are small arrays."""

    def __init__(self):
        self.words: dict[str, int] = {}
        self.features: dict[str, int] = {}
        self.of: list[np.ndarray] = []  # features of each word

    def numbers(self, text: str) -> np.ndarray:
        out = []
        for w in words(text):
            if w not in self.words:
                self.words[w] = len(self.words)
                self.of.append(np.array([self.features.setdefault(f, len(self.features)) for f in features(w)],
                                        dtype=np.int32))
            out.append(self.words[w])
        return np.array(out, dtype=np.int32)

    def features_in(self, doc: np.ndarray) -> np.ndarray:
        """Distinct features of a document."""
        return np.unique(np.concatenate([self.of[w] for w in np.unique(doc)] or [np.zeros(0, np.int32)]))


def choose_features(vocabulary: Vocabulary, docs: list[np.ndarray], toxic: list[int], least_z: float = 6.0,
                    least_odds: float = 3.0) -> list[int]:
    """Features that go with the label: among the documents' distinct words, the feature's share in
    toxic ones is more than ``least_odds`` times that in clean ones, by a likelihood-ratio test of
    ``least_z`` standard deviations (with a million features, none gets there by chance). A feature must
    be in 5 toxic documents, so that no single text brings its words in; of features in the same
    documents, the longest stays."""
    n = len(vocabulary.features)
    words, holders, total = np.zeros((2, n)), np.zeros(n, dtype=np.int64), np.zeros(2)
    for d, y in zip(docs, toxic):
        if len(d):
            fs, count = np.unique(np.concatenate([vocabulary.of[w] for w in np.unique(d)]), return_counts=True)
            words[y, fs] += count
            holders[fs] += y
            total[y] += len(np.unique(d))
    if not total.all():
        return []
    both = words.sum(axis=0)
    expected = both * (total / total.sum())[:, None]
    ratio = np.where(words > 0, words * np.log(np.maximum(words, 1) / expected), 0.0).sum(axis=0)
    z = np.sqrt(2 * np.maximum(ratio, 0.0))
    rare = words[0] * total[1] * least_odds <= words[1] * total[0]
    good = set(np.flatnonzero((z >= least_z) & rare & (holders >= 5)).tolist())
    where: dict[int, list[int]] = {f: [] for f in good}
    for i, (d, y) in enumerate(zip(docs, toxic)):
        for f in vocabulary.features_in(d).tolist():
            if f in good:
                where[f].append(i)
    names = {i: f for f, i in vocabulary.features.items() if i in good}
    alike = {tuple(where[f]): f for f in sorted(good, key=lambda f: (len(names[f].rstrip("*")), names[f]))}
    return sorted(alike.values(), key=lambda f: names[f])


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression (Newton's method)."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w))
        w -= np.linalg.solve(curve, x.T @ (p - y) + penalty * w)
    return w


def fit(texts: list[str], toxic: list[int], rounds: int = 150, rate: float = 1.0, decay: float = 1e-5,
        segment: int = 48) -> Model:
    """Fit on labelled documents. Words of toxic documents with a chosen feature are the labelled
    toxic words; all other words are clean. Words are fitted in segments of ``segment`` words; segments
    without any feature are alike if they are equally long, so each length is fitted once, with its number."""
    vocabulary = Vocabulary()
    docs = [vocabulary.numbers(t) for t in texts]
    numbers = choose_features(vocabulary, docs, toxic)
    names = {i: f for f, i in vocabulary.features.items()}
    chosen = [names[f] for f in numbers]
    index = {f: i for i, f in enumerate(numbers)}
    ids = [tuple(index[f] for f in fs.tolist() if f in index) for fs in vocabulary.of]
    rows, labels, times, plain = [], [], [], Counter()
    for doc, y in zip(docs, toxic):
        found = [ids[w] for w in doc.tolist()]
        for a in range(0, len(doc), segment):
            part = found[a:a + segment]
            if any(part):
                rows.append(part)
                labels.append([int(bool(y and f)) for f in part])
                times.append(1.0)
            else:
                plain[len(part)] += 1
    for n, count in sorted(plain.items()):
        rows.append([()] * n)
        labels.append([0] * n)
        times.append(float(count))
    if not chosen or not rows:
        return Model({}, -30.0, np.ones((2, 2)))
    m, times = len(rows), np.array(times)
    lengths = np.array([len(r) for r in rows])
    gold = np.zeros((segment, m))
    where = []
    for j, (r, g) in enumerate(zip(rows, labels)):
        gold[:len(g), j] = g
        where += [(i, j, f) for i, fs in enumerate(r) for f in fs]
    at, col, feat = (np.array(x, dtype=np.int64) for x in zip(*where))
    inside = np.arange(segment)[:, None] < lengths
    w, bias, link = np.zeros(len(chosen)), -3.0, np.zeros((2, 2))
    sums = [np.full(len(chosen), 1e-6), 1e-6, np.full((2, 2), 1e-6)]
    pairs = np.zeros((2, 2))
    both = inside[1:] & inside[:-1]
    for a in (0, 1):
        for b in (0, 1):
            pairs[a, b] = (((gold[:-1] == a) & (gold[1:] == b) & both) * times).sum()
    for _ in range(rounds):
        score = np.full((segment, m), bias)
        np.add.at(score, (at, col), w[feat])
        odds, step = np.exp(np.clip(score, -30, 30)), np.exp(link)
        p = marginals(np.where(inside, odds, 1.0), lengths, step)
        miss = np.where(inside, gold - p, 0.0) * times
        # pair marginals, from neighbouring marginals and the forward ratio
        r = np.empty((segment, m))
        r[0] = odds[0]
        for t in range(1, segment):
            r[t] = odds[t] * ((step[0, 1] + r[t - 1] * step[1, 1]) / (step[0, 0] + r[t - 1] * step[1, 0]))
        come = r[:-1] * step[1, 1] / (step[0, 1] + r[:-1] * step[1, 1])      # P(before = 1 | now = 1)
        come0 = r[:-1] * step[1, 0] / (step[0, 0] + r[:-1] * step[1, 0])     # P(before = 1 | now = 0)
        weigh = both * times
        e11, e10 = p[1:] * come, (1 - p[1:]) * come0
        expect = np.array([[(weigh * (1 - p[1:]) * (1 - come0)).sum(), (weigh * p[1:] * (1 - come)).sum()],
                           [(weigh * e10).sum(), (weigh * e11).sum()]])
        grads = [np.bincount(feat, weights=miss[at, col], minlength=len(chosen)) - decay * m * w,
                 miss.sum(), pairs - expect - decay * m * link]
        for i, g in enumerate(grads):
            sums[i] = sums[i] + g * g
        w = w + rate * grads[0] / np.sqrt(sums[0])
        bias = bias + rate * grads[1] / np.sqrt(sums[1])
        link = link + rate * grads[2] / np.sqrt(sums[2])
    model = Model({f: float(x) for f, x in zip(chosen, w)}, float(bias), np.exp(link))
    p = model.tag([words(t) for t in texts])
    x = np.array([[1.0, np.log1p(q.sum()), np.log1p(len(q))] for q in p])
    model.scale = tuple(_logistic(x, np.array(toxic, dtype=float)).tolist())
    return model
