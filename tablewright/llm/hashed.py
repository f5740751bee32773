"""Hashed word n-grams as sparse features, and logistic regression on them by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np

from .words import WordHashes, mix

#: Features are hashed to this many bits, so that two of a text's features hardly ever share one.
BITS = 40

Row = tuple[np.ndarray, np.ndarray]  # features (sorted, distinct) and their values


class Grams:
    """Features of texts. Words are split at white space, with A-Z in lower case.

    Streams of symbols are hashed to n-grams:
    words without the punctuation around them (1 and 2), the first letters of words (1), and
    shapes (1 to 3): is a word in capitals, what punctuation stands before and after it, does it repeat the one before.
    """

    PREFIX = 5
    PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())

    def __init__(self, shapes: bool):
        self.shapes = shapes
        self.hash = WordHashes(11)
        self.known: dict[bytes, tuple[int, int, int]] = {}

    def __call__(self, text: str | None) -> Row:
        words = (text or "").encode().split()
        if not words:
            return np.empty(0, np.uint64), np.empty(0, np.float64)
        codes = np.array(list(map(self._codes, words)), np.uint64)
        core, start, shape = codes[:, 0], codes[:, 1], codes[:, 2]
        streams = [core, self._pairs(core, 1), start]
        if self.shapes:
            shape = np.where(np.concatenate([[False], core[1:] == core[:-1]]), np.uint64(1), shape)
            streams += [mix(shape), self._pairs(shape, 2), self._pairs(self._pairs(shape, 3), 4)]
        features, counts = np.unique(np.concatenate(streams) >> np.uint64(64 - BITS), return_counts=True)
        return features, counts.astype(np.float64)

    @staticmethod
    def _pairs(codes: np.ndarray, tag: int) -> np.ndarray:
        return mix(codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:] + np.uint64(tag))

    def _codes(self, word: bytes) -> tuple[int, int, int]:
        known = self.known.get(word)
        if known is None:
            core = word.strip(self.PUNCTUATION)
            at = word.find(core) if core else len(word)
            form = b"A" if len(core) > 1 and core.isupper() else b"a" if core else b""
            low = core.decode().lower() if core else ""
            shape = word[:at][:4] + form + word[at + len(core) :][:4] + b" shape"
            known = self.hash[low.encode()], self.hash[low[: self.PREFIX].encode() + b" prefix"], self.hash[shape]
            if len(self.known) >= 200_000:
                self.known.clear()
            self.known[word] = known
        return known


@dataclass
class Model:
    """Weights of the features that have one, sorted by feature."""

    features: np.ndarray
    weights: np.ndarray
    bias: float
    normed: bool

    def raw(self, row: Row) -> float:
        features, values = values_of(row, self.normed)
        at = np.searchsorted(self.features, features)
        at[at == len(self.features)] = 0
        hit = self.features[at] == features if len(self.features) else np.zeros(len(features), bool)
        return self.bias + float(values[hit] @ self.weights[at[hit]])

    def score(self, row: Row) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(row), -30, 30))))


def values_of(row: Row, normed: bool) -> Row:
    """With ``normed`` logarithmic counts of unit length, else one for each feature that occurs."""
    features, counts = row
    if not normed:
        return features, np.ones(len(features))
    logs = 1 + np.log(counts)
    return features, logs / max(1.0, float(np.sqrt(logs @ logs)))


def ftrl(
    rows: Sequence[Row],
    labels: Sequence[int],
    swapped: Sequence[Iterable[Row]] | None = None,
    *,
    normed: bool,
    least_rows: int = 5,
    alpha: float = 0.3,
    beta: float = 1.0,
    l1: float = 1.0,
    l2: float = 1.0,
    balance: float = 0.0,
    epochs: int = 4,
    seed: int = 3,
) -> Model:
    """Logistic regression by follow-the-regularised-leader updates, one row at a time.

    Features that fewer than ``least_rows`` rows have are left out: they say nothing about other texts.
    ``swapped`` has for each row its counterfactual versions; ``balance`` times half the squared difference of the raw
    scores of a row and each version is added to the loss.
    """
    seen, held = np.unique(np.concatenate([f for f, _ in rows] or [np.empty(0, np.uint64)]), return_counts=True)
    features = seen[held >= least_rows]

    def known(row: Row) -> Row:
        f, v = values_of(row, normed)
        at = np.searchsorted(features, f)
        at[at == len(features)] = 0
        hit = features[at] == f if len(features) else np.zeros(len(f), bool)
        return at[hit], v[hit]

    rows = [known(r) for r in rows]
    other = [[known(r) for r in versions] for versions in swapped] if swapped else [[] for _ in rows]
    z, n = np.zeros(len(features) + 1), np.zeros(len(features) + 1)
    bias = len(features)

    def weights(at: np.ndarray) -> np.ndarray:
        own = np.where(at == bias, 0.0, l1)
        w = -(z[at] - np.sign(z[at]) * own) / ((beta + np.sqrt(n[at])) / alpha + l2)
        return np.where(np.abs(z[at]) <= own, 0.0, w)

    def step(at: np.ndarray, gradient: np.ndarray, w: np.ndarray) -> None:
        more = n[at] + gradient * gradient
        z[at] += gradient - (np.sqrt(more) - np.sqrt(n[at])) / alpha * w
        n[at] = more

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, v = np.append(rows[i][0], bias), np.append(rows[i][1], 1.0)
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w @ v, -30, 30)))
            step(at, (p - labels[i]) * v, w)
            for far, u in other[i]:
                both = np.union1d(at[:-1], far)
                change = np.zeros(len(both))
                change[np.searchsorted(both, at[:-1])] += v[:-1]
                change[np.searchsorted(both, far)] -= u
                both, change = both[change != 0], change[change != 0]
                if len(both):
                    w = weights(both)
                    step(both, balance * float(w @ change) * change, w)
    every = np.arange(len(features) + 1)
    w = weights(every)
    kept = np.flatnonzero(w[:-1])
    return Model(features[kept], w[kept], float(w[-1]), normed)
