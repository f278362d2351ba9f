"""Sparse logistic regression on hashed features, trained by following the regularised leader."""

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class Leader:
    """FTRL-proximal: every weight is the best one for all gradients so far, with its own rate."""

    size: int
    rate: float = 0.5
    smooth: float = 1.0
    l1: float = 0.05
    l2: float = 0.05
    #: What every margin begins with, such as the log odds of the labels; it is not learnt.
    offset: float = 0.0

    def __post_init__(self):
        self.sums, self.squares = np.zeros(self.size), np.zeros(self.size)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        sums, squares = self.sums[at], self.squares[at]
        shrunk = np.sign(sums) * self.l1 - sums
        scale = (self.smooth + np.sqrt(squares)) / self.rate + self.l2
        return np.where(np.abs(sums) <= self.l1, 0.0, shrunk / scale)

    def learn(self, at: np.ndarray, values: np.ndarray, target: float, weight: float = 1.0) -> None:
        """One example: distinct features with their values, and the probability of label 1."""
        weights = self.weights(at)
        gradient = (sigmoid(self.offset + weights @ values) - target) * values * weight
        after = self.squares[at] + gradient * gradient
        step = (np.sqrt(after) - np.sqrt(self.squares[at])) / self.rate
        self.sums[at] += gradient - step * weights
        self.squares[at] = after


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def log_odds(targets: Sequence[float]) -> float:
    """Of label 1, counted with one example of either label more than there are."""
    ones = float(sum(targets))
    return float(np.log((ones + 1) / (len(targets) - ones + 1)))


def train(
    examples: Sequence[tuple[np.ndarray, np.ndarray, float]], size: int, epochs: int,
    weights: Iterable[float] | None = None, seed: int = 0, **options: float,
) -> np.ndarray:
    """The weights after some epochs over the examples, each in another fixed order."""
    model = Leader(size, **options)
    importance = np.ones(len(examples)) if weights is None else np.asarray(list(weights))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(examples)):
            at, values, target = examples[i]
            model.learn(at, values, target, importance[i])
    return model.weights()
