"""A linear-chain conditional random field over words, trained and decoded in numpy, many sequences at a time."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Crf:
    """Weights per known feature and label, and per pair of labels; the last feature row is for all unknown ones."""

    labels: tuple[str, ...]
    features: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray

    def emissions(self, sequences: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """(scores of shape sequences x places x labels, lengths)."""
        index, lengths = _indexed(sequences, self.features)
        return self.weights[index].sum(axis=2), lengths

    def decode(self, sequences: list[list[list[str]]]) -> list[list[str]]:
        """The likeliest labels of each sequence, by Viterbi over all sequences at once."""
        if not sequences:
            return []
        scores, lengths = self.emissions(sequences)
        n, places, k = scores.shape
        best, back = scores[:, 0], np.zeros((n, places, k), dtype=np.int64)
        for t in range(1, places):
            ways = best[:, :, None] + self.moves[None]
            back[:, t] = ways.argmax(axis=1)
            best = np.where((t < lengths)[:, None], ways.max(axis=1) + scores[:, t], best)
        found = np.zeros((n, places), dtype=np.int64)
        state, rows = best.argmax(axis=1), np.arange(n)
        for t in range(places - 1, -1, -1):
            found[:, t] = state
            state = np.where((t < lengths) & (t > 0), back[rows, t, state], state)
        return [[self.labels[x] for x in row[:length]] for row, length in zip(found.tolist(), lengths.tolist())]


def _indexed(sequences: list[list[list[str]]], features: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in sequences])
    wide = max(len(place) for s in sequences for place in s)
    index = np.full((len(sequences), lengths.max(), wide), len(features), dtype=np.int64)
    for i, sequence in enumerate(sequences):
        for t, place in enumerate(sequence):
            for j, name in enumerate(place):
                index[i, t, j] = features.get(name, len(features))
    return index, lengths


def _sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def train(sequences: list[list[list[str]]], labels: list[list[str]], steps: int = 250, rate: float = 0.1, decay: float = 0.02) -> Crf:
    """Maximum likelihood with a Gaussian prior, by Adam over the whole table, which must be small."""
    names = tuple(sorted({x for row in labels for x in row}))
    features = {name: i for i, name in enumerate(sorted({f for s in sequences for place in s for f in place}))}
    index, lengths = _indexed(sequences, features)
    n, places = index.shape[:2]
    k = len(names)
    gold = np.zeros((n, places), dtype=np.int64)
    for i, row in enumerate(labels):
        gold[i, : len(row)] = [names.index(x) for x in row]
    live = np.arange(places)[None] < lengths[:, None]
    truth = np.eye(k)[gold] * live[..., None]
    gold_moves = np.einsum("ntj,ntk->jk", truth[:, :-1], truth[:, 1:])
    weights, moves = np.zeros((len(features) + 1, k)), np.zeros((k, k))
    state = [np.zeros_like(x) for x in (weights, weights, moves, moves)]
    for step in range(1, steps + 1):
        scores = weights[index].sum(axis=2)
        ahead, behind = np.zeros((n, places, k)), np.zeros((n, places, k))
        ahead[:, 0] = scores[:, 0]
        for t in range(1, places):
            new = _sum(ahead[:, t - 1, :, None] + moves[None], 1) + scores[:, t]
            ahead[:, t] = np.where(live[:, t, None], new, ahead[:, t - 1])
        for t in range(places - 2, -1, -1):
            new = _sum(moves[None] + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(live[:, t + 1, None], new, 0.0)
        total = _sum(ahead[:, -1], 1)
        single = np.exp(ahead + behind - total[:, None, None]) * live[..., None]
        double = np.zeros((k, k))
        for t in range(1, places):
            pair = ahead[:, t - 1, :, None] + moves[None] + (scores[:, t] + behind[:, t])[:, None, :]
            double += (np.exp(pair - total[:, None, None]) * live[:, t, None, None]).sum(axis=0)
        slope = np.zeros_like(weights)
        np.add.at(slope, index, (truth - single)[:, :, None, :])
        slope[-1] = 0.0
        for values, change, first, second in ((weights, slope - decay * weights, *state[:2]), (moves, gold_moves - double - decay * moves, *state[2:])):
            first += 0.1 * (change - first)
            second += 0.001 * (change * change - second)
            values += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights[-1] = 0.0
    return Crf(names, features, weights, moves)
