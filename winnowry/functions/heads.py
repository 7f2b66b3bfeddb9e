"""Heads of a quality model over window vectors, in numpy with weights as parameters: batches of documents of unequal lengths, masked."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass(frozen=True)
class Recurrent:
    """LSTM weights; rows are the input, forget, cell and output gates of `size` units each."""

    inputs: np.ndarray
    hidden: np.ndarray
    bias: np.ndarray

    @property
    def size(self) -> int:
        return self.hidden.shape[1]

    def run(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Outputs (documents, windows, size) of x (documents, windows, inputs); after a document's end they stay as they were."""
        n, steps, _ = x.shape
        h, c, out = np.zeros((n, self.size)), np.zeros((n, self.size)), np.zeros((n, steps, self.size))
        for t in range(steps):
            i, f, g, o = np.split(x[:, t] @ self.inputs.T + h @ self.hidden.T + self.bias, 4, axis=1)
            fresh = sigmoid(f) * c + sigmoid(i) * np.tanh(g)
            inside = (t < lengths)[:, None]
            c = np.where(inside, fresh, c)
            h = np.where(inside, sigmoid(o) * np.tanh(fresh), h)
            out[:, t] = h
        return out


@dataclass(frozen=True)
class SegmentHead:
    """An LSTM over a document's windows, additive attention over its outputs, and a linear layer."""

    recurrent: Recurrent
    attention: np.ndarray
    attention_bias: np.ndarray
    query: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """A number for each document; 0 where it has no windows."""
        out = self.recurrent.run(x, lengths)
        level = np.tanh(out @ self.attention + self.attention_bias) @ self.query
        level = np.where(np.arange(x.shape[1]) < lengths[:, None], level, -np.inf)
        some = lengths > 0
        top = np.where(some, np.max(level, axis=1, initial=-np.inf), 0.0)
        share = np.exp(level - top[:, None])
        share /= np.where(some, share.sum(axis=1), 1.0)[:, None]
        return np.where(some, np.einsum("ns,nsh->nh", share, out) @ self.weight + self.bias, 0.0)


@dataclass(frozen=True)
class TokenHead:
    """A linear layer over the largest value of each unit among a window's tokens, and the window's own vector."""

    weight: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weight + self.bias


@dataclass(frozen=True)
class Windows:
    """A stand-in encoder of windows: token vectors from a table, a tanh layer; the window's vector is their mean. Gives the largest value of each unit and the mean."""

    table: np.ndarray
    layer: np.ndarray

    def __call__(self, planes: np.ndarray) -> np.ndarray:
        ids, mask = planes[:, 0], planes[:, 2] > 0
        x = np.tanh(self.table[ids % len(self.table)] @ self.layer)
        top = np.where(mask[:, :, None], x, -np.inf).max(axis=1)
        mean = (x * mask[:, :, None]).sum(axis=1) / mask.sum(axis=1)[:, None]
        return np.concatenate([top, mean], axis=1)


@dataclass(frozen=True)
class Model:
    """Scores in lo .. hi: of the first window's tokens and, where there is a head for them, of all windows."""

    tokens: TokenHead
    segments: SegmentHead | None = None
    lo: float = 0.0
    hi: float = 1.0

    def __call__(self, documents: list[np.ndarray]) -> np.ndarray:
        """One number for each document, from its windows' vectors; nan for documents without windows."""
        lengths = np.array([len(d) for d in documents], np.int64)
        out = np.full(len(documents), np.nan)
        some = np.flatnonzero(lengths)
        if len(some):
            wide = documents[some[0]].shape[1]
            x = np.zeros((len(some), int(lengths.max()), wide))
            for k, i in enumerate(some.tolist()):
                x[k, : lengths[i]] = documents[i]
            total = self.tokens.score(x[:, 0])
            if self.segments is not None:
                total = total + self.segments.score(x[:, :, wide // 2 :], lengths[some])
            out[some] = self.lo + (self.hi - self.lo) * sigmoid(total)
        return out


def example(units: int = 6, hidden: int = 5, words: int = 512) -> tuple[Windows, Model]:
    """An encoder and a model whose weights follow a rule; for tests and as a template."""

    def wave(*shape: int, step: float = 0.7) -> np.ndarray:
        return np.sin(step * np.arange(1, int(np.prod(shape)) + 1)).reshape(shape)

    recurrent = Recurrent(wave(4 * hidden, units), wave(4 * hidden, hidden, step=0.3), wave(4 * hidden, step=1.1))
    segments = SegmentHead(recurrent, wave(hidden, hidden, step=0.9), wave(hidden, step=0.2), wave(hidden, step=0.5), wave(hidden, step=1.3), 0.1)
    return Windows(wave(words, units, step=0.37), wave(units, units, step=0.53)), Model(TokenHead(wave(2 * units, step=0.8), -0.2), segments)
