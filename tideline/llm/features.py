"""Hashed byte n-grams of whole texts, and linear models on them."""

from __future__ import annotations

import numpy as np

#: Dimensions of the hashed space, a power of two; a dense model has so many weights.
DIMENSIONS = 1 << 13
GRAMS = (1, 2, 3)
#: Bytes whose n-grams are hashed at once.
CHUNK = 1 << 20
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def gram_counts(text: bytes, dimensions: int = DIMENSIONS, grams: tuple[int, ...] = GRAMS) -> np.ndarray:
    """How often each dimension's n-grams occur in the text."""
    counts = np.zeros(dimensions, np.int64)
    reach = max(grams) - 1
    for start in range(0, len(text), CHUNK):
        data = np.frombuffer(text[start : start + CHUNK + reach], np.uint8).astype(np.uint32)
        limit = min(CHUNK, len(text) - start)
        h = np.zeros(len(data), np.uint32)
        for n in range(1, max(grams) + 1):
            if len(data) < n:
                break
            h = h[: len(data) - n + 1] * _MULTIPLIERS[0] + (data[n - 1 :] + np.uint32(n)) * _MULTIPLIERS[1]
            if n in grams:
                mixed = (h[:limit] ^ (h[:limit] >> np.uint32(15))) * _MULTIPLIERS[2]
                counts += np.bincount(mixed >> np.uint32(32 - (dimensions - 1).bit_length()), minlength=dimensions)
    return counts


def unit(counts: np.ndarray) -> np.ndarray:
    """Roots of the shares: a vector of length one, zero for an empty text."""
    total = counts.sum()
    return np.sqrt(counts / total) if total else np.zeros(len(counts))


def sparse(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(x)
    return at.astype(np.int32), x[at].astype(np.float32)


def dense(rows: list[tuple[list[int], list[float]]], dimensions: int = DIMENSIONS) -> np.ndarray:
    m = np.zeros((len(rows), dimensions + 1), np.float32)
    for row, (at, x) in zip(m, rows, strict=True):
        row[at] = x
    m[:, dimensions] = 1.0  # intercept
    return m


def descend(gradient, dimensions: int, lipschitz: float, steps: int) -> np.ndarray:
    """Accelerated gradient descent from zero; deterministic."""
    w = v = np.zeros(dimensions)
    t = 1.0
    for _ in range(steps):
        new = v - gradient(v) / lipschitz
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w


class SparseRows:
    """Rows with an intercept, stored sparsely; multiplies like the matrix of :func:`dense`."""

    def __init__(self, rows: list[tuple[list[int], list[float]]], dimensions: int = DIMENSIONS) -> None:
        sizes = np.array([len(at) for at, _ in rows], np.int64)
        self.shape = (len(rows), dimensions + 1)
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
        self.at = np.concatenate([np.asarray(at, np.int32) for at, _ in rows])
        self.x = np.concatenate([np.asarray(x, np.float32) for _, x in rows])

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.x * w[self.at], self.shape[0]) + w[-1]

    def transposed_times(self, v: np.ndarray) -> np.ndarray:
        out = np.bincount(self.at, self.x * v[self.row], self.shape[1])
        out[-1] = v.sum()
        return out


def fit_svm(
    m: np.ndarray | SparseRows,
    positive: np.ndarray,
    weight: np.ndarray | None = None,
    ridge: float = 1e-4,
    steps: int = 200,
) -> np.ndarray:
    """Linear support vector machine, squared hinge loss, both sides weighted alike; ``weight`` shares a side among its rows."""
    y = np.where(positive, 1.0, -1.0)
    weight = np.ones(len(y)) if weight is None else weight
    up, down = weight[positive].sum(), weight[~positive].sum()
    share = weight * np.where(positive, 0.5 / (up or 1.0), 0.5 / (down or 1.0))
    if isinstance(m, SparseRows):
        times, back = m.times, m.transposed_times
    else:
        times, back = (lambda w: m @ w.astype(m.dtype)), (lambda v: m.T @ v.astype(m.dtype))

    def gradient(w: np.ndarray) -> np.ndarray:
        slack = np.maximum(0.0, 1.0 - y * times(w))
        return ridge * w - 2.0 * back(share * y * slack)

    return descend(gradient, m.shape[1], ridge + 4.0, steps)


def fit_logistic(m: np.ndarray, target: np.ndarray, ridge: float = 1e-5, steps: int = 300) -> np.ndarray:
    """Logistic regression on soft labels between 0 and 1, both sides weighted alike."""
    up, down = max(1e-9, target.sum()), max(1e-9, (1 - target).sum())
    share = 0.5 * (target / up + (1 - target) / down)
    aim = 0.5 * target / up

    def gradient(w: np.ndarray) -> np.ndarray:
        p = 1.0 / (1.0 + np.exp(-np.clip(m @ w.astype(m.dtype), -40, 40)))
        return ridge * w + m.T @ (share * p - aim).astype(m.dtype)

    return descend(gradient, m.shape[1], ridge + 0.5, steps)


def margin(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Margins of models (rows of ``w``) for one text."""
    return w[:, :-1] @ x + w[:, -1]
