"""Shingle sets of texts, SetSketch registers over them, and joint estimates from two sketches.

Register ``j`` of a set holds ``floor(1 - log_b(e))`` of the smallest of the exponential numbers that the
set's members draw for ``j``, cut to 16 bits. Registers of a union are the higher ones of both, and equal
registers are as likely as two sets are similar, so bands of registers find similar sets.
"""

from __future__ import annotations

import numpy as np
import xxhash

BASE = 1.001
RATE = 20.0
TOP = 2**16 - 1

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FINAL = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(31)


def words_of(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case; bytes split at the six blanks and nowhere else."""
    return (text or "").encode().lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _SHIFT)) * _FINAL
    return values ^ (values >> _SHIFT)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted hashes of the distinct shingles of ``size`` words; shorter texts are one shingle, empty ones none."""
    hashes = word_hashes(words_of(text))
    if not len(hashes):
        return hashes
    length = min(size, len(hashes))
    combined = np.full(len(hashes) - length + 1, length, np.uint64)
    for at in range(length):
        combined = _mixed((combined + hashes[at : at + len(combined)]) * _MIX)
    return np.unique(combined)


def multipliers(registers: int) -> np.ndarray:
    draw = np.random.Generator(np.random.PCG64(20240229))
    return draw.integers(0, 2**63, registers, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(members: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Registers of one set, 16 bits each."""
    lowest = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(members), 512):
        drawn = members[start : start + 512, None] * factors
        np.minimum(lowest, drawn.min(axis=0), out=lowest)
    uniform = ((lowest >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53
    exponential = -np.log1p(-uniform) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP).astype(np.uint16)


def band_keys(registers: np.ndarray, rows: int) -> np.ndarray:
    """One number for each band of each sketch, bands kept apart; ``registers`` has a sketch in each row."""
    bands = registers.shape[1] // rows
    parts = registers[:, : bands * rows].reshape(len(registers), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2])
    for at in range(rows):
        keys = _mixed((keys + parts[:, :, at]) * _MIX)
    return keys.view(np.int64)


def estimate(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Most likely similarity of each pair, from which registers are higher, lower and equal.

    With the set sizes known, the chance that the left register is higher falls with the similarity J as
    ``p(u - v J)``, the right one's as ``p(v - u J)``, where u and v are the shares of the sizes and
    ``p(x) = -log_b(1 - x (b - 1) / b)``. The log likelihood is concave in J; a section search finds its top.
    """
    higher = (left > right).sum(axis=1)
    lower = (left < right).sum(axis=1)
    equal = left.shape[1] - higher - lower
    u = n_left / (n_left + n_right)
    v = 1 - u

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        more, less = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return (
            higher * np.log(np.maximum(more, tiny))
            + lower * np.log(np.maximum(less, tiny))
            + equal * np.log(np.maximum(1 - more - less, tiny))
        )

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):
        a, b = low + (high - low) * 0.382, low + (high - low) * 0.618
        left_better = likelihood(a) >= likelihood(b)
        high, low = np.where(left_better, b, high), np.where(left_better, low, a)
    return (low + high) / 2
