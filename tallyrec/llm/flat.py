"""Texts of a slice as one array of code points, for operators that work on numpy columns."""

from __future__ import annotations

import numpy as np

M = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hashes (arithmetic modulo 2**64)


def code_points(texts: list[str | None], front: int = 1, back: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each framed by blanks, and the first index of each (with the total at the end)."""
    framed = [f"{' ' * front}{t or ''}{' ' * back}" for t in texts]
    begin = np.concatenate([[0], np.cumsum([len(t) for t in framed])]).astype(np.int64)
    return np.frombuffer("".join(framed).encode("utf-32-le", "surrogatepass"), np.uint32), begin


def squeeze(codes: np.ndarray, begin: np.ndarray, front: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Without repeated blanks (32), but for the ``front`` blanks at the head of each text."""
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    for i in range(front):
        keep[np.minimum(begin[:-1] + i, max(len(codes) - 1, 0))] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return codes[keep], kept[begin]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (multiply and shift, twice)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n code points that start at each index (the last n - 1 indexes have none)."""
    c = codes.astype(np.uint64) + np.uint64(1)
    size = max(len(c) - n + 1, 0)
    h = np.zeros(size, np.uint64)
    for i in range(n):
        h = h * M + c[i:i + size]
    return mix(h)


def sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of values[begin[i]:begin[i + 1]] (rows of a matrix too); 0 for an empty range."""
    n = len(begin) - 1
    out = np.zeros((n,) + values.shape[1:], np.float64)
    full = begin[1:] > begin[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, begin[:-1][full], axis=0, dtype=np.float64)
    return out


def words(codes: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every blank-separated word, and the first word of each text (with the total at the end).

    A word's hash is a difference of running sums of code * M**i, scaled back by the inverse power.
    """
    blank = codes == 32
    first = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    after = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    power = np.ones(len(codes), np.uint64)
    if len(power) > 1:
        power[1:] = M
        np.multiply.accumulate(power, out=power)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * power, dtype=np.uint64)])
    inverse = np.uint64(pow(int(M), -1, 1 << 64))
    back = np.ones(len(codes), np.uint64)
    if len(back) > 1:
        back[1:] = inverse
        np.multiply.accumulate(back, out=back)
    return mix((total[after] - total[first]) * back[first]), np.searchsorted(first, begin)
