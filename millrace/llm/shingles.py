"""Word shingles of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

from functools import cache

import numpy as np

_U = np.uint64
_M = 0xD6E8FEB86659FD93  # odd, so it has an inverse modulo 2**64
_MASK = (1 << 64) - 1
_INVERSE = pow(_M, -1, 1 << 64)
SPACES = [0x20, *range(0x09, 0x0E)]


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


@cache
def _byte_values() -> np.ndarray:
    values = mixed(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


class _Powers:
    """Powers of the multiplier and of its inverse, as many as were ever needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            k = len(self.up)
            self.up = np.concatenate((self.up, self.up * _U(pow(_M, k, 1 << 64))))
            self.down = np.concatenate((self.down, self.down * _U(pow(_INVERSE, k, 1 << 64))))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A hash of every word, and the number of words of every text.

    Words are runs of anything but the six ASCII white-space characters; A-Z count as
    a-z. The hash is a polynomial over random byte values, from prefix sums.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = np.zeros(256, bool)
    space[SPACES] = True
    inside = ~space[data]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _POWERS.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * up[:-1], out=sums[1:])
    hashes = mixed((sums[stops] - sums[starts]) * down[starts] + (stops - starts).astype(np.uint64))
    ends = np.cumsum(sizes + 1)
    words = np.diff(np.searchsorted(starts, ends), prepend=0)
    return hashes, words


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    A text of fewer than ``size`` words has its whole sequence as its one shingle; a text
    without words has none. Two shingles get one hash with a chance of about 2**-64.
    """
    hashes, words = word_hashes([t.encode("utf-8") for t in texts])
    n = len(hashes)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        weight = _U(pow(_M, 7 * k + 3, 1 << 64))
        if k < n:
            rolled[: n - k] += hashes[k:] * weight
    rolled = mixed(rolled)
    out, at = [], 0
    for count in words.tolist():
        if count >= size:
            out.append(np.unique(rolled[at : at + count - size + 1]))
        elif count:
            short = hashes[at : at + count]
            value = 0
            for k, h in enumerate(short.tolist()):
                value = (value + h * pow(_M, 7 * k + 3, 1 << 64)) & _MASK
            out.append(mixed(np.array([value ^ (count << 56)], np.uint64)))
        else:
            out.append(np.empty(0, np.uint64))
        at += count
    return out
