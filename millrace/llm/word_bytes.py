"""Words of UTF-8 bytes as 64-bit hashes, for whole batches at a time."""

from __future__ import annotations

import numpy as np

# ASCII white space (space, and 9 to 13), and ASCII punctuation.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
BASE = np.uint64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def word_table(marks: bool) -> np.ndarray:
    """Which bytes belong to words; ``marks`` says whether punctuation does."""
    table = np.ones(256, bool)
    table[np.frombuffer(SPACES if marks else SPACES + MARKS, np.uint8)] = False
    return table


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread each number over all its bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int, base: np.uint64 = BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i below n."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    up, down = np.full(n, base, np.uint64), np.full(n, inverse, np.uint64)
    if n:
        up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


class Words:
    """Splits batches of lower-cased bytes into hashed words; keeps the powers it has made."""

    def __init__(self, marks: bool):
        self.member = word_table(marks)
        self.up, self.down = powers(1 << 16)

    def __call__(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, first word of each row and one past the last, begin, end of each word in bytes)."""
        n = len(data)
        if n + 1 > len(self.up):
            self.up, self.down = powers(2 * (n + 1))
        data = LOWER[data]
        member = self.member[data]
        edge = np.empty(n, bool)
        # A word begins where its byte is the first of a row or follows a byte outside words.
        if n:
            edge[0] = True
            edge[1:] = ~member[:-1]
            inner = starts[(starts > 0) & (starts < n)]
            edge[inner] = True
        begin = np.flatnonzero(member & edge)
        stop = np.empty(n, bool)
        if n:
            stop[-1] = True
            stop[:-1] = ~member[1:]
            stop[inner - 1] = True
        end = np.flatnonzero(member & stop) + 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        hashes = mixed((sums[end] - sums[begin]) * self.down[begin])
        return hashes, np.searchsorted(begin, starts), begin, end
