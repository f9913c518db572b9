"""Suffix arrays of byte buffers in numpy: prefix doubling on unsorted groups, and common prefixes."""

from __future__ import annotations

import numpy as np

WORD = 8      # bytes that the first sort looks at
STRIDE = 32   # positions in one chain of common prefixes


def words_at(text: np.ndarray, pad: int) -> np.ndarray:
    """The next eight bytes at each position as a number that sorts like them; zeros stand past the end, and at
    ``pad`` more positions."""
    padded = np.concatenate([text, np.zeros(pad + WORD, np.uint8)])
    out = np.zeros(len(text) + pad, np.uint64)
    for k in range(WORD):
        out <<= np.uint64(8)
        out |= padded[k:len(out) + k]
    return out


def suffix_order(words: np.ndarray, n: int, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffixes in order of at least their first ``reach`` bytes, which of them share half of that with another).

    Larsson and Sadakane's refinement: suffixes are sorted by their first bytes and numbered by the start of
    their group; each round sorts only groups that still have several members, by the number of the suffix as many
    bytes later as are sorted already, and so doubles those.
    """
    order = np.argsort(words[:n])
    key = words[order]
    heads = np.r_[True, key[1:] != key[:-1]] if n else np.zeros(0, bool)
    start = np.flatnonzero(heads)
    number = np.zeros(len(words), np.int64)   # past the end: before all others
    number[order] = start[np.cumsum(heads) - 1] + 1 if n else 0
    size = np.diff(np.r_[start, n])
    places = np.flatnonzero(np.repeat(size > 1, size))
    near = np.zeros(n, bool)
    done = WORD
    while done < reach and len(places):
        if 2 * done >= reach:
            near[order[places]] = True
        suffix = order[places]
        key = number[suffix] * (n + 2) + number[np.minimum(suffix + done, len(number) - 1)]
        by = np.argsort(key)
        suffix, key = suffix[by], key[by]
        order[places] = suffix
        heads = np.r_[True, key[1:] != key[:-1]]
        start = np.flatnonzero(heads)
        number[suffix] = places[start[np.cumsum(heads) - 1]] + 1
        size = np.diff(np.r_[start, len(places)])
        places = places[np.repeat(size > 1, size)]
        done *= 2
    # What is left in a group goes by position, as common_prefixes likes it.
    suffix = order[places]
    order[places] = suffix[np.argsort(number[suffix] * (n + 2) + suffix)]
    return order, near


def common_prefixes(words: np.ndarray, order: np.ndarray, asked: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of each suffix with the one before it in ``order``, up to ``most`` (0 where not
    asked for), by position in ``order``.

    Kasai's bound: the suffix one byte on shares at least one byte less with the one before it. It is carried from
    position to position in text order, in chains that each start anew after STRIDE positions and that advance side by
    side. As suffixes are in order of their first bytes only, it holds after ``most`` shared bytes only if the suffix
    before has moved on by one byte as well.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n + 1, np.int64)
    for r in range(min(STRIDE, n)):
        at = np.arange(r, n, STRIDE)
        at = at[asked[at] & (before[at] >= 0)]
        other = before[at]
        got = np.zeros(len(at), np.int64)
        if r:
            bound = (shared[at - 1] < most) | (other == before[at - 1] + 1)
            got[bound] = np.maximum(shared[at[bound] - 1] - 1, 0)
        active = np.arange(len(at))
        while len(active):
            a, g = at[active], got[active]
            differ = words[a + g] ^ words[other[active] + g]
            equal = np.full(len(a), WORD, np.int64)
            odd = differ != 0
            d = differ[odd]
            equal[odd] = sum((d < np.uint64(1 << (56 - 8 * k))).astype(np.int64) for k in range(WORD))
            got[active] = g + equal
            active = active[(equal == WORD) & (got[active] < most)]
        shared[at] = np.minimum(got, most)
    return np.minimum(shared[:n], most)[order]


def repeated(text: np.ndarray, length: int) -> np.ndarray:
    """For each position the first position whose next ``length`` bytes are the same (itself if none is before).

    Near the end, where fewer bytes are left, zeros stand for the missing ones.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    reach = WORD
    while reach < length:
        reach *= 2
    words = words_at(text, 2 * reach + WORD)
    order, near = suffix_order(words, n, reach)
    prefix = common_prefixes(words, order, near, length)
    group = np.cumsum(prefix < length) - 1
    first = np.full(int(group[-1]) + 1, n, np.int64)
    np.minimum.at(first, group, order)
    out = np.empty(n, np.int64)
    out[order] = first[group]
    return out
