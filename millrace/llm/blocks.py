"""Links inside hot candidate groups, found block by block without emitting the pairs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def spanning_links(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, least node) that join what a matrix of links between two id arrays joins.

    Labels run back and forth over the matrix until they stand still, so a block of n by m yields at most
    n + m links whatever the number of pairs.
    """
    top = np.iinfo(np.int64).max
    rows, cols = linked.any(1), linked.any(0)
    linked, left, right = linked[rows][:, cols], left[rows], right[cols]
    if not linked.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    mine, theirs = left.astype(np.int64), right.astype(np.int64)
    while True:
        to_left = np.minimum(mine, np.where(linked, theirs[None, :], top).min(1))
        to_right = np.minimum(theirs, np.where(linked, to_left[:, None], top).min(0))
        # The same node may stand on both sides.
        ids = np.concatenate([left, right])
        labels = np.concatenate([to_left, to_right])
        order = np.lexsort((labels, ids))
        ids_sorted = ids[order]
        least = np.r_[True, ids_sorted[1:] != ids_sorted[:-1]]
        unique, label = ids_sorted[least], labels[order][least]
        to_left, to_right = label[np.searchsorted(unique, left)], label[np.searchsorted(unique, right)]
        if (to_left == mine).all() and (to_right == theirs).all():
            break
        mine, theirs = to_left, to_right
    moved = unique != label
    return unique[moved], label[moved]


class Joined:
    """Which of the links that pass by join something new. Beyond ``most`` nodes all are forgotten: then links come
    again, but none is lost."""

    def __init__(self, most: int):
        self.most, self.parent = most, {}

    def top(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def new(self, u: list[int], v: list[int]) -> list[bool]:
        out = []
        for a, b in zip(u, v):
            if len(self.parent) > self.most:
                self.parent = {}
            a, b = self.top(a), self.top(b)
            out.append(a != b)
            self.parent[max(a, b)] = min(a, b)
        return out


def sorted_groups(batches, keys: int):
    """Groups of equal leading ``keys`` columns from Arrow batches sorted by them: lists of numpy columns, the
    list columns as 2-d arrays. Only one group is held beyond the batch that is read."""
    held: list[list[np.ndarray]] = []

    def joined(parts):
        return [np.concatenate(c) if len(c) > 1 else c[0] for c in zip(*parts)]

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = []
        for c in batch.columns:
            if hasattr(c, "flatten") and str(c.type).startswith(("list", "large_list")):
                columns.append(c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1))
            else:
                columns.append(c.to_numpy(zero_copy_only=False))
        change = np.zeros(batch.num_rows, bool)
        for c in columns[:keys]:
            change[1:] |= c[1:] != c[:-1]
        if held and any(c[0] != h[0] for c, h in zip(columns[:keys], held[0][:keys])):
            yield joined(held)
            held = []
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if held and a:
                yield joined(held)
                held = []
            held.append([c[a:b] for c in columns])
    if held:
        yield joined(held)


def whole_cells(batches, keys: int):
    """Tables of the rows with equal leading ``keys`` columns, from Arrow batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for c in batch.columns[:keys]:
            change[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            key = [c[0].as_py() for c in part.columns[:keys]]
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
            last = key
    if held:
        yield pa.Table.from_batches(held)
