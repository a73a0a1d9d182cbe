"""K2-treap: a quadtree over a sparse grid whose cells know their greatest value, searched best first.

Rows are terms and columns are documents, values are impacts. A cell that holds a single value is not divided further,
so a tree has less than two nodes a value. Nodes stand level by level; a node's children follow one another, so their
places are counts of the quadrants before them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_WIDE = 512  # so many document ranges are divided at a time
_ONES = np.array([bin(m).count("1") for m in range(16)], np.int32)


def _spread(x: np.ndarray) -> np.ndarray:
    """The lower 32 bits of each number with a zero after each."""
    x = x.astype(np.uint64)
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
        x = (x | (x << np.uint64(shift))) & np.uint64(mask)
    return x


@dataclass(frozen=True)
class Treap:
    """`mask` has a bit for each quadrant of a node that holds anything and is 0 for a cell of a single value, whose row
    and column are the next ones of `row` and `column`. `best` is the greatest value of a node. The grid has 2 ** side
    rows and columns."""

    side: int
    mask: np.ndarray
    best: np.ndarray
    row: np.ndarray
    column: np.ndarray

    def __post_init__(self):
        ones = _ONES[self.mask]
        single = self.mask == 0
        first = 1 + np.cumsum(ones) - ones
        # For a cell of a single value, its place in `row` and `column` instead.
        object.__setattr__(self, "first", np.where(single, np.cumsum(single) - 1, first).astype(np.int32))


def build(rows: np.ndarray, columns: np.ndarray, values: np.ndarray) -> Treap:
    """The tree of these cells, at least one and no two alike, with positive values below 2 ** 31."""
    side = max(int(rows.max()).bit_length(), int(columns.max()).bit_length())
    code = (_spread(rows) << np.uint64(1)) | _spread(columns)
    at = np.argsort(code)
    code, values = code[at], values[at].astype(np.int32)
    masks, bests, singles = [], [], []
    for level in range(side + 1):
        shift = 2 * (side - level)
        prefix = code >> np.uint64(shift)
        starts = np.flatnonzero(np.concatenate([[True], prefix[1:] != prefix[:-1]]))
        count = np.diff(np.append(starts, len(code)))
        single = count == 1
        bests.append(np.maximum.reduceat(values, starts))
        if shift:
            quadrant = np.left_shift(1, ((code >> np.uint64(shift - 2)) & np.uint64(3)).astype(np.uint8)).astype(np.uint8)
            mask = np.bitwise_or.reduceat(quadrant, starts)
            mask[single] = 0
        else:
            mask = np.zeros(len(starts), np.uint8)
        masks.append(mask)
        singles.append(at[starts[single]])
        inside = np.repeat(~single, count)
        code, values, at = code[inside], values[inside], at[inside]
        if not len(code):
            break
    one = np.concatenate(singles)
    return Treap(side, np.concatenate(masks), np.concatenate(bests), rows[one].astype(np.int32), columns[one].astype(np.int32))


def _halves(tree: Treap, rows: np.ndarray, nodes: np.ndarray, level: np.ndarray) -> list[np.ndarray]:
    """For both halves of each document range, the node of every row there, or -1. `nodes` is (rows, ranges)."""
    there = np.maximum(nodes, 0)
    mask, first = tree.mask[there], tree.first[there]
    single, empty = mask == 0, nodes < 0
    bit = (rows[:, None] >> (tree.side - 1 - level)[None, :]) & 1
    side_of = (tree.column[np.where(single, first, 0)] >> (tree.side - 1 - level)[None, :]) & 1
    out = []
    for half in (0, 1):
        quadrant = (2 * bit + half).astype(np.uint8)
        holds = (mask >> quadrant) & 1 == 1
        child = first + _ONES[mask & ((1 << quadrant) - 1)]
        child = np.where(holds & ~single, child, 0)
        # A cell of a single value counts only if the value is in the row.
        leaf = tree.mask[child] == 0
        own = ~leaf | (tree.row[np.where(leaf, tree.first[child], 0)] == rows[:, None])
        found = np.where(single, np.where(side_of == half, there, -1), np.where(holds & own, child, -1))
        out.append(np.where(empty, -1, found))
    return out


def search(tree: Treap, rows: np.ndarray, weights: np.ndarray, most: int, least: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Columns and scores of the `most` greatest sums of weight times value over these rows, equal ones by column; sums
    below `least` are left out.

    The paths of all rows go down together over ranges of columns. A range is worth at most the weighted sum of its
    cells' greatest values; ranges of the highest worth are divided first, and those that cannot reach the results any
    more are dropped. Nothing is estimated: the results are exact.
    """
    columns, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(rows):
        return columns, scores
    root_is_single = tree.mask[0] == 0
    nodes = np.full((len(rows), 1), -1 if root_is_single else 0, np.int64)
    if root_is_single:
        nodes[rows == tree.row[0], 0] = 0
    start, level = np.zeros(1, np.int64), np.zeros(1, np.int64)
    worth = weights @ np.where(nodes >= 0, tree.best[np.maximum(nodes, 0)], 0).astype(np.int64)
    while True:
        if len(scores) == most:
            last, edge = scores[-1], columns[-1]
            alive = (worth > last) | ((worth == last) & (start < edge))  # all found reach `least`
        else:
            alive = worth >= least
        if not alive.all():
            nodes, start, level, worth = nodes[:, alive], start[alive], level[alive], worth[alive]
        if not len(start):
            return columns, scores
        done = level == tree.side
        if done.any():  # single documents, whose worth is their score
            columns, scores = np.concatenate([columns, start[done]]), np.concatenate([scores, worth[done]])
            order = np.lexsort((columns, -scores))[:most]
            columns, scores = columns[order], scores[order]
            nodes, start, level, worth = nodes[:, ~done], start[~done], level[~done], worth[~done]
            continue
        if len(start) > _WIDE:
            order = np.argpartition(-worth, _WIDE)
            now, rest = order[:_WIDE], order[_WIDE:]
        else:
            now, rest = np.arange(len(start)), np.zeros(0, np.int64)
        low, high = _halves(tree, rows, nodes[:, now], level[now])
        half = np.left_shift(1, tree.side - 1 - level[now])
        new = np.concatenate([low, high], axis=1)
        new_worth = weights @ np.where(new >= 0, tree.best[np.maximum(new, 0)], 0).astype(np.int64)
        nodes = np.concatenate([nodes[:, rest], new], axis=1)
        worth = np.concatenate([worth[rest], new_worth])
        start = np.concatenate([start[rest], start[now], start[now] + half])
        level = np.concatenate([level[rest], level[now] + 1, level[now] + 1])
