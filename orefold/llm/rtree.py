"""Packed R-trees over whole-number vectors, searched by inner product for many anchors at once.

Packing is sort-tile-recursive: rows are sorted by one coordinate and cut into slabs,
every slab is sorted by the next, down to leaves of neighbouring rows. The label is
the first coordinate, so most leaves hold one label. A node knows the least and
largest value of each coordinate below it. The inner product of an anchor with
anything in the box lies, coordinate by coordinate, between the products with the two
ends; two matrix products give these intervals for all anchors and boxes.

A search keeps the best rows of every query and a queue of boxes, largest possible
score first. A box is dropped for a query if its interval lies outside the query's
score window or strictly below its kth score so far (an equal score may still win by
its id); labels that cannot match drop it too.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

LEAF = 128
FANOUT = 8
NO_ID = np.iinfo(np.int64).max
_LOW = np.iinfo(np.int64).min
# Products up to here are exact in floating point.
_EXACT = 1 << 52


def packed_order(labels: np.ndarray, vectors: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows, and the place in it where each leaf starts."""
    n = len(labels)
    if not n:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    spread = vectors.max(axis=0) - vectors.min(axis=0) if vectors.shape[1] else np.empty(0)
    axes = np.argsort(-spread, kind="stable")
    out, starts = [], []

    def tile(rows: np.ndarray, depth: int) -> None:
        if len(rows) <= leaf or depth >= len(axes):
            for i in range(0, len(rows), leaf):
                starts.append(sum(map(len, out)) if not starts else starts[-1] + len(out[-1]))
                out.append(rows[i : i + leaf])
            return
        rows = rows[np.argsort(vectors[rows, axes[depth]], kind="stable")]
        # as many slabs as leave each of the remaining sorts the same share
        leaves = -(-len(rows) // leaf)
        slabs = max(2, round(leaves ** (1 / min(3, len(axes) - depth))))
        size = -(-(-(-len(rows) // slabs)) // leaf) * leaf
        for i in range(0, len(rows), size):
            tile(rows[i : i + size], depth + 1)

    by_label = np.argsort(labels, kind="stable")
    cuts = np.flatnonzero(np.append(True, labels[by_label][1:] != labels[by_label][:-1]))
    few = []
    for i, j in zip(cuts, np.append(cuts[1:], n)):
        # labels with less than a leaf share leaves with their neighbours
        if j - i >= leaf:
            tile(by_label[i:j], 0)
        else:
            few.append(by_label[i:j])
    if few:
        tile(np.concatenate(few), len(axes))
    return np.concatenate(out), np.array(starts, dtype=np.int64)


@dataclass
class Level:
    """Boxes of one level; box ``b`` holds the boxes (or rows) from ``starts[b]`` to ``ends[b]`` of the level below."""

    low: np.ndarray
    high: np.ndarray
    label_low: np.ndarray
    label_high: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


class Tree:
    """``ids``, ``labels`` and ``vectors`` stand in packed order; leaves start at ``starts``."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, starts: np.ndarray, first_row: int = 0):
        self.ids, self.labels, self.first_row = ids, labels, first_row
        self.vectors = vectors
        self.levels: list[Level] = []
        low = high = vectors
        label_low = label_high = labels
        while True:
            ends = np.append(starts[1:], len(low))
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            label_low, label_high = np.minimum.reduceat(label_low, starts), np.maximum.reduceat(label_high, starts)
            self.levels.append(Level(low, high, label_low, label_high, starts, ends))
            if len(starts) == 1:
                break
            starts = np.arange(0, len(starts), FANOUT)


class Best:
    """The first ``k`` rows of each query: largest score, then smallest id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.query = np.empty(0, dtype=np.int64)
        self.score = np.empty(0, dtype=np.int64)
        self.id = np.empty(0, dtype=np.int64)
        self.kth_score = np.full(queries, _LOW)
        self.kth_id = np.full(queries, NO_ID)

    def offer(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query, score, ids = (np.concatenate(p) for p in ((self.query, query), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.flatnonzero(np.append(True, query[1:] != query[:-1])) if len(query) else np.empty(0, dtype=np.int64)
        rank = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        kept = rank < self.k
        self.query, self.score, self.id = query[kept], score[kept], ids[kept]
        full = rank == self.k - 1
        self.kth_score[query[full]], self.kth_id[query[full]] = score[full], ids[full]


@dataclass
class Queries:
    """Anchors with ``w`` score windows each, ends included; query ``a * w + j`` is window ``j`` of anchor ``a``.

    ``same`` asks for rows of the anchor's label, without the anchor's own row;
    otherwise for rows of any other label.
    """

    vectors: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same: bool

    def best(self, k: int) -> Best:
        return Best(self.low.size, k)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``."""
    top = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if top < _EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _padded(m: np.ndarray, width: int) -> np.ndarray:
    return m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def search(tree: Tree, queries: Queries, best: Best) -> None:
    """Improve ``best`` by the rows of ``tree``."""
    anchors, windows = queries.low.shape
    if not anchors or not windows or not len(tree.ids):
        return
    width = max(tree.vectors.shape[1], queries.vectors.shape[1])
    a = _padded(queries.vectors, width)
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    bounds = []
    for level in tree.levels:
        low, high = _padded(level.low, width), _padded(level.high, width)
        most = _product(up, high) + _product(down, low)
        least = _product(up, low) + _product(down, high)
        own = queries.labels[:, None]
        if queries.same:
            able = (level.label_low <= own) & (own <= level.label_high)
        else:
            able = (level.label_low != own) | (level.label_high != own)
        # the largest score any window of the anchor could take from the box
        able &= (most >= queries.low.min(axis=1)[:, None]) & (least <= queries.high.max(axis=1)[:, None])
        bounds.append((np.where(able, most, _LOW), least))
    vectors = _padded(tree.vectors, width)
    kth = best.kth_score.reshape(anchors, windows)

    def alive(level: int, box: int) -> np.ndarray:
        most, least = bounds[level][0][:, box], bounds[level][1][:, box]
        floor = np.maximum(kth, queries.low)
        wanted = (most[:, None] >= floor) & (least[:, None] <= queries.high) & (queries.low <= queries.high)
        return np.flatnonzero(wanted.any(axis=1) & (most > _LOW))

    top = len(tree.levels) - 1
    queue = [(-int(bounds[top][0][:, b].max()), top, b) for b in range(len(tree.levels[top].starts))]
    heapq.heapify(queue)
    while queue:
        _, level, box = heapq.heappop(queue)
        active = alive(level, box)
        if not len(active):
            continue
        i, j = tree.levels[level].starts[box], tree.levels[level].ends[box]
        if level:
            for child in range(i, j):
                largest = int(bounds[level - 1][0][active, child].max())
                if largest > _LOW:
                    heapq.heappush(queue, (-largest, level - 1, child))
            continue
        score = _product(a[active], vectors[i:j])
        ids = tree.ids[i:j]
        match = tree.labels[i:j] == queries.labels[active][:, None]
        if queries.same:
            match &= (np.arange(i, j) + tree.first_row) != queries.rows[active][:, None]
        else:
            match = ~match
        found = []
        for w in range(windows):
            query = active * windows + w
            least, last = best.kth_score[query][:, None], best.kth_id[query][:, None]
            good = match & (score >= queries.low[active, w][:, None]) & (score <= queries.high[active, w][:, None])
            good &= (score > least) | ((score == least) & (ids < last))
            row, column = np.nonzero(good)
            found.append((query[row], score[row, column], ids[column]))
        query, value, who = (np.concatenate(p) for p in zip(*found))
        if len(query):
            best.offer(query, value, who)
