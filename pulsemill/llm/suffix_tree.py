"""Suffix trees by Ukkonen's algorithm, with constant-time longest common extensions.

The symbols are whole numbers; the last one, 0, occurs nowhere else and is the smallest in every order.
"""

from __future__ import annotations

import numpy as np


def _grow(x: list[int], sigma: int) -> tuple[dict[int, int], list[int], list[int]]:
    """(child of each node * sigma + symbol, start and end of each node's edge label), online in one pass."""
    n = len(x)
    edges: dict[int, int] = {}
    starts, ends, links = [0], [0], [0]
    node = place = length = waiting = 0
    for i, symbol in enumerate(x):
        waiting += 1
        last = 0
        while waiting:
            if not length:
                place = i
            key = node * sigma + x[place]
            child = edges.get(key)
            if child is None:
                edges[key] = len(starts)
                starts.append(i)
                ends.append(n)
                links.append(0)
                if last:
                    links[last] = node
                last = node
            else:
                begin = starts[child]
                size = min(ends[child], i + 1) - begin
                if length >= size:
                    place += size
                    length -= size
                    node = child
                    continue
                if x[begin + length] == symbol:
                    if last:
                        links[last] = node
                    length += 1
                    break
                inner = len(starts)
                edges[key] = inner
                edges[inner * sigma + x[begin + length]] = child
                edges[inner * sigma + symbol] = inner + 1
                starts[child] = begin + length
                starts += [begin, i]
                ends += [begin + length, n]
                links += [0, 0]
                if last:
                    links[last] = inner
                last = inner
            waiting -= 1
            if node:
                node = links[node]
            elif length:
                length -= 1
                place = i - waiting + 1
    return edges, starts, ends


class SuffixTree:
    """Ranks of suffixes and their common extensions."""

    def __init__(self, x: np.ndarray):
        n = len(x)
        sigma = int(x.max()) + 1
        edges, starts, ends = _grow(x.tolist(), sigma)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        self._child = np.fromiter(edges.values(), np.int64, len(edges))
        del edges
        self._parent, self._symbol = keys // sigma, keys % sigma
        self._nodes = len(starts)
        self._n = n
        size = np.minimum(ends, n) - np.array(starts)
        tour = self._tour(ascending=True)
        parent = np.zeros(self._nodes, np.int64)
        parent[self._child] = self._parent
        depth = [0] * self._nodes
        for v, up, own in zip(tour[1:].tolist(), parent[tour[1:]].tolist(), size[tour[1:]].tolist()):
            depth[v] = depth[up] + own
        self._depth = np.array(depth, np.int64)
        inner = np.zeros(self._nodes, bool)
        inner[self._parent] = True
        self._leaf = ~inner
        # A suffix is as long as its leaf is deep.
        self._suffixes = n - self._depth[tour[self._leaf[tour]]]
        self._first = np.empty(n, np.int64)
        self._first[self._suffixes] = np.flatnonzero(self._leaf[tour])
        # The lowest depth between two first visits of the Euler tour is that of their lowest common ancestor:
        # every visit brings the depth of the node it comes down from.
        self._lowest = [self._depth[parent[tour]].astype(np.int32)]
        width = 1
        while 2 * width <= self._nodes:
            row = self._lowest[-1]
            self._lowest.append(np.minimum(row[:-width], row[width:]))
            width *= 2

    def _tour(self, ascending: bool) -> np.ndarray:
        """Nodes in the order of their first visit, children by their symbol; 0 comes first either way."""
        by = self._symbol if ascending else np.where(self._symbol > 0, -self._symbol, np.iinfo(np.int64).min)
        # The stack gives the last child first.
        order = np.lexsort((-by, self._parent)) if ascending else np.lexsort((by, self._parent))[::-1]
        if not ascending:
            order = order[np.argsort(self._parent[order], kind="stable")]
        kids = self._child[order].tolist()
        at = np.searchsorted(self._parent[order], np.arange(self._nodes + 1)).tolist()
        stack, seen = [0], []
        while stack:
            v = stack.pop()
            seen.append(v)
            if at[v] < at[v + 1]:
                stack += kids[at[v] : at[v + 1]]
        return np.array(seen)

    def ranks(self, ascending: bool = True) -> np.ndarray:
        """The place of each suffix among all, symbols ascending or descending."""
        suffixes = self._suffixes
        if not ascending:
            tour = self._tour(ascending=False)
            suffixes = self._n - self._depth[tour[self._leaf[tour]]]
        rank = np.empty(self._n, np.int64)
        rank[suffixes] = np.arange(self._n)
        return rank

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How far the different suffixes i and j agree: the depth of their leaves' lowest common ancestor."""
        a, b = self._first[i], self._first[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            out[of] = np.minimum(self._lowest[k][low[of]], self._lowest[k][high[of] - (1 << k) + 1])
        return out
