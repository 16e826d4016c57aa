"""Merge-type encoding of many short words at once.

Every word keeps an agenda: the ranks of its adjacent symbol pairs. Each round takes the best pair from
the agenda of every word, leftmost on ties, merges it, and scores the two pairs that arose. All words
that still merge have the same number of symbols, so a round is a few array operations. Words of more
than MATRIX symbols have their agenda on a heap of their own, which takes n log n steps.
"""

from __future__ import annotations

import heapq

import numpy as np

NONE = np.int32(2**31 - 1)
MATRIX = 64


class PairTable:
    """(left, right) -> (rank, merged symbol); a smaller rank merges first."""

    def __init__(self, left, right, rank, merged):
        keys = self._key(np.asarray(left), np.asarray(right))
        self.bits = max(4, int(np.ceil(np.log2(4 * len(keys) + 1))))
        self.slots = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.entry = np.full(1 << self.bits, len(keys), np.int32)
        self.rank = np.append(np.asarray(rank, np.int32), NONE)
        self.merged = np.append(np.asarray(merged, np.int32), -1)
        self.probes = 0
        waiting = np.arange(len(keys))
        while len(waiting):
            at = self._slot(keys[waiting], self.probes)
            free = self.entry[at] == len(keys)
            _, chosen = np.unique(at, return_index=True)
            put = np.zeros(len(waiting), bool)
            put[chosen] = True
            put &= free
            self.slots[at[put]] = keys[waiting[put]]
            self.entry[at[put]] = waiting[put]
            waiting = waiting[~put]
            self.probes += 1

    @staticmethod
    def _key(left, right):
        return (left.astype(np.uint64) << np.uint64(32)) | (right.astype(np.uint64) & np.uint64(0xFFFFFFFF))

    def _slot(self, keys, probe):
        hashed = (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)
        return ((hashed + np.uint64(probe)) & np.uint64((1 << self.bits) - 1)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Entry of each pair; the last entry stands for none."""
        keys = self._key(left, right)
        none = np.int32(len(self.rank) - 1)
        out = np.full(len(keys), none, np.int32)
        open_ = np.arange(len(keys))
        for probe in range(self.probes):
            at = self._slot(keys[open_], probe)
            held, here = self.slots[at], self.entry[at]
            hit = held == keys[open_]
            out[open_[hit]] = here[hit]
            open_ = open_[~hit & (here != none)]
            if not len(open_):
                break
        return out


def merge_rows(symbols: np.ndarray, table: PairTable):
    """Merge each row of an (n, width) array; yields (rows, their final symbols)."""
    rows = np.arange(len(symbols))
    entry = table.find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()).reshape(len(symbols), -1)
    while len(rows):
        if entry.shape[1] == 0:
            yield rows, symbols
            return
        rank = table.rank[entry]
        best = rank.argmin(1)
        live = rank[np.arange(len(rows)), best] != NONE
        if not live.all():
            yield rows[~live], symbols[~live]
            rows, symbols, entry, best = rows[live], symbols[live], entry[live], best[live]
            if not len(rows):
                return
        line = np.arange(len(rows))
        width = symbols.shape[1]
        merged = table.merged[entry[line, best]]
        symbols = symbols[np.arange(width) != best[:, None] + 1].reshape(len(rows), width - 1)
        symbols[line, best] = merged
        entry = entry[np.arange(width - 1) != best[:, None]].reshape(len(rows), width - 2)
        left = np.flatnonzero(best > 0)
        entry[left, best[left] - 1] = table.find(symbols[left, best[left] - 1], merged[left])
        right = np.flatnonzero(best < width - 2)
        entry[right, best[right]] = table.find(merged[right], symbols[right, best[right] + 1])


def merge_long(symbols: list[int], table: PairTable) -> list[int]:
    """Merge one word of any length with its agenda on a heap."""
    n = len(symbols)
    held: list[int | None] = list(symbols)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))

    def scored(lefts: list[int]):
        pairs = [(i, after[i]) for i in lefts]
        found = table.find(
            np.array([held[i] for i, _ in pairs], np.int64), np.array([held[j] for _, j in pairs], np.int64)
        )
        return [
            (int(table.rank[e]), i, held[i], held[j], int(table.merged[e]))
            for (i, j), e in zip(pairs, found)
            if table.rank[e] != NONE
        ]

    agenda = scored(list(range(n - 1))) if n > 1 else []
    heapq.heapify(agenda)
    while agenda:
        _, i, left, right, merged = heapq.heappop(agenda)
        j = after[i]
        if held[i] != left or j >= n or held[j] != right:
            continue
        held[i], held[j] = merged, None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        fresh = [k for k in (before[i], i) if k >= 0 and after[k] < n]
        for item in scored(fresh) if fresh else []:
            heapq.heappush(agenda, item)
    return [s for s in held if s is not None]


def merge_words(symbols: np.ndarray, offsets: np.ndarray, table: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge every word of a ragged array of symbols."""
    widths = offsets[1:] - offsets[:-1]
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for width in np.unique(widths):
        words = np.flatnonzero(widths == width)
        if width == 0:
            continue
        if width > MATRIX:
            for word in words:
                merged = merge_long(symbols[offsets[word] : offsets[word + 1]].tolist(), table)
                done.append((np.array([word]), np.array([merged], np.int32)))
            continue
        matrix = symbols[offsets[words][:, None] + np.arange(width)]
        done.extend((words[rows], final) for rows, final in merge_rows(matrix, table))
    lengths = np.zeros(len(widths), np.int64)
    for words, final in done:
        lengths[words] = final.shape[1]
    out = np.concatenate([[0], np.cumsum(lengths)])
    values = np.empty(out[-1], np.int32)
    for words, final in done:
        values[out[words][:, None] + np.arange(final.shape[1])] = final
    return values, out
