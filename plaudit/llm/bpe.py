"""Byte pair merges for many short strings at once, and for one long string."""

from __future__ import annotations

import heapq

import numpy as np

NONE = np.int32(2**31 - 1)
#: Longer strings go through a heap: rounds over all strings suit short ones only.
SHORT = 128
GROUP_SYMBOLS = 1 << 16


class Merges:
    """Pairs of symbols, the rank of each (smaller first; equal ranks leftmost first) and what it makes."""

    def __init__(self, left, right, rank, made):
        keys = (np.asarray(left, np.uint64) << np.uint64(32)) | np.asarray(right, np.uint64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.uint64(2**64 - 1))
        self.rank = np.append(np.asarray(rank, np.int32)[order], NONE)
        self.made = np.append(np.asarray(made, np.int32)[order], np.int32(-1))
        self.by_pair = None

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)
        at = np.searchsorted(self.keys[:-1], keys)
        hit = self.keys[at] == keys
        return np.where(hit, self.rank[at], NONE), self.made[at]

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Concatenated strings of ``sizes`` symbols each -> their merged symbols and the new sizes.

        Strings are taken in groups whose arrays fit a processor's cache.
        """
        ends = np.cumsum(sizes)
        cuts = np.unique(np.searchsorted(ends, np.arange(0, len(symbols), GROUP_SYMBOLS)))
        cuts = np.unique(np.concatenate([[0], cuts, [len(sizes)]]))
        parts = [
            self.merge_group(symbols[ends[a] - sizes[a] : ends[b - 1]], sizes[a:b]) for a, b in zip(cuts[:-1], cuts[1:])
        ]
        if not parts:
            return np.empty(0, np.int32), np.zeros(0, np.int64)
        merged, counts = (np.concatenate(x) for x in zip(*parts))
        return merged, counts

    def merge_group(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        segment = np.repeat(np.arange(len(sizes)), sizes)
        long = sizes > SHORT
        out: list[tuple[np.ndarray, np.ndarray]] = []
        if long.any():
            ends = np.cumsum(sizes)
            for i in np.flatnonzero(long):
                merged = self.merge_one(symbols[ends[i] - sizes[i] : ends[i]].tolist())
                out.append((np.full(len(merged), i), np.array(merged, np.int32)))
            stay = ~long[segment]
            segment, symbols = segment[stay], symbols[stay]
        symbols = symbols.astype(np.int32)
        rank = np.full(len(symbols), NONE, np.int32)
        made = np.full(len(symbols), -1, np.int32)
        pairs = np.flatnonzero(segment[1:] == segment[:-1])
        rank[pairs], made[pairs] = self.look_up(symbols[pairs], symbols[pairs + 1])
        while len(symbols):
            starts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            best = np.minimum.reduceat(rank, starts)
            counts = np.diff(np.append(starts, len(symbols)))
            of = np.repeat(best, counts)
            over = of == NONE
            if over.any():
                out.append((segment[over], symbols[over]))
                stay = ~over
                segment, symbols, rank, made, of = (x[stay] for x in (segment, symbols, rank, made, of))
                if not len(symbols):
                    break
            at = np.flatnonzero(rank == of)
            at = at[np.append(True, segment[at[1:]] != segment[at[:-1]])]
            symbols[at] = made[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            segment, symbols, rank, made = (x[keep] for x in (segment, symbols, rank, made))
            at = at - np.arange(len(at))
            rank[at] = NONE
            for first in (at, at[at > 0] - 1):
                first = first[first + 1 < len(symbols)]
                first = first[segment[first] == segment[first + 1]]
                rank[first], made[first] = self.look_up(symbols[first], symbols[first + 1])
        if not out:
            return np.empty(0, np.int32), np.zeros(len(sizes), np.int64)
        segment, symbols = (np.concatenate(x) for x in zip(*out))
        order = np.argsort(segment, kind="stable")
        return symbols[order], np.bincount(segment, minlength=len(sizes))

    def merge_one(self, symbols: list[int]) -> list[int]:
        """The same for one string of any length, in n log n steps."""
        if self.by_pair is None:
            keys = self.keys[:-1]
            pairs = zip((keys >> np.uint64(32)).tolist(), (keys & np.uint64(2**32 - 1)).tolist())
            self.by_pair = dict(zip(pairs, zip(self.rank.tolist(), self.made.tolist())))
        known, n = self.by_pair, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        heap = [
            (found[0], i, symbols[i], symbols[i + 1], found[1])
            for i in range(n - 1)
            if (found := known.get((symbols[i], symbols[i + 1])))
        ]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, made = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], alive[j], after[i] = made, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (found := known.get((symbols[a], symbols[b]))):
                    heapq.heappush(heap, (found[0], a, symbols[a], symbols[b], found[1]))
        return [s for s, lives in zip(symbols, alive) if lives]
