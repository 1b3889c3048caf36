"""Byte-pair merges of many words at once.

All words of a batch advance together: in each step every word merges the pair of its
lowest rank, wherever that occurs in it, as merging one word at a time does.
"""

from __future__ import annotations

import numpy as np

_BITS = 18
_NONE = np.int32(2**31 - 1)


class PairRanks:
    """Rank of a pair of symbol ids, from an open-addressing table; symbols fit 16 bits."""

    def __init__(self, left: np.ndarray, right: np.ndarray):
        keys = self._keys(left, right)
        self.keys = np.zeros(1 << _BITS, np.uint32)
        self.ranks = np.full(1 << _BITS, _NONE, np.int32)
        todo, slots = np.arange(len(keys)), self._slots(keys)
        while len(todo):
            free = self.ranks[slots] == _NONE
            _, first = np.unique(slots[free], return_index=True)
            placed = np.flatnonzero(free)[first]
            self.keys[slots[placed]] = keys[todo[placed]]
            self.ranks[slots[placed]] = todo[placed]
            rest = np.ones(len(todo), bool)
            rest[placed] = False
            todo, slots = todo[rest], (slots[rest] + 1) & ((1 << _BITS) - 1)

    @staticmethod
    def _keys(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint32) << np.uint32(16)) | right.astype(np.uint32)

    @staticmethod
    def _slots(keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - _BITS)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Each pair's rank, the largest number for a pair that has none."""
        keys = self._keys(left, right)
        slots = self._slots(keys)
        ranks = self.ranks[slots]
        other = np.flatnonzero((ranks != _NONE) & (self.keys[slots] != keys))
        while len(other):
            slots[other] = (slots[other] + 1) & ((1 << _BITS) - 1)
            ranks[other] = self.ranks[slots[other]]
            other = other[(ranks[other] != _NONE) & (self.keys[slots[other]] != keys[other])]
        return ranks


def merge_words(
    symbols: np.ndarray, starts: np.ndarray, ranks: PairRanks, merged: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, starts) of the words ``symbols[starts[i]:starts[i + 1]]``, none of them empty.

    ``merged`` has the symbol that a merge of each rank makes.
    """
    number = len(starts) - 1
    done: list[tuple[np.ndarray, np.ndarray]] = []
    word = np.repeat(np.arange(number), np.diff(starts))
    symbols = symbols.astype(np.int32)
    while len(symbols):
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        rank = np.full(len(symbols), _NONE, np.int32)
        inside = word[1:] == word[:-1]
        at = np.flatnonzero(inside)
        rank[at] = ranks.of(symbols[at], symbols[at + 1])
        least = np.minimum.reduceat(rank, first)
        each = np.repeat(least, np.diff(np.r_[first, len(symbols)]))
        over = each == _NONE
        if over.any():
            done.append((word[over], symbols[over]))
        hit = (rank == each) & ~over
        # Where a pair overlaps itself, the first, third, ... of the run are merged.
        run = hit & np.r_[False, hit[:-1]]
        if run.any():
            places = np.arange(len(hit))
            begin = np.maximum.accumulate(np.where(hit & ~run, places, 0))
            hit &= (places - begin) % 2 == 0
        symbols[hit] = merged[rank[hit]]
        kept = ~over
        kept[1:] &= ~hit[:-1]
        symbols, word = symbols[kept], word[kept]
    if not done:
        return np.empty(0, np.uint32), np.zeros(number + 1, np.int64)
    words = np.concatenate([w for w, _ in done])
    ids = np.concatenate([s for _, s in done])
    order = np.argsort(words, kind="stable")
    counts = np.bincount(words, minlength=number)
    return ids[order].astype(np.uint32), np.r_[0, np.cumsum(counts)]
