"""Run-length index of a small text collection: matching statistics from BWT runs.

``RunIndex`` sorts the suffixes of a few texts (each ended by a separator of its
own), takes the Burrows-Wheeler transform and keeps, of the sorted order, only
what is at the ends of its runs of equal letters: the suffix there and the
length it has in common with its neighbour on either side. Inside a run those
lengths are one less than the length one position earlier in the text, so a
single pass over the text in order gives, for every position, the longest match
with any other position.
"""

from __future__ import annotations

import numpy as np


def suffix_order(code: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]], int]:
    """Suffix array of texts given as letters (separators 0), by prefix multiplication over open groups.

    ``stop`` has, for each position, the separator that ends its text. Separators
    count as different, the earlier one smaller. Also returns, for 7 letters and
    then ``times`` as many again and again, a rank that is equal where so many
    letters are; and ``times``: as many ranks as fit one sort key, 3 up to two
    million letters.
    """
    n = len(code)
    bits = np.uint64(n.bit_length())
    times = 63 // int(bits)
    key = np.zeros(n, np.uint64)
    ended = np.zeros(n, bool)
    padded = np.concatenate([code, np.zeros(8, code.dtype)]).astype(np.uint64)
    for j in range(7):
        letter = np.where(ended, np.uint64(0), padded[j:n + j])
        key = (key << np.uint64(9)) | letter
        ended |= letter == 0
    order = np.argsort(key)
    key = key[order]
    first = np.append(True, key[1:] != key[:-1])
    head = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    rank = np.empty(n, np.int32)
    rank[order] = head
    ranks, h = [(7, rank.copy())], 7
    size = np.diff(np.append(np.flatnonzero(first), n))
    open_ = np.flatnonzero(np.repeat(size > 1, size))
    open_ = open_[stop[order[open_]] - order[open_] >= h]
    while len(open_):
        at = order[open_]
        room = stop[at] - at
        key = rank[at].astype(np.uint64)
        for j in range(1, times):
            nxt = np.where(room >= j * h, rank[np.minimum(at + j * h, n - 1)] + 1, 0)
            key = (key << bits) | nxt.astype(np.uint64)
        by = np.argsort(key)
        at, key, room = at[by], key[by], room[by]
        order[open_] = at
        first = np.append(True, key[1:] != key[:-1])
        size = np.diff(np.append(np.flatnonzero(first), len(at)))
        rank[at] = np.repeat(open_[first], size)
        h *= times
        ranks.append((h, rank.copy()))
        open_ = open_[np.repeat(size > 1, size) & (room >= h)]
    # What is still equal ends in separators: the earlier one is smaller.
    rank = rank[order]
    tied = np.append(rank[1:] == rank[:-1], False)
    tied = np.flatnonzero(tied | np.append(False, tied[:-1]))
    order[tied] = order[tied][np.lexsort((order[tied], rank[tied]))]
    return order, ranks, times


class RunIndex:
    """The runs of the transform of ``texts``, with the suffixes at their ends."""

    def __init__(self, texts: list[bytes]):
        parts = [np.append(np.frombuffer(t, np.uint8).astype(np.int16) + 1, np.int16(0)) for t in texts]
        self.code = np.concatenate(parts)
        ends = np.cumsum([len(p) for p in parts])
        self.begin = ends - [len(p) for p in parts]
        self.stop = np.repeat(ends - 1, [len(p) for p in parts])
        order, self.ranks, self.times = suffix_order(self.code, self.stop)
        bwt = self.code[order - 1]
        new = np.append(True, (bwt[1:] != bwt[:-1]) | (bwt[1:] == 0))
        self.n_runs = int(new.sum())
        top = np.flatnonzero(new)
        # Sampled run ends: the suffix at the first (last) place of each run, and its neighbour outside the run.
        self.heads, self.above = order[top[1:]], order[top[1:] - 1]
        self.tails, self.below = self.above, self.heads
        self.first, self.last = order[0], order[-1]

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Letters that the suffixes at ``i`` and ``j`` have in common, separators excluded."""
        i, j, out = i.copy(), j.copy(), np.zeros(len(i), np.int64)
        room = np.minimum(self.stop[i] - i, self.stop[j] - j)
        for k in range(len(self.ranks) - 1, -1, -1):
            h, rank = self.ranks[k]
            live = np.flatnonzero(room - out >= h)
            for _ in range(self.times - 1):
                live = live[rank[i[live]] == rank[j[live]]]
                i[live] += h
                j[live] += h
                out[live] += h
                live = live[room[live] - out[live] >= h]
        live = np.flatnonzero(room > out)
        while len(live):
            live = live[self.code[i[live]] == self.code[j[live]]]
            i[live] += 1
            j[live] += 1
            out[live] += 1
            live = live[room[live] > out[live]]
        return out

    def matching_statistics(self) -> np.ndarray:
        """For each position of the concatenation, its longest match that starts at another position."""
        n = len(self.code)
        length = self.common(self.heads, self.above)
        best = np.zeros(n, np.int64)
        for ends, alone in ((self.heads, self.first), (self.tails, self.last)):
            value, known = np.zeros(n, np.int64), np.zeros(n, bool)
            value[ends] = length + ends
            known[ends] = True
            value[alone], known[alone] = alone, True
            at = np.maximum.accumulate(np.where(known, np.arange(n), 0))
            best = np.maximum(best, value[at] - np.arange(n))
        return np.minimum(best, self.stop - np.arange(n))
