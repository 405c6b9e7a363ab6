"""A compressed FM-index over integer sequences, searched for many patterns in step.

The Burrows-Wheeler transform is kept as a wavelet matrix: one packed bit vector per bit of the
symbols, with counts per 64 bits, so a rank is one count and one popcount per level.  Suffixes are
ordered by their first DEPTH symbols, which is enough for patterns of up to DEPTH symbols.
"""

from __future__ import annotations

import numpy as np

DEPTH = 64


def suffix_order(seq: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Starts of suffixes in the order of their first ``depth`` symbols (prefix doubling), ties by place."""
    n = len(seq)
    rank = np.unique(seq, return_inverse=True)[1].astype(np.int64)
    order, step = np.argsort(rank, kind="stable"), 1
    while step < depth and n > 1:
        nxt = np.zeros(n, np.int64)
        nxt[: max(0, n - step)] = rank[step:] + 1
        key = rank * np.int64(n + 1) + nxt
        order = np.argsort(key, kind="stable")
        new = np.empty(n, np.int64)
        new[order] = np.concatenate(([0], np.cumsum(np.diff(key[order]) != 0)))
        rank, step = new, 2 * step
        if rank[order[-1]] == n - 1:
            break
    return order


class BitVector:
    def __init__(self, bits: np.ndarray) -> None:
        pad = np.zeros(-(-(len(bits) + 1) // 64) * 64, np.uint8)
        pad[: len(bits)] = bits
        self.words = np.packbits(pad, bitorder="little").view(np.uint64)
        self.counts = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, i: np.ndarray) -> np.ndarray:
        at = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[at] + np.bitwise_count(self.words[at] & low)


class FMIndex:
    """seq: symbols from 0 up to sigma - 1."""

    def __init__(self, seq: np.ndarray, sigma: int) -> None:
        order = suffix_order(seq)
        self.n, self.bits = len(seq), max(1, int(sigma - 1).bit_length())
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=sigma))))
        cur, self.levels, self.zeros = seq[order - 1], [], []
        for level in reversed(range(self.bits)):
            bit = ((cur >> level) & 1).astype(np.uint8)
            self.levels.append(BitVector(bit))
            self.zeros.append(int(len(bit) - bit.sum()))
            cur = np.concatenate((cur[bit == 0], cur[bit == 1]))
        self.base = np.zeros(sigma, np.int64)  # where a symbol's run starts below the last level
        self.base = self._rank(np.arange(sigma), np.zeros(sigma, np.int64))

    def _rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for n, level in enumerate(reversed(range(self.bits))):
            one = self.levels[n].ones(i)
            i = np.where((symbol >> level) & 1, self.zeros[n] + one, i - one)
        return i

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of symbol + pattern from those of the patterns: one backward step for each."""
        both = self._rank(np.concatenate((symbol, symbol)), np.concatenate((lo, hi)))
        c = self.first[symbol] - self.base[symbol]
        return c + both[: len(lo)], c + both[len(lo) :]


def repeated_windows(index: FMIndex, seq: np.ndarray, start: np.ndarray, count: np.ndarray, window: int) -> list[list[int]]:
    """For each query, windows (numbers from 0) that occur twice or more and whose words make up all that do.

    Query q has the windows start[q] + 0 .. start[q] + count[q] - 1 of ``seq``.  Backward matching from a
    window's end stops at the first word j before which the match is unique; no window with that word and
    the end repeats, so the scan goes on behind j.  After a repeated window the furthest repeated one that
    still touches it is looked for, from the far end.  All queries take one backward step at a time.
    """
    q = len(start)
    found: list[list[int]] = [[] for _ in range(q)]
    live = np.flatnonzero(count > 0)
    s = np.zeros(q, np.int64)  # window under test
    last = np.full(q, -1, np.int64)  # last repeated window; testing back towards it if >= 0 and back
    back = np.zeros(q, bool)
    far = np.zeros(q, np.int64)
    pos = start + window
    lo, hi = np.zeros(q, np.int64), np.full(q, index.n, np.int64)
    while len(live):
        pos[live] -= 1
        a, b = index.extend(seq[pos[live]], lo[live], hi[live])
        lo[live], hi[live] = a, b
        good = b - a >= 2
        ended = ~good | (pos[live] == start[live] + s[live])
        e = live[ended]
        if not len(e):
            continue
        ok = good[ended]
        hit, miss = e[ok], e[~ok]
        for x, w in zip(hit.tolist(), s[hit].tolist()):
            found[x].append(w)
        last[hit] = s[hit]
        far[hit] = np.minimum(s[hit] + window, count[hit] - 1)
        back[hit] = True
        nxt = s.copy()
        nxt[hit] = far[hit]
        fb, ff = miss[back[miss]], miss[~back[miss]]
        nxt[fb] = s[fb] - 1
        nxt[ff] = pos[ff] - start[ff] + 1
        over = e[back[e] & (nxt[e] <= last[e])]  # nothing repeated between: go on behind the far end
        nxt[over] = np.maximum(far[over] + 1, last[over] + 1)
        back[over] = False
        s[e] = nxt[e]
        pos[e] = start[e] + s[e] + window
        lo[e], hi[e] = 0, index.n
        done = s >= count
        live = live[~done[live]]
    return found
