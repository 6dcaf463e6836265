"""A compressed full-text index over words: suffix order, BWT and a wavelet matrix with packed bits."""

from __future__ import annotations

import numpy as np

_ONE = np.uint64(1)


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Positions sorted by the ``depth`` symbols that start there (prefix doubling; ties stay in text order)."""
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    order, span = np.argsort(rank, kind="stable"), 1
    while span < depth:
        shifted = np.full(n, -1, np.int64)
        shifted[:max(0, n - span)] = rank[span:]
        key = rank * (n + 1) + shifted + 1
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.zeros(n, np.int64)
        new[1:] = ordered[1:] != ordered[:-1]
        rank[order] = np.cumsum(new)
        span *= 2
        if n == 0 or rank[order[-1]] == n - 1:
            break
    return order


class Bits:
    """Packed bits with counts of ones in front of each 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(np.concatenate([bits, np.zeros(64 + -len(bits) % 64, bool)]), bitorder="little")
        self.word = packed.view(np.uint64)
        ones = np.bitwise_count(self.word).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)[:-1]])
        self.zeros = len(bits) - int(ones.sum())

    def ones(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        w = at >> 6
        mask = (_ONE << (at & 63).astype(np.uint64)) - _ONE
        return self.before[w] + np.bitwise_count(self.word[w] & mask)


class FMIndex:
    """Counts occurrences of word sequences by backward search.

    ``symbols`` are numbers from 0; 0 separates texts and never occurs in a pattern.  ``depth`` bounds
    the length of patterns.  ``weight`` says how often each position counts.
    """

    def __init__(self, symbols: np.ndarray, weight: np.ndarray, depth: int):
        order = suffix_order(symbols, depth + 1)
        bwt = symbols[order - 1]
        sigma = int(symbols.max()) + 1 if len(symbols) else 1
        self.size = len(symbols)
        self.weight = np.concatenate([[0], np.cumsum(weight[order])])
        self.first = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=sigma))])
        self.levels: list[tuple[int, Bits]] = []
        at = bwt
        for k in range(max(1, (sigma - 1).bit_length()) - 1, -1, -1):
            bit = (at >> k) & 1 == 1
            self.levels.append((k, Bits(bit)))
            at = np.concatenate([at[~bit], at[bit]])
        self.begin = self._down(np.arange(sigma), np.zeros(sigma, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, bits in self.levels:
            ones = bits.ones(at)
            at = np.where((symbol >> k) & 1 == 1, bits.zeros + ones, at - ones)
        return at

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the patterns with ``symbol`` put in front."""
        n = len(symbol)
        both = self._down(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        base = self.first[symbol] - self.begin[symbol]
        return base + both[:n], base + both[n:]

    def count(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return self.weight[high] - self.weight[low]


def repeated_starts(index: FMIndex, symbols: np.ndarray, begin: np.ndarray, windows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts whose ``width`` words count at least twice, as (text, first start, last start).

    Text t has its words at ``begin[t]`` and ``windows[t]`` window starts.  All texts search in step.
    A search runs backwards from the end of the last open window as far as the sequence repeats: its
    matching statistic.  If it stays short, the next one tests the first open window, and the word at
    which that fails closes every window holding the failed sequence.
    """
    lane = np.flatnonzero(windows > 0)
    a, b = np.zeros(len(windows), np.int64), windows.astype(np.int64) - 1
    left = np.zeros(len(windows), bool)  # whether the lane tests its first window
    end = b + width - 1
    at = end.copy()
    low, high = np.zeros(len(windows), np.int64), np.full(len(windows), index.size, np.int64)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def flag(lanes, first, last):
        if len(lanes):
            out.append((lanes, first.copy(), last.copy()))

    while len(lane):
        lo, hi = index.extend(symbols[begin[lane] + at[lane]], low[lane], high[lane])
        good = index.count(lo, hi) >= 2
        low[lane], high[lane] = lo, hi
        ok = lane[good]
        at[ok] -= 1
        whole = ok[at[ok] < a[ok]]  # reached the first open window
        bad = lane[~good]
        over = np.concatenate([whole, bad])
        if len(over):
            flag(whole[~left[whole]], a[whole[~left[whole]]], b[whole[~left[whole]]])
            flag(whole[left[whole]], a[whole[left[whole]]], a[whole[left[whole]]])
            a[whole] = np.where(left[whole], a[whole] + 1, b[whole] + 1)
            left[whole] = False
            fail = at[bad]
            long = ~left[bad] & (end[bad] - fail + 1 > width)
            x = bad[long]
            flag(x, fail[long] + 1, b[x])
            b[x] = fail[long]
            y = bad[~long & ~left[bad]]
            b[y] -= 1
            z = bad[left[bad]]
            a[z] = at[z] + 1
            left[z] = False
            left[y] = True
            end[over] = np.where(left[over], a[over], b[over]) + width - 1
            at[over] = end[over]
            low[over], high[over] = 0, index.size
            lane = lane[a[lane] <= b[lane]]
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*out))
