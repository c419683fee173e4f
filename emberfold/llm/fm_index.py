"""FM-index over whole numbers, searched for many patterns at a time."""

from __future__ import annotations

import numpy as np


class BitVector:
    """Bits in 64-bit words with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, np.uint8)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        ones = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(ones) - ones
        self.zeros = len(bits) - int(ones.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones among the first ``at`` bits."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)


class WaveletTree:
    """Wavelet tree in matrix form: one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for level in reversed(range(bits)):
            bit = (symbols >> level & 1).astype(np.uint8)
            self.levels.append((level, BitVector(bit)))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        alphabet = np.arange(1 << bits)
        self.first = self._descend(alphabet, np.zeros(1 << bits, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, bits in self.levels:
            ones = bits.rank(at)
            at = np.where(symbol >> level & 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs among the first ``at``."""
        return self._descend(symbol, at) - self.first[symbol]


def sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols (rounded up to a power of two)."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < depth:
        after = np.zeros(len(text), np.int64)
        after[:-width or None] = rank[width:] + 1 if width < len(text) else 0
        rank = np.unique(rank * (len(text) + 1) + after, return_inverse=True)[1].astype(np.int64)
        width *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """Backward search for patterns of up to ``depth`` symbols; zero ends a passage."""

    def __init__(self, text: np.ndarray, depth: int):
        self.places = sorted_suffixes(text, depth + 1)
        top = int(text.max()) if len(text) else 0
        self.tree = WaveletTree(text[self.places - 1].astype(np.int64), max(1, top.bit_length()))
        counts = np.bincount(text, minlength=top + 2)
        self.smaller = np.cumsum(counts) - counts

    def step(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Intervals of the patterns with ``symbol`` put in front."""
        both = self.tree.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        start = self.smaller[symbol]
        return start + both[:len(symbol)], start + both[len(symbol):]

    def windows(self, text: np.ndarray, starts: np.ndarray, width: int, alone: np.ndarray):
        """Windows of ``text`` that occur: ``(which of starts, low, high)``.

        Symbols below zero are not in the index. A window stops matching as soon as its interval
        holds no more than ``alone`` suffixes: its own one, or none.
        """
        which = np.arange(len(starts))
        low = np.zeros(len(starts), np.int64)
        high = np.full(len(starts), len(self.places), np.int64)
        for back in reversed(range(width)):
            symbol = text[starts[which] + back].astype(np.int64)
            known = symbol >= 0
            which, symbol = which[known], symbol[known]
            low, high = self.step(symbol, low[known], high[known])
            more = high - low > alone[which]
            which, low, high = which[more], low[more], high[more]
        return which, low, high
