"""Wavelet matrix: a sequence of integers as bit planes that answer access, count and occurrence lookups."""

from __future__ import annotations

import numpy as np

#: Bits between two stored counts of the rank directory.
SUPERBLOCK = 512


class WaveletMatrix:
    """Plane l holds bit (levels - 1 - l) of each symbol, in an order that each plane partitions stably.

    Beside each plane stands the number of ones before every 512th bit, so a rank reads one such
    count and at most eight words; select searches the counts.
    """

    def __init__(self, n: int, planes: np.ndarray, counts: np.ndarray) -> None:
        self.n, self.planes, self.counts = n, planes, counts  # (levels, words) uint64, (levels, blocks + 1) uint32
        self.levels = len(planes)
        self.zeros = [n - int(c[-1]) for c in counts]

    @classmethod
    def build(cls, symbols: np.ndarray) -> WaveletMatrix:
        levels = max(1, int(symbols.max()).bit_length()) if len(symbols) else 1
        current = symbols.astype(np.uint16 if levels <= 16 else np.uint32)
        blocks = -(-len(symbols) // SUPERBLOCK)
        planes = np.zeros((levels, blocks * SUPERBLOCK // 64), np.uint64)
        counts = np.zeros((levels, blocks + 1), np.uint32)
        for level in range(levels):
            ones = current & current.dtype.type(1 << (levels - 1 - level)) != 0
            packed = np.packbits(ones, bitorder="little")
            planes[level].view(np.uint8)[: len(packed)] = packed
            np.cumsum(np.bitwise_count(planes[level]).reshape(blocks, SUPERBLOCK // 64).sum(1, dtype=np.uint32), out=counts[level, 1:])
            current = np.concatenate([current.take(np.flatnonzero(~ones)), current.take(np.flatnonzero(ones))])
        return cls(len(symbols), planes, counts)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, self.levels], "<u8").tobytes()
        return head + self.planes.astype("<u8").tobytes() + self.counts.astype("<u4").tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        n, levels = (int(x) for x in np.frombuffer(data, "<u8", 2))
        blocks = -(-n // SUPERBLOCK)
        words = blocks * SUPERBLOCK // 64
        planes = np.frombuffer(data, "<u8", levels * words, 16).reshape(levels, words)
        return cls(n, planes, np.frombuffer(data, "<u4", levels * (blocks + 1), 16 + 8 * levels * words).reshape(levels, -1))

    def ones_before(self, level: int, i: int) -> int:
        block, word = i // SUPERBLOCK, i // 64
        found = int(self.counts[level, block])
        found += int(np.bitwise_count(self.planes[level, block * SUPERBLOCK // 64 : word]).sum())
        if i % 64:
            found += (int(self.planes[level, word]) & ((1 << i % 64) - 1)).bit_count()
        return found

    def bit(self, level: int, i: int) -> int:
        return int(self.planes[level, i // 64]) >> i % 64 & 1

    def down(self, level: int, one: int, i: int) -> int:
        ones = self.ones_before(level, i)
        return self.zeros[level] + ones if one else i - ones

    def access(self, i: int) -> int:
        """The symbol at place i."""
        symbol = 0
        for level in range(self.levels):
            one = self.bit(level, i)
            symbol = symbol << 1 | one
            i = self.down(level, one, i)
        return symbol

    def interval(self, symbol: int, limit: int) -> tuple[int, int]:
        """Where the occurrences of a symbol before ``limit`` stand after the last plane."""
        low, high = 0, limit
        for level in range(self.levels):
            one = symbol >> (self.levels - 1 - level) & 1
            low, high = self.down(level, one, low), self.down(level, one, high)
        return low, high

    def count(self, symbol: int, limit: int | None = None) -> int:
        """Occurrences of a symbol before place ``limit``."""
        if symbol >> self.levels:
            return 0
        low, high = self.interval(symbol, self.n if limit is None else limit)
        return high - low

    def select(self, symbol: int, k: int) -> int:
        """Place of the k-th occurrence of a symbol, from 0; -1 if there are fewer."""
        if not 0 <= k < self.count(symbol):
            return -1
        i = self.interval(symbol, 0)[0] + k
        for level in reversed(range(self.levels)):
            one = symbol >> (self.levels - 1 - level) & 1
            i = self.select_bit(level, one, i - self.zeros[level] if one else i)
        return i

    def select_bit(self, level: int, one: int, k: int) -> int:
        counts = self.counts[level].astype(np.int64)
        held = counts if one else np.arange(len(counts)) * SUPERBLOCK - counts
        block = int(np.searchsorted(held, k, "right")) - 1
        bits = np.unpackbits(self.planes[level, block * 8 : block * 8 + 8].astype("<u8").view(np.uint8), bitorder="little")
        return block * SUPERBLOCK + int(np.flatnonzero(bits == one)[k - int(held[block])])

    def all(self) -> np.ndarray:
        """The whole sequence: each plane undoes its partition, last plane first."""
        symbols = np.zeros(self.n, np.uint16 if self.levels <= 16 else np.uint32)
        for level in reversed(range(self.levels)):
            ones = np.unpackbits(self.planes[level].view(np.uint8), count=self.n, bitorder="little").astype(bool)
            before = np.empty_like(symbols)
            before[np.flatnonzero(~ones)] = symbols[: self.zeros[level]]
            before[np.flatnonzero(ones)] = symbols[self.zeros[level] :] | symbols.dtype.type(1 << (self.levels - 1 - level))
            symbols = before
        return symbols.astype(np.uint32)
