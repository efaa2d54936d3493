"""Elias-Fano codes of sorted numbers, with select: near-minimal space and no table of 64-bit positions.

n numbers up to u are split into l = floor(log2(u / n)) low bits, packed side by side, and high parts, written as a bit
vector in which number i sets bit (high part + i). That is about 2 + log2(u / n) bits a number. `select` finds the i-th
set bit from a sample of every 256th one (32-bit word numbers) and a short scan.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
HEAD = struct.Struct("<QQB")


class EliasFano:
    def __init__(self, n: int, last: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.last, self.low_bits, self.low, self.high = n, last, low_bits, low, high
        self._sampled = None

    @classmethod
    def of(cls, numbers: np.ndarray) -> EliasFano:
        """Of numbers that are not negative and never fall."""
        numbers = np.asarray(numbers, np.uint64)
        n, last = len(numbers), int(numbers[-1]) if len(numbers) else 0
        low_bits = max(0, (last // n).bit_length() - 1) if n else 0
        shift = np.uint64(low_bits)
        places = np.arange(low_bits, dtype=np.uint64)
        low = ((numbers[:, None] >> places) & np.uint64(1)).astype(np.uint8)
        marks = np.zeros((last >> low_bits) + n + 1, np.uint8)
        marks[(numbers >> shift).astype(np.int64) + np.arange(n)] = 1
        return cls(n, last, low_bits, np.packbits(low.ravel(), bitorder="little"), np.packbits(marks, bitorder="little"))

    def to_bytes(self) -> bytes:
        return HEAD.pack(self.n, self.last, self.low_bits) + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def from_bytes(cls, data: memoryview) -> tuple[EliasFano, int]:
        """The code at the start of `data`, and its length."""
        n, last, low_bits = HEAD.unpack_from(data)
        a = HEAD.size + (n * low_bits + 7) // 8
        b = a + ((last >> low_bits) + n + 8) // 8
        return cls(n, last, low_bits, np.frombuffer(data[HEAD.size : a], np.uint8), np.frombuffer(data[a:b], np.uint8)), b

    def _samples(self) -> tuple[np.ndarray, np.ndarray]:
        """The byte in which every SAMPLE-th set bit lies, and the set bits before that byte."""
        if self._sampled is None:
            counts = np.cumsum(np.bitwise_count(self.high), dtype=np.uint32)
            at = np.searchsorted(counts, np.arange(1, self.n + 1, SAMPLE)).astype(np.uint32)
            self._sampled = at, counts[at] - np.bitwise_count(self.high)[at]
        return self._sampled

    def select(self, i: int) -> int:
        """Position of the i-th set bit of the high parts, from 0."""
        at, before = self._samples()
        byte, seen = int(at[i // SAMPLE]), int(before[i // SAMPLE])
        while seen + (ones := int(self.high[byte]).bit_count()) <= i:
            seen += ones
            byte += 1
        bits = int(self.high[byte])
        for _ in range(i - seen):
            bits &= bits - 1
        return 8 * byte + (bits & -bits).bit_length() - 1

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        low, a = 0, i * self.low_bits
        if self.low_bits:
            window = int.from_bytes(self.low[a // 8 : (a + self.low_bits + 7) // 8].tobytes(), "little")
            low = (window >> (a % 8)) & ((1 << self.low_bits) - 1)
        return ((self.select(i) - i) << self.low_bits) | low

    def __len__(self) -> int:
        return self.n

    def all(self) -> np.ndarray:
        """Every number, decoded at once."""
        marks = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        high = (marks - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high
        bits = np.unpackbits(self.low, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits).astype(np.uint64)
        return high | (bits << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
