"""Rising numbers in near-minimal space (Elias-Fano), with direct access to each."""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQQB")
#: Bits of the upper part whose ones are counted together; a 32-bit count stands for each such block.
_BLOCK_WORDS = 8
_AT_ONCE = 1 << 16


class EliasFano:
    """Numbers that never fall, the first of them added back by the reader as `base`.

    Of n numbers up to u the lowest log2(u / n) bits are stored as they are. What is above them is counted
    in unary, in about two bits a number: number i has its one at upper part + i. A count of the ones before
    every block of 512 bits, of 32 bits, leads to the i-th one.
    """

    def __init__(self, count: int, most: int, low_bits: int, low: np.ndarray, upper: np.ndarray, before: np.ndarray):
        self.count, self.most, self.low_bits = count, most, low_bits
        self._low, self._upper, self._before = low, upper, before
        self._padded = np.concatenate([low, np.zeros(9, np.uint8)])

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """`values` are unsigned 64-bit numbers in rising order."""
        values = np.asarray(values, np.uint64)
        n, most = len(values), int(values[-1]) if len(values) else 0
        bits = max(0, (most // max(n, 1)).bit_length() - 1)
        parts = [np.zeros(0, np.uint8)]
        places = np.arange(bits, dtype=np.uint64)
        for start in range(0, n * bool(bits), _AT_ONCE):  # a multiple of 8 numbers, so whole bytes
            some = values[start : start + _AT_ONCE, None]
            parts.append(np.packbits((some >> places & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little"))
        ones = (values >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        size = n + (most >> bits) + 1
        blocks = -(-size // (64 * _BLOCK_WORDS))
        flags = np.zeros(blocks * 64 * _BLOCK_WORDS, np.uint8)
        flags[ones] = 1
        upper = np.packbits(flags, bitorder="little").view(np.uint64)
        each = np.bitwise_count(upper).reshape(blocks, _BLOCK_WORDS).sum(axis=1, dtype=np.int64)
        before = (np.cumsum(each) - each).astype(np.uint32)
        return cls(n, most, bits, np.concatenate(parts), upper, before)

    def __len__(self) -> int:
        return self.count

    def _select(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th one in the upper part, k from 0."""
        block = np.searchsorted(self._before, k, side="right") - 1
        rest = k - self._before[block].astype(np.int64)
        words = self._upper.reshape(-1, _BLOCK_WORDS)[block]
        upto = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        word = (upto <= rest[:, None]).sum(axis=1)
        rows = np.arange(len(k))
        rest -= np.where(word > 0, upto[rows, word - 1], 0)
        octets = np.ascontiguousarray(words[rows, word]).view(np.uint8).reshape(-1, 8)
        bits = np.cumsum(np.unpackbits(octets, axis=1, bitorder="little"), axis=1, dtype=np.int16)
        bit = (bits <= rest[:, None]).sum(axis=1)
        return (block * _BLOCK_WORDS + word) * 64 + bit

    def _lowest(self, k: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(k), np.uint64)
        at = k * self.low_bits
        octets = self._padded[(at >> 3)[:, None] + np.arange(9)]
        shift = (at & 7).astype(np.uint64)
        head = np.ascontiguousarray(octets[:, :8]).view(np.uint64).ravel() >> shift
        over = np.where(shift > 0, octets[:, 8].astype(np.uint64) << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        return (head | over) & np.uint64((1 << self.low_bits) - 1)

    def at(self, k: np.ndarray) -> np.ndarray:
        """The numbers at places k, as unsigned 64-bit numbers."""
        k = np.asarray(k, np.int64)
        out = np.empty(len(k), np.uint64)
        for start in range(0, len(k), _AT_ONCE):
            some = k[start : start + _AT_ONCE]
            high = (self._select(some) - some).astype(np.uint64)
            out[start : start + _AT_ONCE] = high << np.uint64(self.low_bits) | self._lowest(some)
        return out

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.count, self.most, len(self._before), self.low_bits)
        return b"".join([head, self._low.tobytes(), self._upper.astype("<u8").tobytes(), self._before.astype("<u4").tobytes()])

    @classmethod
    def read(cls, data: memoryview, start: int) -> tuple[EliasFano, int]:
        """The numbers stored from `start` on, and where they end."""
        count, most, blocks, bits = _HEAD.unpack_from(data, start)
        start += _HEAD.size
        sizes = [(count * bits + 7) // 8, blocks * _BLOCK_WORDS * 8, blocks * 4]
        parts = []
        for size, kind in zip(sizes, ("u1", "<u8", "<u4")):
            parts.append(np.frombuffer(data[start : start + size], kind))
            start += size
        return cls(count, most, bits, *parts), start
