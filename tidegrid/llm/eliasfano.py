"""Non-decreasing whole numbers in little more space than they need, each found without reading the others.

Elias-Fano: of ``n`` numbers up to ``u`` the lowest log2(u / n) bits are stored one after the other, the rest as a
string of bits in which number ``i`` sets bit ``high(i) + i``. Its place is found again by selecting the i-th set
bit; the counts of set bits before every 512 bits, 32 bits each, lead there.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

WORD, BLOCK_WORDS = 64, 8
AT_ONCE = 1 << 13


def _packed(bits: np.ndarray) -> np.ndarray:
    """Bits, lowest first, as 64-bit words."""
    out = np.zeros(-(-len(bits) // WORD) * 8, np.uint8)
    packed = np.packbits(bits, bitorder="little")
    out[: len(packed)] = packed
    return out.view("<u8")


@dataclass(frozen=True)
class EliasFano:
    """``count`` numbers; ``low`` and ``high`` are their bits, ``before`` the set bits before each block of ``high``."""

    count: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    before: np.ndarray

    @staticmethod
    def of(values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        count = len(values)
        low_bits = max(0, (int(values[-1]) // count).bit_length() - 1) if count else 0
        shifts, parts = np.arange(low_bits, dtype=np.uint64), [np.zeros(0, "<u8")]
        for start in range(0, count if low_bits else 0, AT_ONCE):  # a multiple of 64 numbers fills whole words
            bits = (values[start : start + AT_ONCE, None] >> shifts) & np.uint64(1)
            parts.append(_packed(bits.astype(np.uint8).ravel()))
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
        size = -(-(int(places[-1]) + 1 if count else 0) // (WORD * BLOCK_WORDS)) * WORD * BLOCK_WORDS
        bits = np.zeros(size, np.uint8)
        bits[places] = 1
        return EliasFano.from_words(count, low_bits, np.concatenate(parts), _packed(bits))

    @staticmethod
    def from_words(count: int, low_bits: int, low: np.ndarray, high: np.ndarray) -> EliasFano:
        ones = np.bitwise_count(high).reshape(-1, BLOCK_WORDS).sum(1, dtype=np.int64)
        return EliasFano(count, low_bits, low, high, np.concatenate(([0], np.cumsum(ones))).astype("<u4"))

    def select(self, numbers: np.ndarray) -> np.ndarray:
        """Places of the set bits with these numbers, counted from 0."""
        block = np.searchsorted(self.before, numbers, side="right") - 1
        words = self.high.reshape(-1, BLOCK_WORDS)[block]
        rest = numbers - self.before[block].astype(np.int64)
        upto = np.cumsum(np.bitwise_count(words), axis=1, dtype=np.int64)
        word = (upto <= rest[:, None]).sum(1)
        rows = np.arange(len(numbers))
        rest = rest - np.where(word > 0, upto[rows, word - 1], 0)
        bits = (words[rows, word][:, None] >> np.arange(WORD, dtype=np.uint64)) & np.uint64(1)
        bit = (np.cumsum(bits, axis=1, dtype=np.int64) <= rest[:, None]).sum(1)
        return (block * BLOCK_WORDS + word) * WORD + bit

    def low_of(self, numbers: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(numbers), np.uint64)
        width = np.uint64(self.low_bits)
        place = numbers.astype(np.uint64) * width
        word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(WORD - 1)
        value = self.low[word] >> shift
        split = shift + width > WORD
        following = self.low[np.minimum(word + 1, len(self.low) - 1)]
        value = np.where(split, value | (following << ((np.uint64(WORD) - shift) & np.uint64(WORD - 1))), value)
        return value & np.uint64((1 << self.low_bits) - 1)

    def __getitem__(self, numbers) -> np.ndarray:
        """The numbers at the given positions, as unsigned 64-bit."""
        numbers = np.atleast_1d(np.asarray(numbers, np.int64))
        out = np.zeros(len(numbers), np.uint64)
        for start in range(0, len(numbers), AT_ONCE):
            part = numbers[start : start + AT_ONCE]
            high = (self.select(part) - part).astype(np.uint64)
            out[start : start + AT_ONCE] = (high << np.uint64(self.low_bits)) | self.low_of(part)
        return out
