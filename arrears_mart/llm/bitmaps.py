"""Compressed bitmaps of the documents of one block: ascending 16-bit numbers where few are set, else one bit a document."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

MOST = 1 << 16  # documents in a block
_LIST, _BITS = b"\x00", b"\x01"


def pack(numbers: np.ndarray) -> bytes:
    """A bitmap of ascending different numbers below MOST, in the shorter of the two forms."""
    if not len(numbers):
        return _LIST
    if 2 * len(numbers) <= (int(numbers[-1]) >> 3) + 1:
        return _LIST + numbers.astype("<u2").tobytes()
    flags = np.zeros(int(numbers[-1]) + 1, np.uint8)
    flags[numbers] = 1
    return _BITS + np.packbits(flags, bitorder="little").tobytes()


def unpack(bitmap: bytes) -> np.ndarray:
    if bitmap[:1] == _LIST:
        return np.frombuffer(bitmap, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8, offset=1), bitorder="little"))


def popcount(bitmap: bytes) -> int:
    if bitmap[:1] == _LIST:
        return (len(bitmap) - 1) // 2
    return int.from_bytes(bitmap[1:], "little").bit_count()


def merge(bitmaps: Sequence[bytes]) -> bytes:
    """The documents that are in any of the bitmaps."""
    if len(bitmaps) == 1:
        return bitmaps[0]
    return pack(np.unique(np.concatenate([unpack(b) for b in bitmaps])))


def planes(counts: np.ndarray, numbers: np.ndarray) -> list[bytes]:
    """Bitmaps of the documents whose count less one has bit 0, 1, ... set; none if every count is 1."""
    more = counts - 1
    return [pack(numbers[(more >> k) & 1 == 1]) for k in range(int(more.max(initial=0)).bit_length())]


def multiplicities(bitmap: bytes, plane: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Documents and their counts."""
    numbers = unpack(bitmap)
    counts = np.ones(len(numbers), np.int64)
    for k, p in enumerate(plane):
        counts[np.searchsorted(numbers, unpack(p))] += 1 << k
    return numbers, counts


def total(bitmap: bytes, plane: Sequence[bytes]) -> int:
    """The sum of all counts, by popcounts alone."""
    return popcount(bitmap) + sum(popcount(p) << k for k, p in enumerate(plane))
