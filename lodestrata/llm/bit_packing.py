"""Numbers of a fixed number of bits each, side by side, packed and unpacked by numpy."""

from __future__ import annotations

import numpy as np

# Widths of whole numbers of bytes need no shifts.
_WHOLE = {8: "u1", 16: "<u2", 32: "<u4"}


def bits_for(size: int) -> int:
    """The least bits that hold each number below ``size``."""
    return max(1, (size - 1).bit_length())


def packed_size(count: int, bits: int) -> int:
    return (count * bits + 7) // 8


def pack(numbers: np.ndarray, bits: int) -> bytes:
    """Number ``i`` takes bits ``i * bits`` and on, the low ones first; the last byte is filled with zeros."""
    n = len(numbers)
    if bits in _WHOLE and (not n or int(numbers.max()) >> bits == 0):
        return numbers.astype(_WHOLE[bits]).tobytes()
    groups = np.zeros((-(-n // 8), 8), np.uint64)
    groups.reshape(-1)[:n] = numbers
    if n and int(groups.max()) >> bits:
        raise ValueError(f"a number needs more than {bits} bits")
    # Eight numbers fill ``bits`` whole bytes; each touches five bytes at most.
    out = np.zeros((len(groups), bits + 8), np.uint8)
    for k in range(8):
        first, shift = divmod(k * bits, 8)
        wide = groups[:, k] << np.uint64(shift)
        for j in range((shift + bits + 7) // 8):
            out[:, first + j] |= (wide >> np.uint64(8 * j)).astype(np.uint8)
    return out[:, :bits].tobytes()[: packed_size(n, bits)]


def unpack(data: bytes | memoryview, count: int, bits: int) -> np.ndarray:
    """The first ``count`` numbers."""
    if bits in _WHOLE:
        return np.frombuffer(data, _WHOLE[bits], count).astype(np.uint32)
    groups = -(-count // 8)
    own = np.zeros(groups * bits, np.uint8)
    found = np.frombuffer(data, np.uint8, packed_size(count, bits))
    own[: len(found)] = found
    rows = np.zeros((groups, bits + 8), np.uint8)
    rows[:, :bits] = own.reshape(groups, bits)
    numbers = np.zeros((groups, 8), np.uint64)
    for k in range(8):
        first, shift = divmod(k * bits, 8)
        wide = np.zeros(groups, np.uint64)
        for j in range((shift + bits + 7) // 8):
            wide |= rows[:, first + j].astype(np.uint64) << np.uint64(8 * j)
        numbers[:, k] = (wide >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return numbers.reshape(-1)[:count].astype(np.uint32)
