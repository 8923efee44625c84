"""CRC-32 of joined byte strings from the CRCs and lengths of their parts."""

from __future__ import annotations

import functools

import numpy as np

#: Fixed value: the reflected CRC-32 polynomial.
POLYNOMIAL = 0xEDB88320
_BITS = 6


def _applied(matrix: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The linear map with columns ``matrix`` on each value, over GF(2)."""
    out = np.zeros_like(value)
    for bit in range(32):
        out ^= np.where(value >> np.uint32(bit) & np.uint32(1), matrix[bit], np.uint32(0))
    return out


def _tables(matrix: np.ndarray) -> np.ndarray:
    """The map's values of each byte at each of the four places."""
    byte = np.arange(256, dtype=np.uint32)
    return np.concatenate([_applied(matrix, byte << np.uint32(8 * place)) for place in range(4)])


@functools.lru_cache(maxsize=1)
def _shifts() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables that append 0 to 63 zero bytes, and 64, 128, 256, ... of them."""
    unit = np.uint32(1) << np.arange(32, dtype=np.uint32)
    one = unit.copy()
    for _ in range(8):
        one = one >> np.uint32(1) ^ np.where(one & np.uint32(1), np.uint32(POLYNOMIAL), np.uint32(0))
    small, power = [_tables(unit)], unit
    for _ in range(1, 1 << _BITS):
        power = _applied(one, power)
        small.append(_tables(power))
    power, large = _applied(one, power), []
    for _ in range(32):
        large.append(_tables(power))
        power = _applied(power, power)
    return np.concatenate(small), large


def _looked_up(tables: np.ndarray, base: np.ndarray | int, crc: np.ndarray) -> np.ndarray:
    low = np.uint32(255)
    return (
        tables[base + (crc & low)] ^ tables[base + (crc >> np.uint32(8) & low) + 256]
        ^ tables[base + (crc >> np.uint32(16) & low) + 512] ^ tables[base + (crc >> np.uint32(24)) + 768]
    )


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The part of a CRC that stays when ``length`` bytes follow."""
    small, large = _shifts()
    out = _looked_up(small, (length & ((1 << _BITS) - 1)) * 1024, crc)
    rest, power = length >> _BITS, 0
    while rest.any():
        odd = np.flatnonzero(rest & 1)
        if len(odd):
            out[odd] = _looked_up(large[power], 0, out[odd])
        rest, power = rest >> 1, power + 1
    return out


def joined(crc: np.ndarray, after: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC of a string followed by one of CRC ``after`` and ``length`` bytes."""
    return shifted(crc, length) ^ after
