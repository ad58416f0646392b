"""Bloom filters over pairs of 64-bit hashes, as arrays of bytes."""

from __future__ import annotations

import math

import numpy as np


def hashes_for(rate: float) -> int:
    return max(1, round(-math.log2(rate)))


def bits_for(n: int, rate: float) -> int:
    return max(64, math.ceil(n * -math.log(rate) / math.log(2) ** 2 / 8) * 8)


def _turns(h1: np.ndarray, h2: np.ndarray, n_bits: int, n_hashes: int):
    """Bit positions, one hash function after the other."""
    at, step = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
    for _ in range(n_hashes):
        yield (at % np.uint64(n_bits)).astype(np.int64)
        at = at + step


def bloom(h1: np.ndarray, h2: np.ndarray, rate: float) -> bytes:
    """A filter that holds all given pairs and any other one with about `rate`."""
    n_bits = bits_for(len(h1), rate)
    bits = np.zeros(n_bits, bool)
    for places in _turns(h1, h2, n_bits, hashes_for(rate)):
        bits[places] = True
    return np.packbits(bits, bitorder="little").tobytes()


def holds(filter_: bytes, h1: np.ndarray, h2: np.ndarray, rate: float) -> np.ndarray:
    """For each pair whether the filter holds it; never false for a pair it was made of."""
    data = np.frombuffer(filter_, np.uint8)
    found = np.ones(len(h1), bool)
    for places in _turns(h1, h2, 8 * len(data), hashes_for(rate)):
        found &= (data[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
        if not found.any():
            break
    return found
