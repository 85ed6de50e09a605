"""MinHash signatures, band keys and odd sketches of shingle sets, batch-wise in numpy."""

from __future__ import annotations

import numpy as np

from waymesh.llm.wordhash import mix

BANDS, ROWS = 40, 6
SKETCH_BITS = 1024


class Signer:
    """Signatures of bands * rows MinHash samples over 32-bit hashes."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = rng.integers(0, 1 << 32, bands * rows, np.uint64).astype(np.uint32) | np.uint32(1)
        self.b = rng.integers(0, 1 << 32, bands * rows, np.uint64).astype(np.uint32)

    def sign(self, sets: list[np.ndarray]) -> np.ndarray:
        """(sets, samples) uint32: for each sample the smallest hash under its permutation. No empty sets."""
        counts = np.fromiter(map(len, sets), np.int64, len(sets))
        out = np.empty((len(self.b), len(counts)), np.uint32)
        if not len(counts):
            return out.T
        start = np.cumsum(counts) - counts
        low = np.concatenate(sets).astype(np.uint32)
        for k in range(len(self.b)):
            x = low ^ self.b[k]
            x *= np.uint32(0x85EBCA6B)
            x ^= x >> np.uint32(15)
            x *= self.a[k]
            x ^= x >> np.uint32(13)
            x *= np.uint32(0xC2B2AE35)
            out[k] = np.minimum.reduceat(x, start)
        return np.ascontiguousarray(out.T)

    def band_keys(self, signature: np.ndarray) -> np.ndarray:
        """(texts, bands) int64."""
        key = np.zeros((len(signature), self.bands), np.uint64) + np.arange(self.bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        part = signature.reshape(len(signature), self.bands, self.rows).astype(np.uint64)
        for r in range(self.rows):
            key = mix(key + part[:, :, r] + np.uint64(1))
        return key.view(np.int64)

    def odd_sketches(self, signature: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
        """(texts, bits / 64) uint64: the parity, for each place, of the samples that hash to it."""
        n, k = signature.shape
        at = (mix(signature.astype(np.uint64) + (np.arange(k, dtype=np.uint64) << np.uint64(32))) % np.uint64(bits)).astype(np.int64)
        flat = np.bincount((np.arange(n)[:, None] * bits + at).reshape(-1), minlength=n * bits) & 1
        return np.packbits(flat.reshape(n, bits).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


def odd_distance_limit(similarity: float, samples: int = BANDS * ROWS, bits: int = SKETCH_BITS) -> float:
    """The XOR population count expected of two sketches of sets with this similarity.

    Two signatures differ in about samples * (1 - similarity) samples, and each of those puts two
    elements into the symmetric difference; m random elements leave bits / 2 * (1 - (1 - 2 / bits) ** m)
    odd places.
    """
    m = 2 * samples * (1 - similarity)
    return bits / 2 * (1 - (1 - 2 / bits) ** m)
