"""Minimal perfect hashes over shards of a vocabulary, with the keys kept for verification.

A key goes to the first level in which it is alone at its place; the places taken,
counted over all levels, number the ``n`` keys from 0 to ``n - 1``.  Any other text
may also land on a taken place, so the key stored for the number is compared.
Keys whose 64-bit hashes are equal are never alone; they are looked up by name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from kerbscope.llm.arrays import mix

LEVELS = 24
#: Places per key in each level.
ROOM = 2
#: Seed of Spark's own ``xxhash64``, so that both sides agree on a key's shard.
SEED = 42

_STEP = 0x9E3779B97F4A7C15


def key_hashes(keys: pa.Array) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(k, SEED) for k in keys.cast(pa.binary()).to_pylist()], np.uint64)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """As ``shiftrightunsigned(xxhash64(key), 33) % shards`` in Spark."""
    return ((hashes >> np.uint64(33)) % np.uint64(shards)).astype(np.int64)


def _places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    return (mix(hashes + np.uint64(_STEP * (level + 1) % 2**64)) % np.uint64(size)).astype(np.int64)


@dataclass(frozen=True)
class PerfectHash:
    """Numbers the keys of one shard in their own order; ``keys`` is sorted by UTF-8."""

    keys: pa.Array
    sizes: np.ndarray  # places of each level
    bits: np.ndarray  # taken places of all levels, each begun at a word
    place: np.ndarray  # perfect number -> place of the key in ``keys``
    spare: np.ndarray  # places of keys that are looked up by name

    @staticmethod
    def of(keys: pa.Array) -> PerfectHash:
        """``keys``: distinct, sorted by UTF-8."""
        hashes = key_hashes(keys)
        left = np.arange(len(hashes))
        sizes, bits, order = [], [], []
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(64, ROOM * len(left))
            at = _places(hashes[left], level, size)
            alone = np.bincount(at, minlength=size)[at] == 1
            taken = np.zeros(-(-size // 64) * 64, np.uint8)
            taken[at[alone]] = 1
            bits.append(np.packbits(taken, bitorder="little").view("<u8"))
            sizes.append(size)
            order.append(left[alone][np.argsort(at[alone])])
            left = left[~alone]
        empty = np.empty(0, np.int64)
        return PerfectHash(
            keys, np.array(sizes, np.int64), np.concatenate([np.empty(0, "<u8"), *bits]), np.concatenate([empty, *order]).astype(np.int32), left.astype(np.int32)
        )

    def find(self, words: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Place in ``keys`` of each word; -1 for words that are none of the keys."""
        before = np.r_[0, np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)]
        number = np.full(len(words), -1, np.int64)
        left, base = np.arange(len(words)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = _places(hashes[left], level, size)
            word, bit = base + at // 64, (at % 64).astype(np.uint64)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            word, bit = word[hit], bit[hit]
            lower = self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            number[left[hit]] = before[word] + np.bitwise_count(lower)
            left = left[~hit]
            base += -(-size // 64)
        found = np.full(len(words), -1, np.int64)
        known = np.flatnonzero(number >= 0)
        places = self.place[number[known]]
        same = pc.equal(self.keys.take(pa.array(places)), words.take(pa.array(known))).to_numpy(zero_copy_only=False)
        found[known[same]] = places[same]
        if len(self.spare):
            named = {self.keys[int(k)].as_py(): int(k) for k in self.spare}
            for i in np.flatnonzero(found < 0):
                found[i] = named.get(words[int(i)].as_py(), -1)
        return found
