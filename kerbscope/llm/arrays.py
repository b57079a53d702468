"""Words, hashes and compressed arrays of numbers, for work inside tasks."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives freed memory back to the system: a Python worker lives on for later stages."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def pack(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def mix(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers (finishing steps of the public SplitMix64 generator)."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def range_edges(names: np.ndarray, bits: int) -> np.ndarray:
    """Where each of the ``2 ** bits`` ranges of hashes begins among ``names`` in order; one more for the end."""
    if not bits:
        return np.array([0, len(names)])
    firsts = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.r_[0, np.searchsorted(names, firsts), len(names)]


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts with A to Z in lower case, and how many each has; null counts as empty."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words, sizes = lists.flatten(), lists.value_lengths().to_numpy()
    full = pc.not_equal(words, "")
    filled = full.to_numpy(zero_copy_only=False)
    if filled.all():
        return words, sizes
    row = np.repeat(np.arange(len(sizes)), sizes)
    return words.filter(full), np.bincount(row[filled], minlength=len(sizes))


def word_numbers(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of each word, and the 64-bit hash of each number's word."""
    coded = words.dictionary_encode()
    names = [xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()]
    return coded.indices.to_numpy().astype(np.int64), np.array(names, np.uint64)


def text_slices(texts: pa.Array, size: int) -> list[slice]:
    """Consecutive rows of about ``size`` bytes of text; a text is never split."""
    length = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(length.astype(np.int64)) // size
    edges = np.r_[0, np.flatnonzero(np.diff(group)) + 1, len(group)]
    return [slice(int(a), int(b)) for a, b in zip(edges[:-1], edges[1:]) if b > a]
