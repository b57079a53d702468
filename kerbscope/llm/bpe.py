"""Byte-level BPE encoding and decoding with a bitmap rank queue.

Each pre-token is merged by rank.  Its bytes form a linked list; the list
positions that could merge wait in one bucket per rank; a two-level bitmap marks
the buckets in use, so the lowest rank is found by two find-first-set steps
however long the pre-token is.  A merge does not remove the entries it makes
void: each position remembers its present rank, and an entry that disagrees is
skipped when it comes up.  Within a rank the leftmost position goes first.

A rank file is read from the executor's installed copy, once per worker.
"""

from __future__ import annotations

import base64
import re
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Pre-tokens kept per worker; the memory is emptied when full, results do not depend on it.
CACHED_PIECES = 800_000
CACHED_LENGTH = 64
#: A bitmap word has 2 ** SHIFT bits.
SHIFT = 8
LOW = (1 << SHIFT) - 1

#: White space as Unicode defines it; the regex library's own class also holds U+001C to U+001F.
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"


def _with_classes(pattern: str, classes: dict[str, str]) -> str:
    """The pattern with the members of its escaped classes written out, inside brackets and outside."""
    out, inside, k = [], False, 0
    while k < len(pattern):
        name = next((c for c in classes if pattern.startswith(c, k)), None)
        if name:
            out.append(classes[name] if inside else f"[{classes[name]}]")
            k += len(name)
            continue
        if pattern.startswith("\\S", k) and "\\s" in classes and not inside:
            out.append(f"[^{classes['\\s']}]")
            k += 2
            continue
        inside = pattern[k] == "[" or inside and pattern[k] != "]"
        out.append(pattern[k])
        k += 1
    return "".join(out)


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """Function from a text to its pre-tokens.

    Texts of the first 256 characters, where letters and numbers can be listed,
    are split by the faster standard library; the result is the same.
    """
    general = regex.compile(_with_classes(pattern, {"\\s": _SPACE}))
    first = [chr(c) for c in range(256)]
    listed = {f"\\p{{{kind}}}": "".join(c for c in first if unicodedata.category(c)[0] == kind) for kind in "LN"}
    plain = re.compile(_with_classes(pattern, listed | {"\\s": "\\t-\\r \\x85\\xa0"}))

    def split(text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return general.findall(text)
        return plain.findall(text)

    return split


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines) if token}


class Merger:
    """Merges pre-tokens by the ranks of a vocabulary.

    ``words`` is the lower level of the bitmap (one bit per rank) and ``top`` the
    upper one (one bit per word in use).  Both are empty again after each
    pre-token, so nothing is cleared between them.  Level widths follow from the
    vocabulary: two levels of 256 bits reach 65,536 ranks.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.words = [0] * ((max(ranks.values(), default=0) >> SHIFT) + 1)

    def encode(self, piece: bytes) -> list[int]:
        ranks, words = self.ranks, self.words
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        rank_of = ranks.get
        buckets: dict[int, list[int]] = {}
        top = 0
        after, before = list(range(1, n + 2)), list(range(-1, n))
        # The rank at which each position could merge with its successor.
        waiting = [rank_of(piece[i : i + 2]) for i in range(n - 1)]
        for i, rank in enumerate(waiting):
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i)
                else:
                    buckets[rank] = [i]
                    word = rank >> SHIFT
                    words[word] |= 1 << (rank & LOW)
                    top |= 1 << word
        waiting.append(None)
        while top:
            word = (top & -top).bit_length() - 1
            bits = words[word]
            rank = (word << SHIFT) + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                bits &= bits - 1
                words[word] = bits
                if not bits:
                    top &= top - 1
            if waiting[i] != rank:
                continue  # stale
            gone = after[i]
            end = after[i] = after[gone]
            before[end] = i
            waiting[gone] = None
            left = before[i]
            if end < n:
                waiting[i] = rank = rank_of(piece[i : after[end]])
                if rank is not None:
                    if rank in buckets:
                        heappush(buckets[rank], i)
                    else:
                        buckets[rank] = [i]
                        word = rank >> SHIFT
                        words[word] |= 1 << (rank & LOW)
                        top |= 1 << word
            else:
                waiting[i] = None
            if left >= 0:
                waiting[left] = rank = rank_of(piece[left:end])
                if rank is not None:
                    if rank in buckets:
                        heappush(buckets[rank], left)
                    else:
                        buckets[rank] = [left]
                        word = rank >> SHIFT
                        words[word] |= 1 << (rank & LOW)
                        top |= 1 << word
        out, i = [], 0
        while i < n:
            end = after[i]
            out.append(ranks[piece[i:end]])
            i = end
        return out


class _Pieces(dict):
    """Ids (packed, 32 bit) of each pre-token met, filled on demand."""

    def __init__(self, merger: Merger):
        super().__init__()
        self.merger = merger

    def __missing__(self, piece: str) -> bytes:
        ids = array("i", self.merger.encode(piece.encode())).tobytes()
        if len(piece) <= CACHED_LENGTH:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=4)
def _encoder(path: str, pattern: str) -> tuple[_Pieces, Callable[[str], list[str]]]:
    return _Pieces(Merger(read_ranks(path))), splitter(pattern)


@lru_cache(maxsize=4)
def _vocabulary(path: str) -> pa.BinaryArray:
    ranks = read_ranks(path)
    table = [None] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return pa.array(table, pa.binary())


def encode_text(text: str, path: str, pattern: str) -> np.ndarray:
    """The ids of a text (int32)."""
    pieces, split = _encoder(path, pattern)
    return np.frombuffer(b"".join(map(pieces.__getitem__, split(text))), np.int32)


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows ``id_col``, ``ids`` (array of int): every whole text, no special tokens.

    A null text counts as empty and an empty text has no ids.  Rows are kept one
    for one: null or repeated ids pass through.  Other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = [], [0]
            for text in batch.column(1).to_pylist():
                flat.append(encode_text(text or "", path, pattern))
                ends.append(ends[-1] + len(flat[-1]))
            values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], ["id", "ids"])

    source = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Rows ``id_col``, ``ids_col``, ``decoded`` (binary): the bytes that the ids stand for.

    A null list of ids decodes to null, an empty one to no bytes; an id outside
    the vocabulary is an error.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _vocabulary(path)
        for batch in batches:
            lists = batch.column(1)
            joined = tokens.take(lists.flatten())
            if joined.null_count:
                raise ValueError("an id is not in the vocabulary")
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            last = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
            at = np.frombuffer(joined.buffers()[1], np.int32)[joined.offset : joined.offset + len(joined) + 1]
            starts = at[last] if len(joined) else np.zeros(len(last), np.int32)
            mask = lists.is_null() if lists.null_count else None
            parts = pa.BinaryArray.from_buffers(pa.binary(), len(lists), [None, pa.array(starts.astype(np.int32)).buffers()[1], joined.buffers()[2] or pa.py_buffer(b"")])
            if mask is not None:
                parts = pa.array([None if gone else part for gone, part in zip(mask.to_pylist(), parts.to_pylist())], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), lists, parts], ["id", "ids", "decoded"])

    source = encoded.select(encoded[id_col].alias("id"), encoded[ids_col].alias("ids"))
    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, ids array<int>, decoded binary")
    return out.withColumnsRenamed({"id": id_col, "ids": ids_col})
