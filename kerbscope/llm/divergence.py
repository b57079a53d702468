"""Source divergence audit: how far the sources of a language differ in their words.

Every (language, source) group has a smoothed share ``p`` of each term that its
language keeps, and its chi-square distance ``(p - q)**2 / q`` from every other
source and, term by term, from its whole language is reported, in whole numbers.

1. *Exact frequency filtering.*  Each slice of texts sends its distinct (language,
   term) pairs with the number of documents; Spark sums them before and after the
   shuffle, and terms in fewer than ``min_docs`` documents go.
2. *Perfect hashes.*  The terms of a language are dealt by hash to shards of some
   ten thousand; each shard becomes a minimal perfect hash with its keys (``perfect``).
3. *Recount.*  The shards are broadcast and the texts read once more.  Each
   distinct word of a slice is looked up once, its key compared, and its count is
   added to the dense slots of its group and of its language.  Shards of more than
   ``broadcast_bytes`` together are sent in several passes, each of them below
   twice that size.  Slots of more than ``SLOT_BYTES`` leave the task early.  Partial
   counts are merged some at a time, so a group with a third of all texts is
   many small merges.
4. *Distances.*  Sources are dealt to blocks; each pair of blocks meets once for
   each shard, so a task holds two blocks whatever the number of sources.  Of the
   terms, each shard keeps the ``top`` furthest of each group, and a window over
   these ranks them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbscope.llm.arrays import pack, release, split_words, text_slices, unpack
from kerbscope.llm.perfect import PerfectHash, key_hashes, shard_of
from kerbscope.staging import scratch, stage

MIN_DOCS = 3
TOP = 200
SCALE = 1_000_000_000

SLICE_BYTES = 4_000_000
SHARD_TERMS = 16_384
BROADCAST_BYTES = 64_000_000
SLOT_BYTES = 32_000_000
#: Sources in a block, and partial counts in a merge.
BLOCK = 128
MERGE = 64

#: Letters A to Z in lower case, every other ASCII byte but a to z a space; longer code points stay.
_FOLD = bytes(b if b >= 128 or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


# ------------------------------------------------------------------ terms


def split_terms(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Terms of all texts (no nulls), and how many each has: runs of code points other than ASCII non-letters."""
    texts = pa.concat_arrays([texts])
    data = texts.buffers()[2]
    folded = pa.py_buffer((data.to_pybytes() if data is not None else b"").translate(_FOLD))
    return split_words(pa.StringArray.from_buffers(len(texts), texts.buffers()[1], folded, offset=texts.offset))


def _named(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    parts = ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))
    return docs.select(*[F.coalesce(docs[name].cast("string"), F.lit("")).alias(new) for name, new in parts])


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(keys, return_counts=True)


def vocabulary(docs: DataFrame, min_docs: int) -> DataFrame:
    """Rows ``lang``, ``term``: terms in at least ``min_docs`` rows of the language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            lang = langs.indices.to_numpy().astype(np.int64)
            for part in text_slices(batch.column(1), SLICE_BYTES):
                words, sizes = split_terms(batch.column(1).slice(part.start, part.stop - part.start))
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                width = len(coded.dictionary)
                row = np.repeat(np.arange(len(sizes)), sizes)
                pairs, _ = _distinct(row * width + coded.indices.to_numpy())
                keys, n = _distinct(lang[part][pairs // width] * width + pairs % width)
                made = [langs.dictionary.take(pa.array(keys // width)), coded.dictionary.take(pa.array(keys % width)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(made, ["lang", "term", "n"])
            release()

    found = docs.select("lang", "text").mapInArrow(run, "lang string, term string, n long")
    return found.groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs).select("lang", "term")


# ------------------------------------------------------------------ shards


def build_shards(terms: DataFrame, shard_terms: int) -> DataFrame:
    """Rows ``lang``, ``shard`` int, ``size`` long, ``shards`` int (of the language), ``terms`` array, and the hash's parts."""
    many = stage(terms.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / shard_terms).cast("int").alias("shards")), "languages")
    shard = (F.shiftrightunsigned(F.xxhash64("term"), 33) % F.col("shards")).cast("int")

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        keys = rows["term"].combine_chunks().cast(pa.binary()).sort()
        made = PerfectHash.of(keys)
        parts = [pa.array([v.tobytes()], pa.binary()) for v in (made.sizes, made.bits, made.place, made.spare)]
        return pa.Table.from_arrays(
            [pa.array([key[0].as_py()]), pa.array([key[1].as_py()], pa.int32()), pa.array([len(keys)], pa.int64()), rows["shards"].slice(0, 1).combine_chunks(), pa.ListArray.from_arrays([0, len(keys)], keys.cast(pa.string())), *parts],
            ["lang", "shard", "size", "shards", "terms", "sizes", "bits", "place", "spare"],
        )

    dealt = terms.join(many, "lang").withColumn("shard", shard)
    return dealt.groupBy("lang", "shard").applyInArrow(
        build, "lang string, shard int, size long, shards int, terms array<string>, sizes binary, bits binary, place binary, spare binary"
    )


def _load(table: pa.Table) -> dict[str, tuple[int, dict[int, PerfectHash]]]:
    """Of each language, the number of its shards and those that are here."""
    found: dict[str, tuple[int, dict[int, PerfectHash]]] = {}
    kinds = {"sizes": np.int64, "bits": "<u8", "place": np.int32, "spare": np.int32}
    for i in range(table.num_rows):
        parts = {name: np.frombuffer(table[name][i].as_py(), kind) for name, kind in kinds.items()}
        _, here = found.setdefault(table["lang"][i].as_py(), (table["shards"][i].as_py(), {}))
        here[table["shard"][i].as_py()] = PerfectHash(table["terms"][i].values.cast(pa.binary()), **parts)
    return found


# ------------------------------------------------------------------ recount


def _sparse(slots: np.ndarray) -> tuple[int, bytes, bytes]:
    at = np.flatnonzero(slots)
    return int(slots.sum()), pack(np.diff(at, prepend=0).astype(np.uint32)), pack(slots[at])


def _dense(at: bytes | None, n: bytes | None, size: int) -> np.ndarray:
    slots = np.zeros(size, np.int64)
    if at is not None:
        slots[np.cumsum(unpack(at, np.uint32), dtype=np.int64)] = unpack(n, np.int64)
    return slots


_COUNTS = "lang string, source string, shard int, size long, part int, total long, at binary, n binary"
_NAMES = [field.split()[0] for field in _COUNTS.split(", ")]


def _counter(shards) -> callable:
    """Adds up dense slots of a task; ``source`` null stands for the whole language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _load(shards.value)
        task = TaskContext.get().partitionId()
        slots: dict[tuple[str, str | None, int], np.ndarray] = {}
        held = 0

        def leave() -> pa.RecordBatch:
            keys = list(slots)
            rows = [(*key, len(slots[key]), task, *_sparse(slots[key])) for key in keys]
            kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], _NAMES)

        for batch in batches:
            groups = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["lang", "source"])
            names: dict[tuple[str, str], int] = {}
            group = np.array([names.setdefault(tuple(g.values()), len(names)) for g in groups.to_pylist()], np.int64)
            of_lang: dict[str, list[int]] = {}
            for (lang, _), k in names.items():
                of_lang.setdefault(lang, []).append(k)
            sources = [source for _, source in names]
            for part in text_slices(batch.column(2), SLICE_BYTES):
                words, sizes = split_terms(batch.column(2).slice(part.start, part.stop - part.start))
                if not len(words):
                    continue
                coded = words.dictionary_encode()
                width = len(coded.dictionary)
                keys, n = _distinct(np.repeat(group[part], sizes) * width + coded.indices.to_numpy())
                owner, word = keys // width, keys % width
                binary = coded.dictionary.cast(pa.binary())
                hashes = key_hashes(binary)
                for lang, members in of_lang.items():
                    if lang not in known:
                        continue
                    many, here = known[lang]
                    own = np.isin(owner, members)
                    distinct = np.unique(word[own])
                    dealt = shard_of(hashes[distinct], many)
                    shard, place = np.full(width, -1, np.int64), np.full(width, -1, np.int64)
                    for k, hashed in here.items():
                        mine = distinct[dealt == k]
                        shard[mine], place[mine] = k, hashed.find(binary.take(pa.array(mine)), hashes[mine])
                    hit = np.flatnonzero(own & (place[word] >= 0))
                    hit = hit[np.lexsort((shard[word[hit]], owner[hit]))]
                    edge = np.flatnonzero(np.diff(owner[hit]) | np.diff(shard[word[hit]])) + 1
                    for run_of in np.split(hit, edge):
                        if not len(run_of):
                            continue
                        k = int(shard[word[run_of[0]]])
                        for source in (sources[owner[run_of[0]]], None):
                            if (lang, source, k) not in slots:
                                slots[lang, source, k] = np.zeros(len(here[k].keys), np.int64)
                                held += slots[lang, source, k].nbytes
                            # A word is one entry of a group, so no slot is named twice.
                            slots[lang, source, k][place[word[run_of]]] += n[run_of]
                if held > SLOT_BYTES:
                    yield leave()
                    slots.clear()
                    held = 0
            release()
        if slots:
            yield leave()

    return run


def _merge(key: tuple, rows: pa.Table) -> pa.Table:
    size = rows["size"][0].as_py()
    slots = np.zeros(size, np.int64)
    for at, n in zip(rows["at"].to_pylist(), rows["n"].to_pylist()):
        slots[np.cumsum(unpack(at, np.uint32), dtype=np.int64)] += unpack(n, np.int64)
    total, at, n = _sparse(slots)
    lang, source, shard, part = (k.as_py() for k in key)
    return pa.Table.from_arrays(
        [pa.array([v], k) for v, k in zip((lang, source, shard, size, part, total, at, n), (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
        _NAMES,
    )


def recount(docs: DataFrame, shards: DataFrame, broadcast_bytes: int) -> DataFrame:
    """Rows ``lang``, ``source`` (null: the whole language), ``shard``, ``size``, ``total``, ``at``, ``n``: kept terms only."""
    spark = docs.sparkSession
    weight = F.octet_length(F.array_join("terms", " ")) + 4 * F.col("size") + F.octet_length("bits") + F.octet_length("place") + 64
    passes = 1
    while True:
        turn = F.pmod(F.xxhash64("lang", "shard"), F.lit(passes))
        most, total = shards.groupBy(turn.alias("turn")).agg(F.sum(weight).alias("w")).agg(F.max("w"), F.sum("w")).first()
        if not most or most <= 2 * broadcast_bytes:
            break
        # A shard larger than the bound cannot be sent in parts: a few terms of millions of letters each.
        passes = max(2 * passes, -(-total // broadcast_bytes))
        if passes > 64 * max(1, total // broadcast_bytes):
            raise ValueError("one shard is larger than broadcast_bytes; choose fewer terms a shard")
    found = None
    for k in range(passes if most else 0):
        sent = spark.sparkContext.broadcast(shards.where(turn == k).drop("size").toArrow())
        part = stage(docs.mapInArrow(_counter(sent), _COUNTS), "partial-counts")
        sent.destroy()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], _COUNTS).drop("part")
    tasks = found.agg(F.max("part")).first()[0] or 0
    while True:
        tasks //= MERGE
        merged = found.withColumn("part", (F.col("part") / MERGE).cast("int"))
        found = merged.groupBy("lang", "source", "shard", "part").applyInArrow(_merge, _COUNTS)
        if not tasks:
            return found.drop("part")


# ------------------------------------------------------------------ distances


def shares(count: np.ndarray, total: int, terms: int) -> np.ndarray:
    """``1 + floor(SCALE * (count + 1) / (total + terms))``, in three steps that stay within 64 bits."""
    rest, whole = count + 1, np.zeros(len(count), np.int64)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, total + terms)
        whole = whole * 1000 + step
    return whole + 1


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _pairs(key: tuple, rows: pa.Table) -> pa.Table:
    """Sums over one shard for all ordered pairs of sources of two blocks."""
    lang, _, x, y = (k.as_py() for k in key)
    size = rows["size"][0].as_py()
    sources, block = rows["source"].to_pylist(), rows["block"].to_numpy()
    columns = (rows[c].to_pylist() for c in ("at", "n", "total", "terms"))
    p = np.array([shares(_dense(at, n, size), total, terms) if size else np.zeros(0, np.int64) for at, n, total, terms in zip(*columns)]).reshape(len(sources), size)
    first, second, value = [], [], []
    for i in range(len(sources)):
        others = np.flatnonzero(block == (y if block[i] == x else x))
        others = others[others != i]
        first += [sources[i]] * len(others)
        second += [sources[j] for j in others]
        value.append(distance(p[i], p[others]).sum(1))
    value = np.concatenate([np.empty(0, np.int64), *value])
    return pa.table({"lang": pa.array([lang] * len(first), pa.string()), "source": pa.array(first, pa.string()), "item": pa.array(second, pa.string()), "value": pa.array(value, pa.int64())})


def _furthest(top: int) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(k)[i].as_py() for k, name in enumerate(batch.schema.names)}
                own, whole = (_dense(row[a], row[b], row["size"]) for a, b in (("at", "n"), ("lang_at", "lang_n")))
                here = np.flatnonzero(own)
                p, q = shares(own[here], row["total"], row["terms"]), shares(whole[here], row["lang_total"], row["terms"])
                value = np.where(p > q, distance(p, q), -1)
                # Keys are in order, so equal values rank by place.
                best = np.lexsort((here, -value))[:top]
                best = best[value[best] >= 0]
                many = len(best)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([row[c]] * many, k) for c, k in (("lang", pa.string()), ("source", pa.string()), ("shard", pa.int32()))), pa.array(here[best].astype(np.int32)), pa.array(value[best])],
                    ["lang", "source", "shard", "place", "value"],
                )

    return run


def audit(
    docs: DataFrame,
    min_docs: int = MIN_DOCS,
    top: int = TOP,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    shard_terms: int = SHARD_TERMS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows ``lang``, ``source``, ``part``, ``item``, ``value`` long, ``rank`` int.

    ``pair``: every other source of the language with the summed distance; ``term``:
    the ``top`` terms that the group uses more than its language.  Ranks go by value,
    then by item.  Null texts, languages and sources count as empty; every row is a
    document, so repeated rows count again; a language without kept terms has
    distance 0 everywhere.  Other columns are not read.
    """
    named = _named(docs, text_col, lang_col, source_col)
    with scratch(docs.sparkSession):
        shards = stage(build_shards(stage(vocabulary(named, min_docs), "vocabulary"), shard_terms), "shards", result=True)
        counted = stage(recount(named.select("lang", "source", "text"), shards, broadcast_bytes), "counts", result=True)
    places = stage(shards.select("lang", "shard", "size"), "shard-sizes")
    terms = places.groupBy("lang").agg(F.sum("size").alias("terms"))
    totals = counted.where("source is not null").groupBy("lang", "source").agg(F.sum("total").alias("total"))
    none = {"terms": 0, "total": 0}
    groups = stage(named.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(terms, "lang", "left").fillna(none), "groups")

    # A language without terms has one empty shard, so that its pairs appear.
    blocks = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    sizes = groups.join(blocks, "lang").join(places, "lang", "left").fillna(0, ["shard", "size"])
    own = counted.where("source is not null").select("lang", "source", "shard", "at", "n")
    block = F.pmod(F.xxhash64("source"), "blocks")
    tile = F.explode(F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda b: F.struct(F.least("block", b).alias("x"), F.greatest("block", b).alias("y"))))
    dealt = sizes.join(own, ["lang", "source", "shard"], "left").withColumn("block", block).withColumn("tile", tile).select("*", "tile.x", "tile.y").drop("tile")
    sums = dealt.groupBy("lang", "shard", "x", "y").applyInArrow(_pairs, "lang string, source string, item string, value long")
    pairs = sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))

    whole = counted.where("source is null").select("lang", "shard", F.col("at").alias("lang_at"), F.col("n").alias("lang_n"))
    lang_totals = counted.where("source is null").groupBy("lang").agg(F.sum("total").alias("lang_total"))
    rows = counted.where("source is not null").drop("total").join(groups, ["lang", "source"]).join(lang_totals, "lang").join(whole, ["lang", "shard"])
    best = rows.mapInArrow(_furthest(top), "lang string, source string, shard int, place int, value long")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    best = best.withColumn("r", F.rank().over(by_value)).where(F.col("r") <= top).drop("r")
    named_terms = shards.select("lang", "shard", F.posexplode("terms").alias("place", "item"))
    term_rows = best.join(named_terms, ["lang", "shard", "place"]).select("lang", "source", "item", "value")
    ranked = _ranked(term_rows.withColumn("part", F.lit("term"))).where(F.col("rank") <= top)
    return _ranked(pairs).unionByName(ranked)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank: Column = F.row_number().over(order)
    return rows.select("lang", "source", "part", "item", "value", rank.alias("rank"))
