"""Against the public encoder of the same vocabulary, and a plain merge loop."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from kerbscope.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def public():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def plain_merge(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_merger_picks_the_lowest_rank_leftmost_first():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 300, b"ab": 299, b"aaa": 301, b"aab": 700, b"ba": 65000}
    merger = bpe.Merger(ranks)
    rnd = random.Random(5)
    for _ in range(300):
        piece = bytes(rnd.choice(b"aab") for _ in range(rnd.randint(1, 40)))
        assert merger.encode(piece) == ([ranks[piece]] if piece in ranks else plain_merge(piece, ranks))
    assert not any(merger.words)


@pytest.mark.parametrize(
    "text",
    ["", " ", "a" * 30_000, "ab" * 9_000, " " * 20_000, "\n\n\t x", "x\x1c\x1fy\x85　z", "don't 've 漢字 é \U0001f600<|endoftext|>"],
)
def test_texts_like_the_public_encoder(public, text):
    assert bpe.encode_text(text, PATH, PATTERN).tolist() == public.encode_ordinary(text)


def test_random_texts_like_the_public_encoder(public):
    rnd = random.Random(1)
    letters = "ab  \n\t\r\x0b\x1c\x1f\x85\xa0é1²Ⅷ'st!?。漢 ​́𐍈"
    for _ in range(2_000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))
        assert bpe.encode_text(text, PATH, PATTERN).tolist() == public.encode_ordinary(text)


def test_nulls_repeats_empty_tables_and_extra_columns(spark, public):
    schema = "ids string, doc_id long, text string, decoded int, id int"
    rows = [("x", 1, None, 0, 0), ("x", 2, "", 0, 0), (None, None, "It's", None, 1), ("y", 3, "It's", 2, 2), ("y", 3, "It's", 2, 2)]
    encoded = bpe.encode(spark.createDataFrame(rows, schema), PATH, PATTERN)
    assert encoded.columns == ["doc_id", "ids"]
    out = bpe.decode(encoded, PATH).collect()
    assert sorted((r.doc_id or 0, r.ids, bytes(r.decoded)) for r in out) == sorted(
        [(1, [], b""), (2, [], b"")] + [(i, public.encode_ordinary("It's"), b"It's") for i in (0, 3, 3)]
    )
    empty = bpe.decode(bpe.encode(spark.createDataFrame([], schema), PATH, PATTERN), PATH)
    assert empty.collect() == []
    none = bpe.decode(spark.createDataFrame([(1, None), (2, [0])], "doc_id long, ids array<int>"), PATH).collect()
    assert [(r.doc_id, r.decoded) for r in none] == [(1, None), (2, bytearray(b"!"))]


def test_query_on_the_given_texts(spark, public):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.op7_bitmap_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = public.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
