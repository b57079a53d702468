"""Katz scores against a plain model over dictionaries."""

import math
from collections import Counter
from zlib import crc32

import pytest

from kerbscope.llm import katz, queries
from pyspark.sql import functions as F

END = b"\n"


class Plain:
    """The same definition, word by word; ``grams[k]`` has the counts of n-grams of ``k + 1`` words."""

    def __init__(self, texts, order=2):
        self.grams = [Counter() for _ in range(order)]
        self.after = [Counter() for _ in range(order)]
        for words in texts:
            for k in range(order):
                padded = [None] * k + words
                for at in range(len(words)):
                    gram = tuple(padded[at : at + k + 1])
                    self.grams[k][gram] += 1
                    self.after[k][gram[:-1]] += 1
        self.words = Counter({g[0]: n for g, n in self.grams[0].items()})
        self.total = sum(self.words.values())
        self.cuts = [katz.discounts([Counter(c.values())[r] for r in range(1, 7)]) for c in self.grams]
        free = sum((1 - self.cuts[0][min(c, 6)]) * c for c in self.words.values())
        self.scale, self.unknown = (1 / self.total, free / self.total) if free > 0 else (1 / (self.total + 1), 1 / (self.total + 1))
        self.free, self.covered = ([Counter() for _ in range(order)] for _ in range(2))
        for k in range(1, order):
            for gram, c in self.grams[k].items():
                self.free[k][gram[:-1]] += (1 - self.cuts[k][min(c, 6)]) * c
                self.covered[k][gram[:-1]] += self.chance(gram[1:-1], gram[-1])

    def alone(self, word):
        c = self.words[word]
        return self.cuts[0][min(c, 6)] * c * self.scale if c else self.unknown

    def chance(self, before, word):
        k = len(before)
        if not k:
            return self.alone(word)
        n, c = self.after[k][before], self.grams[k][*before, word]
        if not n:
            return self.chance(before[1:], word)
        below, free = (n, self.free[k][before]) if self.free[k][before] > 0 else (n + 1, 1)
        if c:
            return self.cuts[k][min(c, 6)] * c / below
        return free / below / (1 - self.covered[k][before]) * self.chance(before[1:], word)

    def score(self, words):
        k = len(self.grams) - 1
        padded = [None] * k + words
        return sum(math.log10(self.chance(tuple(padded[at : at + k]), w)) for at, w in enumerate(words))


def words_of(text):
    return [*(text or "").encode().lower().split(), END]


def check(rows, out, trained, order=2):
    model = Plain([words_of(t) for k, (i, t) in enumerate(rows) if trained(i)], order)
    found = {}
    for r in out:
        found.setdefault((r.doc_id, r.n_tokens), []).append(r)
    for i, text in rows:
        words = words_of(text)
        mine = [r for r in found[i, len(words)]]
        score = model.score(words)
        base = sum(math.log10((model.words[w] + 1) / (model.total + len(model.words) + 1)) for w in words)
        assert any(r.score == pytest.approx(score, abs=1e-7) and r.base_score == pytest.approx(base, abs=1e-7) for r in mine)
        assert all(r.train_tokens == model.total for r in mine)
        assert any(r.n_known == sum(model.words[w] > 0 for w in words) for r in mine)
    return model


def test_query_like_the_plain_model_and_sums_to_one(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    out = queries.op3_katz_scores(spark, folder).collect()
    held_out = {i: crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    assert {r.doc_id: r.held_out for r in out} == held_out
    model = check(rows, out, lambda i: not held_out[i])
    for before in [None, b"the", words_of(rows[3][1])[0], words_of(rows[9][1])[-2]]:
        assert sum(model.chance((before,), w) for w in model.words) + model.chance((before,), b"no such word") == pytest.approx(1)
    learned = [r for r in out if r.held_out]
    assert sum(r.score for r in learned) > sum(r.base_score for r in learned)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_odd_texts_small_blocks_and_clashing_columns(spark, monkeypatch, order):
    monkeypatch.setattr(katz, "BLOCK_BYTES", 60)
    texts = [None, "", "  \t\n ", "A a\x0bA\x0ca", "a b a b a b", "x " * 500, "É é \x85 \xa0 a", "c d e f g h", "a b", "a b", "zz a"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a b"), (8, "a b")]
    frame = spark.createDataFrame([(i, t, 1, "q", 2) for i, t in rows], "doc_id long, text string, block int, ids string, train int").coalesce(1)
    out = katz.score(frame, F.col("doc_id") != 10, order).collect()
    assert len(out) == len(rows)
    check(rows, out, lambda i: i is not None and i != 10, order)


def test_order_three_on_the_given_texts_sums_to_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    out = katz.score(docs, F.col("doc_id") % 3 != 0, 3).collect()
    model = check(rows, out, lambda i: i % 3 != 0, 3)
    words = words_of(rows[4][1])
    for before in [(None, None), (None, words[0]), tuple(words[:2]), (words[0], b"no such word")]:
        assert sum(model.chance(before, w) for w in model.words) + model.chance(before, b"no such word") == pytest.approx(1)


def test_a_very_long_text_and_a_wrong_order(spark):
    rows = [(1, "the cat sat on the mat " * 30_000), (2, "the cat sat"), (3, "on the cat")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, katz.score(frame, F.col("doc_id") != 3, 3).collect(), lambda i: i != 3, 3)
    with pytest.raises(ValueError):
        katz.score(frame, F.lit(True), 0)


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    out = sorted(katz.score(frame, F.lit(False)).collect())
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.score, r.base_score) for r in out] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]
    assert katz.score(spark.createDataFrame([], "doc_id long, text string"), F.lit(True)).collect() == []


def test_discounts_stay_between_none_and_all():
    for frequency in ([0] * 6, [5, 0, 0, 0, 0, 0], [0, 9, 9, 9, 9, 9], [1000, 300, 150, 90, 60, 45], [1, 2, 3, 4, 5, 6]):
        cut = katz.discounts(frequency)
        assert (cut[1:6] > 0).all() and (cut[1:6] <= 1).all() and cut[6] == 1
    good = katz.discounts([1000, 300, 150, 90, 60, 45])
    rest = 6 * 45 / 1000
    assert good[1] == pytest.approx((2 * 300 / 1000 - rest) / (1 - rest))
