"""Line dedup, near duplicates, packing, language and toxicity against plain versions."""

import random
import re
import tracemalloc
from collections import Counter
from itertools import product
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kerbscope.llm import groups, language, packing, queries, toxicity, winnow
from kerbscope.llm.common import sample_ids

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, id int, row string, n long"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "x", 7, "r", 5) for i, t in rows], SCHEMA).repartition(parts)


def given(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()]


# ------------------------------------------------------------------ line dedup


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_lines(text):
    """The words of each line that has any."""
    return [words for line in re.split(r"(?<=[.!?])[ \t]+|\n", text) if (words := tuple(WORD.findall(line)))]


def plain_repeats(rows):
    """Of each text, the lines in a run of ``MIN_WORDS`` words that occurred before; runs of any number of lines."""
    seen, due = set(), {}
    for i, text in sorted((r for r in set(rows) if None not in r), key=lambda r: (r[0], crc32(r[1].encode()))):
        lines = plain_lines(text)
        due[i, text] = set()
        for a in range(len(lines)):
            n = 0
            for b in range(a, len(lines)):
                n += len(lines[b])
                if n >= winnow.MIN_WORDS:
                    run = tuple(lines[a : b + 1])
                    if run in seen:
                        due[i, text].update(range(a, b + 1))
                    seen.add(run)
                    if n - len(lines[a]) >= winnow.MIN_WORDS:  # longer runs are unions of shorter ones
                        break
    return due


def check_lines(rows, found):
    """Exactly the lines of repeated runs are cut, with what is blank between them, and the rest stays as it was."""
    due = plain_repeats(rows)
    texts = Counter(rows)
    assert len(found) == len(rows)
    left = Counter()
    for r in found:
        gone = {k for run in r.removed for k in range(run["start"], run["end"] + 1)}
        source = [t for (i, t) in texts if i == r.doc_id and (t is None or due.get((i, t), set()) == gone and r.n_lines == len(plain_lines(t)))]
        kept = []
        for text in source:
            if text is None or not gone:
                kept.append(text)
                continue
            parts = winnow.split_lines(text)
            place = [k for k, line in enumerate(parts[::2]) if WORD.search(line)]
            out = {k for run in r.removed for k in range(2 * place[run["start"]], 2 * place[run["end"]] + 2)}
            kept.append("".join(x for k, x in enumerate(parts) if k not in out))
        assert r.text in kept, (r.doc_id, gone)
        left[r.doc_id] += 1
    assert left == Counter(i for i, _ in rows)


def test_line_dedup_of_the_given_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = winnow.remove_repeats(docs).collect()
    check_lines([(r.doc_id, r.text) for r in docs.collect()], found)
    assert sum(len(r.removed) for r in found) > 100
    out = {r.doc_id: r for r in winnow.remove_repeats(spark.read.parquet(f"{FOLDER}/documents.parquet")).collect()}
    digest = {r.doc_id: r for r in queries.op4_winnowed_lines(spark, FOLDER).collect()}
    assert {i: r.text for i, r in digest.items()} == {i: r.text for i, r in out.items()}
    assert all(r.n_removed == sum(x["end"] - x["start"] + 1 for x in out[i].removed) for i, r in digest.items())


def test_line_dedup_of_made_runs(spark):
    rnd = random.Random(2)

    def line(words=9):
        return " ".join(str(rnd.randrange(10**9)) for _ in range(words)) + "."

    passage = " ".join(line() for _ in range(6))
    long_line = " ".join(["word"] * 29 + ["end."])
    rows = [
        (1, f"{line()} {passage}\n{line()}"),
        (2, f"{line()} x y {passage} {line()}\n\n{line()}"),
        (3, passage),
        (4, f"{line()} {line()}\n{long_line}"),
        (5, f"{line()}\n{long_line}\n{line()}"),
        (6, None),
        (7, ""),
        (8, " \n\n "),
        (9, "\n".join([line(14)] * 40)),
        (10, "All rights reserved.\n" + line()),
        (11, "All rights reserved.\n" + line()),
        (None, passage),
        (12, line(40_000)),
        (3, passage),
    ]
    found = winnow.remove_repeats(frame(spark, rows)).collect()
    assert found[0].asDict().keys() == set("doc_id text lang id row n n_lines removed".split())
    out = {r.doc_id: r for r in found}
    check_lines(rows, found)
    assert passage.split(". ")[2] not in out[2].text and out[2].text.count("\n") == 2
    assert out[3].text == "" and out[None].text == passage and out[6].text is None and out[8].text == " \n\n "
    assert long_line not in out[5].text and long_line in out[4].text
    assert len(out[9].removed) == 1 and out[9].text.count("\n") == 1
    assert not out[10].removed and not out[11].removed and out[9].lang == "x" and out[9].n == 5
    assert winnow.remove_repeats(frame(spark, [])).collect() == []


def test_drawn_texts_of_few_lines(spark):
    """Many ways in which runs overlap, nest, meet strays and repeat within a text."""
    rnd = random.Random(5)
    pool = [" ".join(f"w{rnd.randrange(40)}" for _ in range(rnd.choice([1, 2, 5, 8, 13, 26]))) + rnd.choice(["", ".", "?!"]) for _ in range(14)]
    rows = []
    for i in range(250):
        gaps = ["\n", "\n \n", "  ", "\t", " \x0b", "\r\n"]
        rows.append((i % 200, "".join(rnd.choice(pool) + rnd.choice(gaps) for _ in range(rnd.randrange(12)))))
    check_lines(rows, winnow.remove_repeats(frame(spark, rows)).collect())
    check_lines(rows[:40], winnow.remove_repeats(frame(spark, rows[:40], 1)).collect())


def test_runs_of_two_lines_go(spark):
    rnd = random.Random(4)

    def line(words):
        return " ".join(str(rnd.randrange(10**9)) for _ in range(words)) + "."

    rows = []
    for k in range(30):
        pair = [line(13), line(12)] if k % 3 else rnd.sample([line(30), line(4)], 2)
        if not k % 3:  # the long line alone comes first
            rows.append((3 * k, "\n".join([line(9), max(pair, key=len), line(9)])))
        rows += [(3 * k + n, "\n".join([line(9), line(5), *pair, line(5), line(9)])) for n in (1, 2)]
    found = winnow.remove_repeats(frame(spark, rows)).collect()
    check_lines(rows, found)
    out = {r.doc_id: r for r in found}
    assert all([r.asDict() for r in out[3 * k + 2].removed] == [{"start": 2, "end": 3}] for k in range(30))


def test_fingerprints_are_few_and_shared_by_equal_runs(spark):
    texts = [t.encode() for _, t in given(spark) if t]
    lines = winnow.Lines.of(texts)
    assert np.diff(lines.first).tolist() == [len(plain_lines(t.decode())) for t in texts]
    assert lines.words.tolist() == [len(w) for t in texts for w in plain_lines(t.decode())]
    prints = winnow.fingerprints(lines, winnow.MIN_WORDS)
    assert len(prints) < 0.5 * len(lines.words)
    held = np.zeros(len(lines.words), bool)
    held[prints] = True
    ahead, back = (f(lines, winnow.MIN_WORDS) for f in (winnow.windows_from, winnow.windows_to))
    for found in (ahead, back):  # every window of words, from or to a line, holds a fingerprint
        assert all(held[a : b + 1].any() and lines.words[a : b + 1].sum() >= winnow.MIN_WORDS for a, b in zip(found.start, found.end))
    again = winnow.Lines.of([b"other words before. " + t for t in texts])
    assert set(lines.hashes[prints].tolist()) <= set(again.hashes[winnow.fingerprints(again, winnow.MIN_WORDS)].tolist())


# ------------------------------------------------------------------ near duplicates


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) > 4 else {tuple(words)} - {()}


def plain_components(rows):
    sets = {}
    for i, text in rows:
        sets[i] = shingle_set(text)
    held = {}
    for i, s in sets.items():
        for x in s:
            held.setdefault(x, []).append(i)
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, s in sets.items():
        for j, n in Counter(j for x in s for j in held[x] if j > i).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def test_near_duplicates_of_the_given_texts(spark):
    out = queries.op10_group_jaccard(spark, "/root/testdata/sf0.01").collect()
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == plain_components(rows)


def test_shingles_of_a_block_take_little_memory():
    rnd = np.random.default_rng(1)
    texts = [" ".join(map(str, rnd.integers(0, 5000, 1000))) for _ in range(100)]
    words = groups.word_values(pa.array([*texts, "", None, "a b"]))
    tracemalloc.start()
    code, row = groups.shingles(*words)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60 * len(words[1])  # bytes a word
    sets = [shingle_set(t) for t in [*texts, "", None, "a b"]]
    assert np.bincount(row, minlength=103).tolist() == [len(s) for s in sets]
    assert len(set(code.tolist())) == len(set().union(*sets))


def test_near_duplicates_at_the_threshold_in_small_groups_and_ranges(spark, monkeypatch):
    monkeypatch.setattr(groups, "GROUP", 4)
    monkeypatch.setattr(groups, "RANGE", 500)
    monkeypatch.setattr(groups, "CHUNK_BYTES", 3000)
    rnd = random.Random(8)
    words = [str(rnd.randrange(10**9)) for _ in range(3000)]
    rows = []
    for base in range(6):
        text = words[base * 60 : base * 60 + 60]
        for k in range(14):
            # Cutting words at an end makes every similarity from under to over the threshold.
            rows.append((len(rows), " ".join(text[: 60 - k])))
            rows.append((len(rows), " ".join(text[k:]).upper()))
    shared = " ".join(words[1000:1060])
    rows += [(len(rows) + k, f"{words[2000 + k]} {shared}") for k in range(30)]
    rows += [(1000 + k, t) for k, t in enumerate(["a b c d e", "A\tb c\x0bd e", "a b", "b a", "a  B", "", " ", None, "a b c d e f", "é É", "É é"])]
    expected = plain_components(rows)
    out = groups.near_duplicates(frame(spark, rows + rows[:3], parts=1)).collect()
    assert len(out) == len(rows) + 3
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == expected


def test_parts_of_a_large_group_do_not_all_meet(spark, monkeypatch):
    """Near copies in many parts: each part meets one of them; chains and strays are still found."""
    monkeypatch.setattr(groups, "GROUP", 3)
    met = []
    real = groups.links_between
    monkeypatch.setattr(groups, "links_between", lambda pairs, *rest: (met.append(pairs.count()), real(pairs, *rest))[1])
    words = [f"w{k}" for k in range(900)]
    rows = [(k, " ".join([*words[:200], f"own{k}"])) for k in range(60)]
    rows += [(100 + k, " ".join(words[300 + 4 * k : 340 + 4 * k])) for k in range(40)]  # each like the next alone
    rows += [(200, " ".join(words[20:200])), (201, " ".join(words[60:200]))]
    out = groups.near_duplicates(frame(spark, rows, parts=1)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == plain_components(rows)
    assert len(met) == 2 and sum(met) < 150  # of the 190 pairs of 20 parts alone, and as many of the chain


def test_near_duplicates_with_null_and_clashing_ids(spark):
    text = " ".join(map(str, range(40)))
    rows = [(5, text), (None, text), (3, text + " x"), (5, "another text under this id of a few words"), (9, text)]
    out = groups.near_duplicates(frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.component_id) for r in out) == {(5, 3): 2, (None, None): 1, (3, 3): 1, (9, 3): 1}
    assert groups.near_duplicates(frame(spark, [])).collect() == []
    assert groups.near_duplicates(frame(spark, [(1, None)])).collect()[0].component_id == 1


# ------------------------------------------------------------------ packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_packing(rows, out, capacity):
    tokenizer = Tokenizer.from_file(PATH)
    by_doc = {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        cut = [ids[k : k + capacity] for k in range(0, len(ids), capacity)]
        found = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in found] == [
            (k, k * capacity, len(c), crc32(np.array(c, "<u4").tobytes())) for k, c in enumerate(cut)
        ]
    check_places([(r.sequence_id, r.offset, r.length) for r in out], capacity)


def check_places(places, capacity):
    at = {}
    for sequence, offset, length in sorted(places):
        assert at.get(sequence, 0) == offset
        at[sequence] = offset + length
    assert not at or max(at.values()) <= capacity
    return len(at)


def test_packing_of_the_given_texts(spark):
    rows = given(spark)
    out = queries.op9_configuration_packing(spark, FOLDER).collect()
    check_packing(rows, out, 2048)
    bound = -(-sum(r.length for r in out) // 2048)
    assert len({r.sequence_id for r in out}) <= bound * 1.01 + 1


@pytest.mark.parametrize("part", [40, 6_000_000])  # bytes worked on at once
def test_words_by_themselves_are_tokenised_like_whole_texts(monkeypatch, part):
    monkeypatch.setattr(packing, "SLICE_BYTES", part)
    rnd = random.Random(3)
    letters = "abZÉé́ßİıΣσς  \n\t\x0b\x1c\x85\xa0.,;:!?'s0²Ⅷ漢<|>🙂ªµ"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    texts += ["x<|endoftext|>y, a.", "It's you're. we'll!", "A.B. c.. d?! e,", "x<|endoftext|> y*** z### é&&& ×, ÷. ß$%.", "a" * 5000, ""]
    texts += ["<|ENDOFTEXT|> hi", "<|EndOfText|>x", "A<|endoftext|>B. C", "<|startoftext|>X<|STARTOFTEXT|>", "É.<|", "<|", ". .a .", "!"]
    for mark in ("<|startoftext|>", "<|endoftext|>"):
        mixes = ["".join(rnd.choice([c, c.upper()]) for c in mark) for _ in range(50)]
        texts += [rnd.choice(["", "Word ", "x", "É"]) + m + rnd.choice(["", " Word.", "Y,", "\n"]) for m in [*mixes, mark]]
    tokenizer = Tokenizer.from_file(PATH)
    for _ in range(2):  # the second time from the words kept
        ids, sizes = packing.text_ids([t.encode() for t in texts], PATH, 0)
        edges = np.r_[0, np.cumsum(sizes)]
        assert edges[-1] == len(ids)
        for text, a, b in zip(texts, edges, edges[1:]):
            assert ids[a:b].tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 0], text


def test_kept_words_are_bounded_and_change_nothing(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 40)
    known = packing.WordIds(PATH)
    rnd = random.Random(4)
    words = [f"w{'abcdefgh'[k % 8]}{'xyz'[k % 3] * (k // 9)}" for k in range(300)] + ["y" * 100, "é" * 9]
    whole = dict(zip(words, packing.WordIds(PATH).of([w.encode() for w in words])))
    for _ in range(40):
        some = rnd.sample(words, 15)
        assert known.of([w.encode() for w in some]) == [whole[w] for w in some]
        assert len(known.young) + len(known.old) <= 40 + 2 * 15 and b"y" * 100 not in known.young


def best_fit(counts, capacity):
    free = []
    for length in sorted(Counter(counts).elements(), reverse=True):
        room = min((f for f in free if f >= length), default=None)
        if room is None:
            room = capacity
        else:
            free.remove(room)
        free.append(room - length)
    return len(free)


@pytest.mark.parametrize("case", ["pairs", "triples", "random", "one", "full", "halves"])
def test_plans_hold_every_piece_and_come_near_the_bound(case):
    rnd = random.Random(6)
    capacity = 200
    counts = {
        "pairs": Counter({150: 1000, 50: 1000}),
        "triples": Counter({100: 90, 60: 90, 40: 90}),
        "random": Counter(rnd.randint(1, 199) for _ in range(3000)),
        "one": Counter({7: 1}),
        "full": Counter({200: 12}),
        "halves": Counter({101: 50, 99: 49, 1: 3}),
    }[case]
    chosen, bound = packing.plan(counts, capacity)
    held = Counter()
    for config, n in chosen.items():
        assert sum(config) <= capacity
        for length in config:
            held[length] += n
    assert held == counts
    used = sum(chosen.values())
    assert bound <= used + 1e-6 and used <= min(best_fit(counts, capacity) * 1.015 + 1, bound * 1.04 + 1.5)


def test_knapsack_like_every_choice():
    rnd = random.Random(9)
    lengths = np.array([3, 4, 7, 9])
    for _ in range(20):
        prices = np.array([rnd.random() for _ in lengths])
        best, last = packing.knapsack(lengths, prices, 20)
        every = [0.0] * 21
        for room in range(1, 21):
            every[room] = max([every[room - 1], *(every[room - n] + p for n, p in zip(lengths, prices) if n <= room)])
        assert best == pytest.approx(every)
        taken = packing._unwind(last, lengths, 20)
        assert sum(lengths[taken]) <= 20 and sum(prices[taken]) == pytest.approx(best[20])


def test_packing_of_odd_texts(spark):
    rows = [(1, None), (2, ""), (3, "word " * 9000), (None, "a b"), (4, "x"), (5, "é" * 3000)]
    cut = packing.pieces(frame(spark, rows + [(4, "x")]), PATH, 64)
    out = packing.pack(cut.selectExpr("*", "crc32(ids) AS ids_crc32", "1 AS sequence_id").drop("ids"), 64).collect()
    assert sum(r.doc_id == 4 for r in out) == 2
    places = [(r.sequence_id, r.offset, r.length) for r in out]
    check_places(places, 64)
    assert packing.pack(packing.pieces(frame(spark, []), PATH, 64), 64).collect() == []
    with pytest.raises(Exception, match="not from 1 to 64"):
        packing.pack(spark.createDataFrame([(65,)], "length long"), 64).collect()


# ------------------------------------------------------------------ language


def test_kernel_counts_shared_ngrams():
    def plain(text):
        data = text.lower().encode()
        return {data[k : k + n] for n in range(1, 5) for k in range(len(data) - n + 1)}

    for text in ["", "a", "ab", "abc", "Abcabc", "éa\x00a\x00\x00", "banana bandana", "\x00"]:
        assert len(language.ngrams(text)) == len(plain(text))
    a, b = "the cat sat", "The mat"
    assert len(np.intersect1d(language.ngrams(a), language.ngrams(b))) == len(plain(a) & plain(b))


def test_folded_weights_equal_the_plain_regression():
    rnd = random.Random(1)
    names = ["x" if k % 2 else "y" for k in range(30)]
    texts = ["".join(rnd.choice("abcd" if n == "x" else "cdef") for _ in range(50)) for n in names]
    model = language.fit(texts, names, landmarks=5, order=3, ridge=1e-2)
    sets = [set(language.ngrams(t, 3).tolist()) for t in texts]
    chosen = [i for k in "xy" for i in [j for j, n in enumerate(names) if n == k][:5]]
    kernel = np.array([[len(a & sets[j]) / np.sqrt(len(a) * len(sets[j])) for j in chosen] for a in sets])
    worth, basis = np.linalg.eigh(kernel[chosen])
    features = kernel @ basis / np.sqrt(worth)
    target = np.array([[n == "x", n == "y"] for n in names], float)
    weights = np.linalg.solve(features.T @ features + 1e-2 * 30 * np.eye(10), features.T @ target)
    assert model.values(texts) == pytest.approx(features @ weights, abs=1e-4)


def test_language_query(spark):
    out = queries.op6_kernel_language(spark, "/root/testdata/sf0.01").collect()
    true = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    assert len(out) == len(true) and all(0 <= r.score <= 1 for r in out)
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    tried = [r for r in out if r.held_out]
    assert sum(r.lang_pred == true[r.doc_id] for r in tried) >= 0.98 * len(tried)


def test_language_of_odd_texts(spark):
    rows = [(1, "the cat and the dog and the house", "en"), (2, "der Hund und die Katze und das Haus", "de"), (3, None, "en"), (4, "", "de"), (5, "12 !", None), (None, "the dog", "en"), (6, "und die", None), (7, "²Ⅷ", "xx")]
    docs = spark.createDataFrame([(*r, 0.5, 1) for r in rows], "doc_id long, text string, lang string, score double, value int")
    model = language.train(docs)
    assert model.languages == ("de", "en")
    out = language.predict(docs, model, docs.columns)
    assert out.columns == ["doc_id", "text", "lang", "value", "lang_pred", "score"]
    found = {r.doc_id: (r.lang_pred, r.score) for r in out.collect()}
    assert {i: n for i, (n, _) in found.items()} == {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", None: "en", 6: "de", 7: "und"}
    assert found[3] == ("und", 0.0)
    nothing = language.train(docs.where("false"))
    assert {r.lang_pred for r in language.predict(docs, nothing, ["doc_id"]).collect()} == {"und"}
    assert language.predict(docs.where("false"), model, ["doc_id"]).collect() == []


def test_language_of_repeated_and_very_long_texts(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where("lang is not null")
    model = language.train(docs)
    by_lang = {r.lang: r.text for r in docs.where("length(text) > 400").collect()}
    rows = [(k, t) for k, t in enumerate(by_lang.values())]
    rows += [(100 + k, f"{t} " * (1 + 600_000 // len(t))) for k, t in enumerate(by_lang.values())] + rows + rows
    found = {}
    for r in language.predict(frame(spark, rows), model, ["doc_id"]).collect():
        found.setdefault(r.doc_id, []).append((r.lang_pred, r.score))
    for k, lang in enumerate(by_lang):
        assert len(found[k]) == 3 and len(set(found[k])) == 1 and found[k][0][0] == lang
        assert len(found[100 + k]) == 1 and found[100 + k][0][0] == lang and 0 <= found[100 + k][0][1] <= 1


# ------------------------------------------------------------------ toxicity


def kinds(text):
    found = toxicity.Model().matches(text)
    return {k: n for k, n in zip(toxicity.KINDS, found) if n}


def test_clauses_not_words():
    assert kinds("you are an idiot") == {(1, 1, "asserted"): 1}
    assert kinds("an idiot. you") == {(1, 0, "asserted"): 1}
    assert kinds("you are not an idiot") == {(1, 1, "negated"): 1}
    assert kinds("not here. an idiot") == {(1, 0, "asserted"): 1}
    assert kinds("he said that some idiot came") == {(1, 1, "reported"): 1}
    assert kinds("kill them! kill") == {(2, 0, "asserted"): 2}
    assert kinds("you, kill the process") == {(2, 1, "asserted"): 1}
    assert kinds("not you they said") == {} and kinds("") == {}


def test_composed_transducer_equals_its_parts_in_series():
    rnd = random.Random(4)
    weights = [rnd.random() for _ in toxicity.KINDS]
    parts = [toxicity.negation(3), toxicity.reported(), toxicity.target(6), toxicity.offence(weights)]
    whole = toxicity.grammar(weights)
    for _ in range(200):
        symbols = [rnd.choice(toxicity.SYMBOLS) for _ in range(rnd.randrange(60))]
        read, weight = symbols, 0.0
        for part in parts:
            read, more = part.run(read)
            weight += more
        written, total = whole.run(symbols)
        assert written == read and abs(total - weight) < 1e-9
    # What one writes is what the next reads: the order matters.
    other = toxicity.compose(toxicity.reported(), toxicity.negation(3)), toxicity.compose(toxicity.negation(3), toxicity.reported())
    symbols = [toxicity.REPORT, toxicity.NEGATION, toxicity.INSULT]
    assert [toxicity.KINDS[t.run(symbols)[0][-1] - 5][2] for t in other] == ["negated", "reported"]


def plain_matches(model, text):
    """The matches of a text by looking back from each word, without any transducer."""
    tokens = re.findall(r"[^\W_]+(?:['’][^\W_]+)?|[.!?;\n]", text.lower())
    symbols = [model._lexicon[t] for t in tokens]
    found, start = Counter(), 0
    for k, symbol in enumerate(symbols):
        if symbol == toxicity.END:
            start = k + 1
        if symbol >= 5:
            clause = symbols[start:k]
            what = toxicity.KINDS[symbol - 5][0]
            aimed = int(toxicity.TARGET in clause[-6:])
            how = "reported" if toxicity.REPORT in clause else "negated" if toxicity.NEGATION in clause[-3:] else "asserted"
            found[what, aimed, how] += 1
    return found


def test_toxicity_query(spark):
    folder = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in queries.op8_clause_toxicity(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/labels.parquet")
    labels = {r.doc_id: r.toxic for r in rows.collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out.values())
    tried = [(labels[i], r.predicted) for i, r in out.items() if r.held_out and i in labels]
    assert all(r.held_out == (crc32(str(i).encode()) % 5 == 0) for i, r in out.items())
    hit = sum(a == b == 1 for a, b in tried)
    assert hit >= 0.8 * sum(a for a, _ in tried) and hit >= 0.9 * sum(b for _, b in tried)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.train(docs, rows.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))
    for r in docs.collect():
        weights = dict(zip(toxicity.KINDS, model.weights[1:]))
        value = model.weights[0] + sum(n * weights[k] for k, n in plain_matches(model, r.text or "").items())
        assert out[r.doc_id].score == pytest.approx(1 / (1 + np.exp(-np.clip(value, -40, 40))), abs=1e-9)


def test_texts_that_share_two_words_all_count():
    """Two words of least hash in common make no near copy; the same words altogether do."""
    words = sorted(("".join(w) for w in product("abcdefgh", repeat=5)), key=lambda w: crc32(w.encode()))
    common, rest = words[:2], words[2:]
    clean = [" ".join(rest[12 * k : 12 * k + 12]) for k in range(500)]
    toxic = [" ".join([*common, "foulish", *rest[9000 + 9 * k : 9009 + 9 * k]]) for k in range(20)]
    stems, found = toxicity.learn_insults(toxic + clean, [1] * 20 + [0] * 500)
    assert any("foulish".startswith(stem) for stem in stems) or "foulish" in found
    stems, found = toxicity.learn_insults(toxic[:1] * 20 + clean, [1] * 20 + [0] * 500)
    assert not stems and not found


def test_sample_takes_the_first_ids_by_hash(spark):
    rows = [(i, "a" if i % 10 else "b") for i in range(5000)] + [(None, "a"), (7, None)]
    table = spark.createDataFrame(rows, "id long, lang string").repartition(5)
    found = sample_ids(table, "id", "lang", 40)
    order = {r.id: r.h for r in table.where("id is not null").select("id", F.xxhash64("id").alias("h")).collect()}
    for value in ("a", "b"):
        want = sorted((i for i, v in rows if v == value and i is not None), key=lambda i: order[i])[:40]
        assert sorted(r.id for r in found.collect() if r.value == value) == sorted(want)
    assert sample_ids(table, "id", "lang", 10_000).count() == 5000 and sample_ids(table.where("false"), "id", "lang", 5).count() == 0


def test_toxicity_of_odd_tables(spark):
    rows = [(1, "you idiot"), (2, None), (3, ""), (None, "you idiot"), (1, "you idiot"), (4, "word " * 50_000)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1), (4, 0), (9, 7)], "doc_id long, toxic int")
    for known in (labels, labels.where("false"), labels.where("toxic = 1")):
        out = toxicity.predict(docs, toxicity.train(docs, known), ["doc_id", "n", "row"]).collect()
        assert len(out) == len(rows) and {r.n for r in out} == {5}
        score = {r.doc_id: r.score for r in out}
        assert score[1] == score[None] > score[2] == score[3]
    assert toxicity.predict(docs.where("false"), toxicity.Model(), ["doc_id"]).collect() == []


def test_toxicity_of_texts_with_unlike_labels_and_very_long_ones(spark):
    rows = [(k, "you are a foul idiot, all of you") for k in range(8)] + [(20 + k, f"a plain text number {k} of words") for k in range(8)]
    rows += [(40, "you idiot. " * 100_000), (41, "fine words. " * 100_000)]
    labels = [(k, k % 2) for k in range(8)] + [(20 + k, 0) for k in range(8)] + [(3, 0)]  # one text under both labels, one id too
    model = toxicity.train(frame(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    out = {r.doc_id: r.score for r in toxicity.predict(frame(spark, rows), model, ["doc_id"]).collect()}
    assert len({out[k] for k in range(8)}) == 1 and out[0] > out[20] == out[41]
    assert all(0 <= s <= 1 for s in out.values()) and out[40] >= out[0]
