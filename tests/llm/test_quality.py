"""Quality counts and certified cutoffs against plain versions."""

import random
import re
from collections import Counter, defaultdict
from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.compare import connect, difference
from kerbscope.llm import quality, queries

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, kept int, stratum string, n_words string, level int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "s", "x", 2) for i, t, lang in rows], SCHEMA).repartition(3)


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    uses = Counter(windows)
    again = {k + j for k, w in enumerate(windows) if uses[w] > 1 for j in range(5)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(again)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab \n\t\x0b\x1f \u0085é#|<日")), max_size=6))
def test_counts_of_drawn_texts(texts):
    found = quality.text_counts(pa.array(["skipped # text\n", *texts], pa.string()).slice(1))
    assert [list(map(int, c)) for c in zip(*found)] == [plain_counts(t) for t in texts]


def test_windows_whose_hashes_clash_are_told_apart(monkeypatch):
    rnd = random.Random(4)
    texts = [" ".join(rnd.choices("abc", k=200)) for _ in range(4)]
    wanted = [plain_counts(t) for t in texts]
    monkeypatch.setattr(quality, "mix", lambda values: values & np.uint64(1))
    assert [list(map(int, c)) for c in zip(*quality.text_counts(pa.array(texts)))] == wanted


def exact_tail(hits, trials, chance):
    return sum(comb(trials, j) * chance**j * (1 - chance) ** (trials - j) for j in range(hits + 1))


def test_binomial_tail_and_bound():
    for trials in (1, 7, 400):
        for hits in range(0, trials + 1, max(1, trials // 9)):
            for chance in (Fraction(1, 100), Fraction(3, 10), Fraction(9, 10)):
                assert abs(quality.binomial_tail(hits, trials, float(chance)) - float(exact_tail(hits, trials, chance))) < 1e-10
            bound = quality.upper_bound(hits, trials, 0.01)
            assert hits == trials or abs(quality.binomial_tail(hits, trials, bound) - 0.01) < 1e-9
    assert quality.binomial_tail(10**7 // 200, 10**7, 0.01) < 1e-300 or quality.binomial_tail(10**7 // 200, 10**7, 0.01) >= 0
    assert quality.upper_bound(0, 0, 0.05) == 1.0


def plain_verdicts(rows, labels):
    """Kept or not, by row, from exact fractions."""
    told = defaultdict(set)
    for i, label in labels:
        if i is not None and label in (0, 1):
            told[i].add(label)
    rated = []
    for i, text, lang in rows:
        c = dict(zip(quality.COUNTS, plain_counts(text or "")))
        failed = c["n_words"] < 10 or 100 * c["n_repeat_words"] > 20 * c["n_words"]
        levels = []
        for rule in quality.RULES:
            hit = [1000 * c[rule.part] > x * c[rule.whole] if rule.above else 1000 * c[rule.part] < x * c[rule.whole] for x in rule.cutoffs]
            levels.append(sum(hit))
        rated.append((i, lang or "", tuple(c.values()), failed, levels))
    holdout = {(i, lang, c): (min(told[i]), levels) for i, lang, c, failed, levels in rated if not failed and i in told and len(told[i]) == 1}
    strata = {lang for (_, lang, _), (label, _) in holdout.items() if label == 1}
    chosen = {}
    for lang in strata:
        for k, rule in enumerate(quality.RULES):
            by = [[h[1][k] for key, h in holdout.items() if key[1] == lang and h[0] == label] for label in (0, 1)]
            most = 0
            for level in range(len(rule.cutoffs), 0, -1):
                bad, clean = (sum(x >= level for x in side) for side in by)
                if exact_tail(clean, len(by[1]), Fraction(1, 100)) > Fraction(5, 100 * 5 * len(strata)):
                    break
                gain = bad * len(by[1]) - clean * len(by[0])
                if gain > most:
                    most, chosen[lang, k] = gain, level
    return [not failed and not any(levels[k] >= chosen.get((lang, k), 99) for k in range(len(levels))) for _, lang, _, failed, levels in rated], chosen


def made(seed=3, clean=1500):
    rnd = random.Random(seed)

    def text(kind):
        words = ["".join(rnd.choices("abcdefgh", k=rnd.randrange(2, 9))) for _ in range(rnd.randrange(12, 40))]
        if kind == "symbols":
            words = [w + "$$$" for w in words]
        if kind == "long":
            words = [w * 4 for w in words]
        return "\n".join(" ".join(words[k : k + 9]) for k in range(0, len(words), 9))

    rows, labels = [], []
    for i in range(clean + 300):
        kind = "plain" if i < clean else ("symbols", "long")[i % 2]
        rows.append((i, text(kind), "en" if i % 5 else None))
        if i % 3:
            labels.append((i, int(kind == "plain")))
    rows += [(5000 + k, text(rnd.choice(["plain", "long"])), "few") for k in range(40)]
    labels += [(5000 + k, 1) for k in range(20)]
    rows += [(None, text("symbols"), "en"), (9000, None, "en"), (9001, "", None), (9002, "w " * 50_000, "en"), (1, rows[1][1], "en"), (1, "some other text of number one " + text("plain"), "en")]
    labels += [(None, 1), (2, 0), (2, 1), (4, 7), (4, None), (5, 1), (5, 1)]
    return rows, labels


def test_verdicts_of_made_texts(spark):
    rows, labels = made()
    wanted, chosen = plain_verdicts(rows, labels)
    label_table = spark.createDataFrame([(i, q, "x") for i, q in labels], "doc_id long, quality int, kept string")
    found = quality.filter_documents(frame(spark, rows), label_table).collect()
    assert found[0].asDict().keys() == {"doc_id", "stratum", *quality.COUNTS, "base_failed", "rejected_by", "kept"}
    key = [(str(i), lang or "", *plain_counts(t or ""), kept) for (i, t, lang), kept in zip(rows, wanted)]
    assert sorted((str(r.doc_id), r.stratum, *(r[c] for c in quality.COUNTS), r.kept) for r in found) == sorted(key)
    assert all(r.kept == (not r.base_failed and not r.rejected_by) for r in found)
    # Rules stand where labels prove them; few labels prove nothing.
    assert {lang for lang, _ in chosen} == {"en"} and {k for _, k in chosen} >= {0, 1}
    bad = [kept for (i, _, lang), kept in zip(rows, wanted) if i is not None and 1500 <= i < 1800 and lang == "en"]
    assert sum(bad) < 0.1 * len(bad)


def test_without_labels_or_rows(spark):
    rows, _ = made(clean=30)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept == (not r.base_failed) for r in quality.filter_documents(frame(spark, rows), none).collect())
    assert quality.filter_documents(frame(spark, []), none).collect() == []


def test_guarantee_holds_on_fresh_documents():
    """Of many drawn holdouts at a true rate just above the bound, few let the cutoff through."""
    rnd = np.random.default_rng(8)
    passed = 0
    for _ in range(400):
        hits = int(rnd.binomial(800, 0.0101))
        level, _ = quality.choose_level([800 - hits, hits], [0, 50], 0.01, 0.05)
        passed += level > 0
    assert passed <= 0.08 * 400


def test_query_equals_its_sql(spark):
    found = queries.op13_risk_controlled(spark, FOLDER).toPandas()
    assert difference(found, connect(FOLDER).sql(queries.oracle_sql()["op13_risk_controlled"]).df()) is None
