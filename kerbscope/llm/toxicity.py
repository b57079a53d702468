"""Toxicity by a weighted finite-state grammar over clauses.

A text becomes a string of symbols: a lexicon transducer writes insult, threat,
partly abusive word, target, negation, reported speech or other for each word, and
the end of a clause as its own symbol.  Four transducers follow, and each reads what
the one before wrote: a match in reach of a negation is rewritten as a negated one,
one behind a word of saying as a reported one, one in reach of a target as an aimed
one, and the last puts the weight of its kind on the arc of each match.  ``compose``
joins them into one sequential transducer.  The weight of its path through a
clause is the clause's score, and a text's score is the logistic function of the sum
over its clauses and a constant: words that match no clause pattern, a target or a
negation alone, count for nothing.

What is learned: stems of insults beyond the given lists (from how the labels
split the texts that hold them) and the weights on the arcs.  The fit uses a
sample of at most ``per_label`` labelled texts of each label.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import reduce
from math import exp, log, log1p
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbscope.llm.common import map_text, sample_ids

PER_LABEL = 2000
#: A stem is learned if its use in toxic texts has less than this chance (in nats,
#: bounded by the binomial tail) and its rate there is so many times the rate
#: elsewhere; it is an insult if other texts have this share of its uses at most,
#: else a word that is abusive in part of its uses.
STEM_NATS = 16.0
STEM_LIFT = 6.0
STEM_SHARE = 0.02
STEM_LENGTHS = range(4, 8)
RIDGE = 1.0
SKETCH = 8
KNOWN_WORDS = 300_000

# The lists below are fixed values: starting lexicon by language.
INSULTS = "idiot moron stupid loser pathetic worthless disgusting scum trash clown fool dumb jerk vermin imbecile dummkopf trottel abschaum crétin imbécile ordure connard estúpido imbécil basura escoria"
THREATS = "kill hurt destroy beat punch stab shoot töten umbringen tuer frapper matar golpear"
TARGETS = "you your yours yourself he she him her they them this that these those du dich dir dein ihr euch er sie tu te toi ton ta vous il elle ils elles tú ti usted ustedes él ella ellos ellas"
NEGATIONS = "not no never none neither nor cannot don't isn't aren't nicht kein keine nie niemals ne pas jamais ni nunca jamás"
REPORTS = "said says say told tells claimed claims wrote writes quoted quotes called reported sagte sagt schrieb behauptet dit écrit affirme dijo dice escribió afirma"

#: What a match can be: insult, threat or partly abusive word, plain or aimed, asserted or negated or reported.
KINDS = [(what, aimed, how) for what in (1, 2, 3) for aimed in (0, 1) for how in ("asserted", "negated", "reported")]
#: Symbols of all transducers: five that open or end something, then one for each kind.
OTHER, TARGET, NEGATION, REPORT, END = range(5)
SYMBOLS = range(5 + len(KINDS))
INSULT, THREAT, ABUSE = (5 + KINDS.index((what, 0, "asserted")) for what in (1, 2, 3))

_TOKEN = re.compile(r"[^\W_]+(?:['’][^\W_]+)?|[.!?;\n]")
_ENDS = frozenset(".!?;\n")


# ------------------------------------------------------------------ transducers


@dataclass(frozen=True)
class Transducer:
    """Sequential and weighted: ``step[state][symbol]`` is the next state, the symbol written and the arc's weight."""

    step: tuple[tuple[tuple[int, int, float], ...], ...]

    @staticmethod
    def of(states: int, move) -> Transducer:
        return Transducer(tuple(tuple(move(q, s) for s in SYMBOLS) for q in range(states)))

    def run(self, symbols) -> tuple[list[int], float]:
        """What is written for ``symbols``, and the weight of the path."""
        state, weight, out = 0, 0.0, []
        for symbol in symbols:
            state, written, arc = self.step[state][symbol]
            out.append(written)
            weight += arc
        return out, weight


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that gives what ``second`` makes of what ``first`` writes; weights add up.

    Its states are the pairs that can be reached.
    """
    pairs, table = {(0, 0): 0}, []
    for p, q in iter_growing(pairs):
        row = []
        for symbol in SYMBOLS:
            p_next, written, arc = first.step[p][symbol]
            q_next, out, more = second.step[q][written]
            row.append((pairs.setdefault((p_next, q_next), len(pairs)), out, arc + more))
        table.append(tuple(row))
    return Transducer(tuple(table))


def iter_growing(pairs: dict):
    """The keys of a dictionary that grows meanwhile, in their order."""
    done = 0
    while done < len(pairs):
        for key in list(pairs)[done:]:
            done += 1
            yield key


def _marked(symbol: int, place: int, value) -> int:
    """The kind ``symbol`` with one of its parts changed; any other symbol as it is."""
    if symbol < 5:
        return symbol
    kind = list(KINDS[symbol - 5])
    kind[place] = value
    return 5 + KINDS.index(tuple(kind))


def negation(reach: int) -> Transducer:
    """Matches at most ``reach`` tokens after a negation, in its clause, are negated."""

    def move(state: int, symbol: int) -> tuple[int, int, float]:
        if symbol in (END, NEGATION):
            return (reach if symbol == NEGATION else 0), symbol, 0.0
        return max(0, state - 1), _marked(symbol, 2, "negated") if state else symbol, 0.0

    return Transducer.of(reach + 1, move)


def reported() -> Transducer:
    """Matches between a word of saying and the end of its clause are reported, negated ones too."""

    def move(state: int, symbol: int) -> tuple[int, int, float]:
        state = 0 if symbol == END else 1 if symbol == REPORT else state
        return state, _marked(symbol, 2, "reported") if state else symbol, 0.0

    return Transducer.of(2, move)


def target(reach: int) -> Transducer:
    """Matches at most ``reach`` tokens after a target, in its clause, are aimed."""

    def move(state: int, symbol: int) -> tuple[int, int, float]:
        if symbol in (END, TARGET):
            return (reach if symbol == TARGET else 0), symbol, 0.0
        return max(0, state - 1), _marked(symbol, 1, 1) if state else symbol, 0.0

    return Transducer.of(reach + 1, move)


def offence(weights) -> Transducer:
    """Insults, threats and partly abusive words weigh by their kind; all else weighs nothing."""
    return Transducer.of(1, lambda state, symbol: (0, symbol, float(weights[symbol - 5]) if symbol >= 5 else 0.0))


def grammar(weights, negation_reach: int = 3, target_reach: int = 6) -> Transducer:
    """Negation, reported speech, targets and offences, each reading what the one before wrote."""
    return reduce(compose, [negation(negation_reach), reported(), target(target_reach), offence(weights)])


# ------------------------------------------------------------------ the model


class _Lexicon(dict):
    """Symbol of each word met; filled on demand and emptied when full."""

    def __init__(self, words: dict[str, int], stems: dict[str, int]):
        super().__init__()
        self.words, self.stems = words, stems

    def __missing__(self, token: str) -> int:
        if token in _ENDS:
            symbol = END
        else:
            symbol = self.words.get(token, OTHER)
            if symbol == OTHER:
                symbol = min((self.stems[token[:n]] for n in STEM_LENGTHS if token[:n] in self.stems), default=OTHER)
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[token] = symbol
        return symbol


class Model:
    """Lexicon, composed grammar and weights; small, and sent to every task.

    ``stems`` and ``words`` give a symbol to heads of words and to whole words;
    ``weights`` are the constant and the weights of the kinds, which lie on the arcs.
    """

    def __init__(self, stems: dict[str, int] | None = None, words: dict[str, int] | None = None, weights: np.ndarray | None = None):
        self.stems, self.words = stems or {}, words or {}
        given = {1: 2.0, 2: 2.0, 3: 0.5}
        self.weights = np.r_[-3.0, [given[k[0]] * (1.0 if k[2] == "asserted" else 0.25) for k in KINDS]] if weights is None else weights
        self._ready()

    def _ready(self) -> None:
        known = dict(self.words)
        for symbol, listed in ((REPORT, REPORTS), (NEGATION, NEGATIONS), (TARGET, TARGETS), (THREAT, THREATS), (INSULT, INSULTS)):
            known |= dict.fromkeys(listed.split(), symbol)
        self._lexicon, self._machine = _Lexicon(known, self.stems), grammar(self.weights[1:])

    def __getstate__(self):
        return self.stems, self.words, self.weights

    def __setstate__(self, state):
        self.stems, self.words, self.weights = state
        self._ready()

    def symbols(self, text: str) -> bytes:
        """What the lexicon writes for the words and clause ends of the text."""
        return bytes(map(self._lexicon.__getitem__, _TOKEN.findall(text.lower())))

    def clauses(self, text: str) -> list[tuple[float, list[tuple]]]:
        """Weight and matches of each clause with a match."""
        symbols = self.symbols(text)
        if not any(symbol in symbols for symbol in (INSULT, THREAT, ABUSE)):
            return []
        found = []
        step, state = self._machine.step, 0
        weight, matches = 0.0, []
        for symbol in symbols:
            state, written, arc = step[state][symbol]
            if written >= 5:
                weight += arc
                matches.append(KINDS[written - 5])
            elif symbol == END and matches:
                found.append((weight, matches))
                weight, matches = 0.0, []
        return [*found, (weight, matches)] if matches else found

    def matches(self, text: str) -> list[int]:
        """How many matches of each kind the text's clauses have."""
        found = [0] * len(KINDS)
        for _, kinds in self.clauses(text):
            for kind in kinds:
                found[KINDS.index(kind)] += 1
        return found

    def score(self, text: str | None) -> float:
        """Logistic function of the constant and the weights of the matched clauses."""
        value = self.weights[0] + sum(weight for weight, _ in self.clauses(text or ""))
        return 1 / (1 + exp(-max(-40.0, min(40.0, value))))


def learn_insults(texts: list[str], labels: list[int]) -> tuple[dict[str, int], dict[str, int]]:
    """Stems (heads of words) and whole words that toxic texts use far more than others.

    A use is a text with a word; of texts with the same ``SKETCH`` words of least
    hash, which are near copies, one counts.
    """
    uses = {label: (Counter(), Counter()) for label in (0, 1)}
    texts_with: tuple[Counter, Counter] = (Counter(), Counter())
    total = [0, 0]
    seen = set()
    for text, label in zip(texts, labels):
        words = {t for t in _TOKEN.findall(text.lower()) if len(t) > 2}
        sketch = (label, *sorted(crc32(w.encode()) for w in words)[:SKETCH])
        if sketch in seen:
            continue
        seen.add(sketch)
        stems = Counter(w[:n] for w in words for n in STEM_LENGTHS if len(w) >= n)
        uses[label][0].update(stems)
        uses[label][1].update(words)
        total[label] += len(words)
        texts_with[0].update(stems.keys() if label else ())
        texts_with[1].update(words if label else ())
    share = total[1] / max(1, sum(total))
    found: list[dict[str, int]] = [{}, {}]
    for k in (0, 1):
        for word, n in uses[1][k].items():
            clean = uses[0][k][word]
            if texts_with[k][word] < 2 or n * (1 - share) < STEM_LIFT * clean * share:
                continue
            rate = n / (n + clean)
            nats = n * log(rate / share) + (clean * log((1 - rate) / (1 - share)) if clean else 0.0)
            if nats >= STEM_NATS:
                found[k][word] = INSULT if clean <= STEM_SHARE * n else ABUSE
    return found[0], found[1]


def fit_weights(rows: np.ndarray, labels: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Logistic regression by Newton steps; a ridge on all but the constant."""
    weights = np.zeros(rows.shape[1])
    penalty = ridge * np.eye(len(weights))
    penalty[0, 0] = 1e-6
    for _ in range(30):
        chance = 1 / (1 + np.exp(-np.clip(rows @ weights, -40, 40)))
        slope = rows.T @ (chance - labels) + penalty @ weights
        step = np.linalg.solve((rows * (chance * (1 - chance))[:, None]).T @ rows + penalty, slope)
        weights = weights - step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(texts: list[str], labels: list[int]) -> Model:
    """Without texts of both labels the given lists and weights stand."""
    if len(set(labels)) < 2:
        return Model()
    stems, words = learn_insults(texts, labels)
    model = Model(stems, words)
    rows = np.array([[1.0, *model.matches(t)] for t in texts])
    return Model(stems, words, fit_weights(rows, np.array(labels, float)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = PER_LABEL,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """Fit on at most ``per_label`` labelled texts of each label, chosen by a hash of the id.

    Labels other than 0 and 1, null ids and null texts are left out.  An id with
    two labels counts under each.
    """
    sound = labels.where(labels[label_col].isin(0, 1))
    ids = sample_ids(sound, id_col, label_col, per_label)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).where("text is not null")
    found = sorted((r.id, r.value, r.text) for r in rows.join(F.broadcast(ids), "id").distinct().collect())
    return fit([t for _, _, t in found], [int(v) for _, v, _ in found])


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """Columns ``keep``, then ``score`` double (0 to 1) and ``predicted`` int, for every row.

    A null text counts as empty; a text without a match, an empty one too, gets what
    the constant alone gives.  A very long text is one string of symbols; repeated
    rows score alike.
    """

    def run(texts: list[str | None]) -> list[pa.Array]:
        scores = [model.score(t) for t in texts]
        return [pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32())]

    return map_text(docs, text_col, keep, "score double, predicted int", run)
