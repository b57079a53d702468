"""Language by blended-spectrum string kernels, Nyström landmarks and kernel ridge regression.

The kernel of two texts counts the byte n-grams of 1 to ``order`` bytes that
both hold, over the geometric mean of how many each holds.  ``landmarks`` texts
of each language span the feature space (Nyström); one ridge regression against
the rest is solved per language.  Because a text meets the landmarks only by
the n-grams it shares with them, landmarks, whitening and regression fold into
one weight per (n-gram, language): a batch of texts is scored by one product of
its n-gram presence matrix with these weights.

The fit uses a sample of at most ``per_language`` labelled texts a language;
everything else reads every row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbscope.llm.common import map_text, sample_ids

PER_LANGUAGE = 150
LANDMARKS = 40
ORDER = 4
RIDGE = 1e-3
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


def ngrams(text: str, order: int = ORDER) -> np.ndarray:
    """Sorted codes of the distinct byte n-grams of 1 to ``order`` (at most 7) bytes, lower case."""
    data = np.frombuffer(text.lower().encode(), np.uint8)
    kind = np.uint32 if order <= 4 else np.uint64
    n = min(order, len(data))
    if not n:
        return np.empty(0, np.uint64)
    codes = np.zeros(len(data) - n + 1, kind)
    for k in range(n):
        codes = (codes << kind(8)) | data[k : len(data) - n + 1 + k]
    found = []
    for size in range(n, 0, -1):
        codes = np.unique(codes)
        found.append(codes.astype(np.uint64) + (np.uint64(size) << np.uint64(57)))
        # The shorter n-grams are the heads of these and the one at the end.
        if size > 1:
            tail = 0
            for byte in data[len(data) - size + 1 :]:
                tail = tail << 8 | int(byte)
            codes = np.append(codes >> kind(8), kind(tail))
    return np.concatenate(found[::-1])


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    codes: np.ndarray  # sorted n-grams of the landmarks
    weights: np.ndarray  # one row for each n-gram, one column for each language
    order: int

    def values(self, texts: list[str]) -> np.ndarray:
        """Regression value of each text and language."""
        if not len(self.codes):
            return np.zeros((len(texts), len(self.languages)))
        out = np.zeros((len(texts), len(self.languages)))
        for first in range(0, len(texts), 64):
            part = [ngrams(t, self.order) for t in texts[first : first + 64]]
            row = np.repeat(np.arange(len(part)), [len(g) for g in part])
            every = np.concatenate(part)
            at = np.searchsorted(self.codes, every)
            at[at == len(self.codes)] = 0
            hit = self.codes[at] == every
            present = np.zeros((len(part), len(self.codes)), np.float32)
            present[row[hit], at[hit]] = 1
            size = np.maximum([len(g) for g in part], 1)
            out[first : first + 64] = present @ self.weights / np.sqrt(size)[:, None]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; no letter (or null): ``und`` and 0."""
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)]
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if known and self.languages:
            values = self.values([texts[i] for i in known])
            best = values.argmax(1)
            for i, k, v in zip(known, best, values[np.arange(len(known)), best]):
                names[i], scores[i] = self.languages[k], float(min(1.0, max(0.0, v)))
        return names, scores


def fit(texts: list[str], names: list[str], landmarks: int = LANDMARKS, order: int = ORDER, ridge: float = RIDGE) -> Model:
    """Fit on texts in the given order; the first ``landmarks`` of each language are the landmarks."""
    languages = tuple(sorted(set(names)))
    sets = [ngrams(t, order) for t in texts]
    usable = [i for i, s in enumerate(sets) if len(s)]
    chosen, seen = [], dict.fromkeys(languages, 0)
    for i in usable:
        if seen[names[i]] < landmarks:
            seen[names[i]] += 1
            chosen.append(i)
    if not chosen:
        return Model(languages, np.empty(0, np.uint64), np.zeros((0, len(languages)), np.float32), order)
    codes = np.unique(np.concatenate([sets[i] for i in chosen]))
    holds = np.zeros((len(codes), len(chosen)), np.float32)  # landmarks, each of unit length
    for column, i in enumerate(chosen):
        holds[np.searchsorted(codes, sets[i]), column] = 1 / np.sqrt(len(sets[i]))
    kernel = np.zeros((len(usable), len(chosen)))
    for row, i in enumerate(usable):
        at = np.searchsorted(codes, sets[i])
        at[at == len(codes)] = 0
        kernel[row] = holds[at[codes[at] == sets[i]]].sum(0, dtype=np.float64) / np.sqrt(len(sets[i]))
    among = kernel[[usable.index(i) for i in chosen]]
    worth, basis = np.linalg.eigh((among + among.T) / 2)
    solid = worth > 1e-8 * worth.max()
    whiten = basis[:, solid] / np.sqrt(worth[solid])
    features = kernel @ whiten
    target = np.array([[float(names[i] == n) for n in languages] for i in usable])
    solved = np.linalg.solve(features.T @ features + ridge * len(usable) * np.eye(features.shape[1]), features.T @ target)
    return Model(languages, codes, (holds @ (whiten @ solved)).astype(np.float32), order)


def train(
    docs: DataFrame,
    per_language: int = PER_LANGUAGE,
    landmarks: int = LANDMARKS,
    order: int = ORDER,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> Model:
    """Fit on a sample of the rows of ``docs``, chosen by a hash of the id.

    At most ``per_language`` ids of each language are taken, and the whole texts
    of these come to the driver.  Rows without id, language or letter are left out.
    """
    ids = sample_ids(docs, id_col, lang_col, per_language)
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("value"))
    found = rows.join(F.broadcast(ids), ["id", "value"]).where("text is not null").distinct().collect()
    found = sorted((r.id, r.value, r.text) for r in found if _LETTER.search(r.text))
    return fit([t for _, _, t in found], [n for _, n, _ in found], landmarks, order)


def predict(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text", letter: bool = False) -> DataFrame:
    """Columns ``keep``, then ``lang_pred`` string and ``score`` double, for every row.

    A null text, or one without a letter, is ``und`` with score 0; so is every text
    if nothing could be learned.  ``letter`` adds ``lettered`` boolean, which tells
    the two apart.
    """

    def run(texts: list[str | None]) -> list[pa.Array]:
        names, scores = model.predict(texts)
        made = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
        return [*made, pa.array([bool(t and _LETTER.search(t)) for t in texts])] if letter else made

    return map_text(docs, text_col, keep, "lang_pred string, score double" + ", lettered boolean" * letter, run)
