"""Quality classifier: ordinal cumulative-link (proportional odds) regression on graded ratings.

A document's score is one inner product of shared weights with hashed text features; a rating of
grade g or more has probability sigmoid(score - threshold_g), with thresholds that ascend. The model
gives the expected grade and the tail probability P(grade >= top), by which documents are selected.

Features (a set per document, so long texts are not louder than short ones word by word):
* each word's lower-cased letters, and its first 4, 5 and 6 bytes;
* the punctuation that follows a word;
* shares of the text (symbols, capital words, words equal to the one before, repeated words),
  each as indicators of the bounds it reaches.

Training reads a bounded sample of labelled documents (``max_rows``, chosen by a hash of the id, so
reruns agree); scoring reads every whole text. Weights have a fixed size (2**bits floats) and are the
only thing that travels to the tasks.

Defined results: a null or empty text has one constant feature and is scored like any other; a
text of any length is read whole; repeated rows and ids are scored row by row; null labels are left
out of training; without at least two different grades there is no model: grades and probabilities
are null and every document is kept. An id that repeats gives one training text (that of least hash);
ids may be of any type; an empty table gives no rows. Columns other than the id and the text pass through unread.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.llm.text_bytes import mix, powers, prefix_hash, to_bytes, word_bounds

BITS = 18
MAX_TRAINING_ROWS = 16_000
EPOCHS = 12
LEAST_ROWS = 4
_LETTER = np.zeros(256, bool)
_LETTER[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>!@^~{}[]\\/"]] = True
_ALWAYS = mix(np.array([999], np.uint64))  # a feature of every text
_SHARE_BINS = np.array([0.002, 0.01, 0.03, 0.1, 0.25, 0.5])
_SHARE_COPIES = 12  # features for each bin that a share reaches: few, so they may move fast


def _spans(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    padded = np.zeros(len(flags) + 2, np.int8)
    padded[1:-1] = flags
    edge = np.flatnonzero(np.diff(padded))
    return edge[::2], edge[1::2]


def features(text, bits: int = BITS) -> np.ndarray:
    """Sorted distinct feature numbers of a text."""
    data = to_bytes(text)
    lowered = _LOWER[data]
    letters = _LETTER[data]
    starts, ends = _spans(letters)
    found = [_ALWAYS]
    shares = np.zeros(4)
    if len(starts):
        sums, back = prefix_hash(lowered), powers(len(data) + 1, "down")
        whole = mix((sums[ends] - sums[starts]) * back[starts])
        found.append(whole)
        for n in (4, 5, 6):
            long = ends - starts >= n
            at = starts[long]
            found.append(mix((sums[at + n] - sums[at]) * back[at] + np.uint64(n)))
        shares[1] = np.mean(np.add.reduceat(_UPPER[data], starts) >= np.maximum(2, (ends - starts) * 0.6))
        shares[2] = np.mean(whole[1:] == whole[:-1]) if len(whole) > 1 else 0.0
        shares[3] = 1 - len(np.unique(whole)) / len(whole)
        first, last = word_bounds(data)
        tail = _spans(~letters & ~np.isin(data, (0x20, 0x0A)))
        found.append(mix((sums[tail[1]] - sums[tail[0]]) * back[tail[0]] + np.uint64(7)))
        shares[0] = _SYMBOL[data].sum() / max(1, len(first))
    reached = np.flatnonzero((shares[:, None] >= _SHARE_BINS[None, :]).ravel())
    found.append(mix((reached[:, None] * _SHARE_COPIES + np.arange(_SHARE_COPIES)).ravel().astype(np.uint64) + np.uint64(1000)))
    return np.unique(np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int32)


@dataclass
class OrdinalModel:
    """Weights, ascending thresholds (one fewer than grades), and the grades' values."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray

    def score(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weights[r].sum() for r in rows], float)

    def tails(self, rows: list[np.ndarray]) -> np.ndarray:
        """P(grade >= grades[1:]) for each row."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - self.score(rows)[:, None], -40, 40)))


def fit(rows: list[np.ndarray], grade: np.ndarray, bits: int = BITS, epochs: int = EPOCHS,
        rate: float = 0.1, shrink: float = 1e-3, batch: int = 64, least: int = LEAST_ROWS) -> OrdinalModel | None:
    """Maximum likelihood by AdaGrad over shuffled batches (a fixed order: refits agree). Features of
    fewer than ``least`` rows get no weight: they would only tell those rows from others."""
    values, y = np.unique(grade, return_inverse=True)
    if len(values) < 2:
        return None
    k = len(values) - 1
    held = np.zeros(1 << bits, np.int64)
    for at in range(0, len(rows), 500):
        held += np.bincount(np.concatenate(rows[at : at + 500]), minlength=1 << bits)
    common = held >= min(least, 1 + len(rows) // 50)
    common[_ALWAYS >> np.uint64(64 - bits)] = True
    rows = [r[common[r]] for r in rows]
    above = np.clip(np.array([np.mean(y >= g) for g in range(1, k + 1)]), 1e-3, 1 - 1e-3)
    cuts = np.log((1 - above) / above)
    weights = np.zeros(1 << bits)
    seen, seen_cuts = np.full(1 << bits, 1e-2), np.full(k, 1e-2)
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), batch):
            take = order[at : at + batch]
            lens = np.array([len(rows[i]) for i in take])
            index = np.concatenate([rows[i] for i in take])
            score = np.add.reduceat(weights[index], np.concatenate([[0], np.cumsum(lens)[:-1]]))
            # P(y = g) = F(g) - F(g + 1) with F(0) = 1, F(k + 1) = 0 and F(g) = sigmoid(score - cut_g)
            tail = np.ones((len(take), k + 2))
            tail[:, 1:-1] = 1 / (1 + np.exp(np.clip(cuts[None, :] - score[:, None], -40, 40)))
            tail[:, -1] = 0
            slope = tail * (1 - tail)
            row, g = np.arange(len(take)), y[take]
            likely = np.maximum(tail[row, g] - tail[row, g + 1], 1e-9)
            by_score = (slope[row, g] - slope[row, g + 1]) / likely
            by_cut = np.zeros((len(take), k + 2))
            by_cut[row, g] -= slope[row, g] / likely
            by_cut[row, g + 1] += slope[row, g + 1] / likely
            touched, where = np.unique(index, return_inverse=True)
            step = np.bincount(where, np.repeat(by_score, lens)) / len(take) - shrink * weights[touched]
            seen[touched] += step**2
            weights[touched] += rate * step / np.sqrt(seen[touched])
            step = by_cut[:, 1:-1].sum(0) / len(take)
            seen_cuts += step**2
            cuts = np.maximum.accumulate(cuts + rate * step / np.sqrt(seen_cuts))
    return OrdinalModel(weights, cuts, values)


def fit_with_cut(rows: list[np.ndarray], grade: np.ndarray, bits: int = BITS, clean_loss: float = 0.002,
                 margin: float = 0.5, lowest: float = 0.2, highest: float = 0.9) -> tuple[OrdinalModel | None, float]:
    """A model and the tail probability from which a document is selected. A quarter of the sample is
    held out: the cut is below all but ``clean_loss`` of its top-grade documents, by ``margin`` in log
    odds (more if they are few, and the quantile rests on little), within [lowest, highest]."""
    held = np.arange(len(rows)) % 4 == 3
    model = fit([r for r, h in zip(rows, held, strict=True) if not h], grade[~held], bits)
    if model is None:
        return None, lowest
    top = np.flatnonzero(held & (grade == model.grades[-1]))
    if not len(top):
        return model, lowest
    tails = np.clip(np.sort(model.tails([rows[i] for i in top])[:, -1]), 1e-9, 1 - 1e-9)
    least = tails[int(clean_loss * len(tails))]
    odds = np.log(least / (1 - least)) - margin - min(1.0, 50 / len(top))
    return model, float(np.clip(1 / (1 + np.exp(-odds)), lowest, highest))


def training_rows(docs: DataFrame, ratings: DataFrame, grade: Column, id_col: str = "doc_id",
                  text_col: str = "text", max_rows: int = MAX_TRAINING_ROWS, bits: int = BITS):
    """Feature sets and grades of a bounded sample of the rated documents. The ratings are cut to
    ``max_rows`` ids before the join, so the side that is broadcast is bounded by the parameter."""
    rated = (ratings.select(F.col(id_col).alias("_id"), grade.cast("double").alias("_grade"))
             .where("_id is not null and _grade is not null")
             .groupBy("_id").agg(F.min("_grade").alias("_grade"))
             .orderBy(F.xxhash64("_id"), "_id").limit(max_rows))
    text = F.coalesce(F.col(text_col), F.lit(""))
    # one text an id (the one of least hash), whatever the number of rows that repeat it
    joined = (docs.select(F.col(id_col).alias("_id"), text.alias("_text")).join(F.broadcast(rated), "_id")
              .groupBy("_id", "_grade").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text")))
    kind = docs.schema[id_col].dataType.simpleString()

    def extract(batches):
        for b in batches:
            yield pd.DataFrame({"_id": b["_id"], "_grade": b["_grade"],
                                "_features": [features(t, bits).tobytes() for t in b["_text"]]})

    found = joined.mapInPandas(extract, f"_id {kind}, _grade double, _features binary").toPandas().sort_values("_id", kind="stable")
    order = np.random.default_rng(11).permutation(len(found))
    stored, grades = found["_features"].tolist(), found["_grade"].to_numpy(float)
    return [np.frombuffer(stored[i], "<i4") for i in order], grades[order]


def classify(docs: DataFrame, model: OrdinalModel | None, cut: float, text_col: str = "text",
             bits: int = BITS) -> DataFrame:
    """``docs`` with expected_grade, p_top and kept."""
    names = ["expected_grade", "p_top", "kept"]
    schema = T.StructType([f for f in docs.schema if f.name not in names]
                          + [T.StructField("expected_grade", T.DoubleType()),
                             T.StructField("p_top", T.DoubleType()), T.StructField("kept", T.BooleanType())])
    docs = docs.drop(*names)
    if model is None:
        return docs.select("*", F.lit(None).cast("double").alias("expected_grade"),
                           F.lit(None).cast("double").alias("p_top"), F.lit(True).alias("kept"))
    small = OrdinalModel(model.weights.astype(np.float32), model.thresholds, model.grades)
    shared = docs.sparkSession.sparkContext.broadcast(small)  # 2**bits floats, whatever the input

    def score(batches):
        m = shared.value
        for b in batches:
            tails = m.tails([features(t, bits) for t in b[text_col]]) if len(b) else np.zeros((0, len(m.thresholds)))
            b["expected_grade"] = m.grades[0] + tails @ np.diff(m.grades)
            b["p_top"] = tails[:, -1]
            b["kept"] = tails[:, -1] >= cut
            yield b

    return docs.mapInPandas(score, schema)


def quality_classifier(docs: DataFrame, ratings: DataFrame, grade: Column, id_col: str = "doc_id",
                       text_col: str = "text", max_rows: int = MAX_TRAINING_ROWS) -> DataFrame:
    """Fit on ``ratings`` (id, and columns from which ``grade`` is computed) and score every row of ``docs``."""
    rows, grades = training_rows(docs, ratings, grade, id_col, text_col, max_rows)
    model, cut = fit_with_cut(rows, grades)
    return classify(docs, model, cut, text_col)
