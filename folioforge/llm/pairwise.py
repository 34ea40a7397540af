"""Quality scores learned from preferences between documents (Bradley-Terry).

A document labelled good is preferred to one labelled poor. The chance of a preference is the
logistic function of the difference of two scores, and a score is linear in the features, so
the weights follow from a logistic regression on feature differences. Scores are then placed so
that 0.3 falls on the quantile of the training scores that the share of poor documents marks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioforge.llm.common import utf8

#: Labelled documents that the weights are learned from, the first by a hash of their id.
SAMPLE = 20_000
PAIRS = 200_000
#: Score at and above which a document is predicted to be good.
CUT = 0.3
_RIDGE = 1e-3
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_MARKS = np.frombuffer(b"!?;:()[]{}=_/\\", np.uint8)
N_FEATURES = 20


def features_of(text: bytes) -> list[float]:
    """What a text looks like, in 20 numbers; all are defined for an empty text."""
    n = max(1, len(text))
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256) / n
    words = text.split()
    many = max(1, len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    pairs = max(1, len(words) - 1)
    return [
        math.log1p(len(words)),
        math.log1p(len(text)),
        sum(map(len, words)) / many,
        len(set(words)) / many,
        len(set(zip(words, words[1:]))) / pairs,
        sum(a == b for a, b in zip(words, words[1:])) / pairs,
        float(counts[_SYMBOLS].sum()),
        float(counts[ord("|")]),
        float(counts[_MARKS].sum()),
        float(counts[ord("!")]),
        float(counts[48:58].sum()),
        float(counts[65:91].sum()),
        float(counts[128:].sum()),
        float(counts[ord(".")]),
        float(counts[ord(",")]),
        math.log1p(len(lines)),
        len(set(lines)) / max(1, len(lines)),
        max(map(len, words), default=0) / 100,
        sum(w[:1].isupper() for w in words) / many,
        len(words) / max(1, len(lines)) / 100,
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _features(texts: pd.Series) -> pd.Series:
    return pd.Series([features_of(t) for t in utf8(texts)], dtype=object)


@dataclass
class Model:
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    spread: float

    def raw(self, features: np.ndarray) -> np.ndarray:
        return _terms(features, self.centre, self.scale) @ self.weights

    def score(self, features: np.ndarray) -> np.ndarray:
        """0 to 1, rising with the raw score; `CUT` at the quantile."""
        z = (self.raw(features) - self.cut) / self.spread + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _terms(features: np.ndarray, centre: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standard features, and their squares."""
    z = np.clip((features - centre) / scale, -6, 6)
    return np.concatenate([z, z * z / 6], axis=1)


def fit(features: np.ndarray, good: np.ndarray, pairs: int = PAIRS, rounds: int = 25) -> Model:
    """Weights by Newton steps on the logistic loss of `pairs` preferences, drawn with a fixed seed.

    With no good or no poor document nothing is learned and every score is the same.
    """
    centre = features.mean(axis=0) if len(features) else np.zeros(N_FEATURES)
    scale = features.std(axis=0) + 1e-9 if len(features) else np.ones(N_FEATURES)
    best, poor = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(best) or not len(poor):
        level = 1.0 if len(best) else -1.0
        return Model(centre, scale, np.zeros(2 * N_FEATURES), -level, 1.0)
    terms = _terms(features, centre, scale)
    draw = np.random.default_rng(11)
    differences = terms[draw.choice(best, pairs)] - terms[draw.choice(poor, pairs)]
    weights = np.zeros(terms.shape[1])
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(differences @ weights, -30, 30)))
        slope = differences.T @ (1 - chance) / pairs - _RIDGE * weights
        curve = (differences * (chance * (1 - chance))[:, None]).T @ differences / pairs
        step = np.linalg.solve(curve + _RIDGE * np.eye(len(weights)), slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    raw = terms @ weights
    cut = float(np.quantile(raw, len(poor) / len(raw)))
    return Model(centre, scale, weights, cut, float(raw.std()) / 4 + 1e-9)


def held_out(id_column: Column) -> Column:
    """Rows whose labels are not learned from: crc32 of the id as text is divisible by 5; a null id is one."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """From at most `sample` labelled documents that are not held out. Labels other than 0 and 1 are left out,
    and so are ids that have both."""
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "quality")
    both = F.min("quality").alias("quality"), F.max("quality").alias("most")
    known = known.groupBy("doc_id").agg(*both).where("quality = most").drop("most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # at most `sample` pairs of numbers
    texts = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = texts.select("quality", _features(F.coalesce("text", F.lit("")).cast("binary")).alias("f"), "doc_id")
    got = rows.orderBy("doc_id", F.xxhash64("f")).limit(sample).toPandas()
    features = np.array(got["f"].tolist(), float).reshape(-1, N_FEATURES)
    return fit(features, (got["quality"] == 1).to_numpy(bool))


def quality_scores(docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, score, predicted. A null text counts as empty.

    Only the text enters a score; whole texts are read, repeated rows each.
    """

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.array([features_of(t) for t in utf8(texts)], float)))

    text = F.coalesce("text", F.lit("")).cast("binary")
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))
