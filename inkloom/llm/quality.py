"""Quality classifier: Bradley-Terry ranking from preference pairs."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from inkloom.llm.tables import labelled_sample, written

_SIGNS = re.compile(r"[#*$%&|<>!=_~^{}\[\]\\]")
_UPPER = re.compile(r"[^\W\d_a-zß-öø-ÿ]")
FEATURES = (
    "log_words", "sign_share", "upper_share", "digit_share", "distinct_words", "word_length", "pipes_per_word",
    "repeated_neighbors", "repeated_windows", "repeated_lines", "longest_word", "top_word_share",
)


def features(text: str | None) -> list[float]:
    """Shape of a text, each number bounded; a null or empty text gives zeros."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), len(text)
    letters = sum(map(len, words))
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        math.log1p(n) / 10,
        min(1.0, 5 * len(_SIGNS.findall(text)) / chars),
        min(1.0, 2 * len(_UPPER.findall(text)) / chars) if text != text.lower() else 0.0,
        min(1.0, 5 * sum(map(text.count, "0123456789")) / chars),
        len(set(words)) / n,
        min(1.0, letters / n / 20),
        min(1.0, 3 * text.count("|") / n),
        min(1.0, 5 * sum(a == b for a, b in zip(words, words[1:], strict=False)) / n),
        1 - len(windows) / max(1, n - 2) if n > 2 else 0.0,
        1 - len(set(lines)) / len(lines),
        min(1.0, max(map(len, words)) / 100),
        Counter(words).most_common(1)[0][1] / n,
    ]


@dataclass
class QualityModel:
    """Weights over standardised features, and the score that separates kept from rejected texts."""

    mean: list[float]
    scale: list[float]
    weights: list[float]
    threshold: float = 0.0

    def utility(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -6, 6)
        return z @ np.array(self.weights)


def _bradley_terry(better: np.ndarray, worse: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Weights w that maximise the likelihood of ``better`` winning, P = 1 / (1 + exp(-w (better - worse)))."""
    apart = better - worse
    w = np.zeros(apart.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(apart @ w, -30, 30)))
        gradient = apart.T @ (p - 1) + ridge * w
        curve = (apart * (p * (1 - p))[:, None]).T @ apart + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def feature_column(text: Column) -> Column:
    """The features of a text as an array."""

    @arrow_udf("array<double>")
    def shape(texts: pa.Array) -> pa.Array:
        return pa.array([features(t.as_py()) for t in texts], pa.list_(pa.float64()))

    return shape(text)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    max_rows: int = 30_000,
    rivals: int = 3,
) -> QualityModel:
    """Learn document scores from preference pairs of labelled texts (1 is preferred to 0).

    At most ``max_rows`` labelled rows are used (see ``labelled_sample``).  Each
    text meets ``rivals`` texts of the other label, taken from a fixed shuffle,
    at least.
    The threshold is the score quantile at the rejected share of the sample.
    Rows with a null label are left out.  With one label only nothing is
    preferred: all scores are equal and at the threshold or above it, or below
    it if all labels are 0.
    """
    rows = labelled_sample(docs, labels, label_column, id_column, text_column, max_rows)
    rows = written(rows.select("label", F.xxhash64("text").alias("order"), feature_column(F.col("text")).alias("x")), "quality-sample")
    sample = rows.orderBy("order").toPandas()
    if not len(sample):
        return QualityModel([0.0] * len(FEATURES), [1.0] * len(FEATURES), [0.0] * len(FEATURES))
    x, label = np.stack(sample["x"].to_numpy()), sample["label"].to_numpy()
    model = QualityModel(x.mean(axis=0).tolist(), (x.std(axis=0) + 1e-3).tolist(), [0.0] * x.shape[1])
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        model.threshold = 0.0 if len(good) else 1.0
        return model
    z = np.clip((x - model.mean) / model.scale, -6, 6)
    pairs = rivals * max(len(good), len(bad))
    dice = np.random.default_rng(7)
    wins = np.concatenate([dice.permutation(good) for _ in range(-(-pairs // len(good)))])[:pairs]
    losses = np.concatenate([dice.permutation(bad) for _ in range(-(-pairs // len(bad)))])[:pairs]
    model.weights = _bradley_terry(z[wins], z[losses]).tolist()
    scores = np.sort(model.utility(x))
    # between the last rejected and the first kept score
    cut = len(bad)
    model.threshold = float((scores[cut - 1] + scores[min(cut, len(scores) - 1)]) / 2)
    return model


def quality_score(text: Column, model: QualityModel, at_threshold: float = 0.7) -> Column:
    """Score from 0 to 1 of a text: ``at_threshold`` or more where its utility reaches the model's threshold."""
    shift = math.log(at_threshold / (1 - at_threshold))

    @arrow_udf("double")
    def quality(texts: pa.Array) -> pa.Array:
        rows = np.array([features(t.as_py()) for t in texts], dtype=float).reshape(-1, len(FEATURES))
        return pa.array(1 / (1 + np.exp(-np.clip(model.utility(rows) - model.threshold, -30, 30) - shift)), pa.float64())

    return quality(text)
