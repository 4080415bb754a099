"""Toxicity by a weighted lexicon: folded text, Aho-Corasick, length-normalised score."""

from __future__ import annotations

import json
import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from inkloom.llm.tables import labelled_sample, written

# Letters of other scripts that look like Latin ones, and signs written for letters.
HOMOGLYPHS = str.maketrans("авекмнорстухіјѕԁһԛԝ" + "αβεικνορτυχω" + "ıɑɡ", "abekmhopctyxijsdhqw" + "abeikvoptuxw" + "iag")
SIGNS = str.maketrans("0134578@$!|", "oieastbasil")
_SIGN = re.compile(r"[0134578@$!|]")
_OTHER_SCRIPT = re.compile("[ıɑɡͰ-ԯ]")
_SIGN_IN_WORD = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])|(?<![^\s(\"'])[0134578@$]+(?=[^\W\d_])|(?<=[^\W\d_])[0134578@$]+(?![^\s.,;:?!)\"'])")
_WORD = re.compile(r"[^\W\d_]+")

# Phrases in which a listed word is meant otherwise.
EXCEPTIONS = (
    "trash can", "trash bin", "idiot proof", "class clown", "clown fish", "pond scum", "white trash bag", "sore loser rule",
)


def fold(text: str | None) -> str:
    """Lower case, compatibility forms and marks folded, look-alike letters and signs inside words undone."""
    text = (text or "").lower()
    if not text.isascii():
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()
        if _OTHER_SCRIPT.search(text):
            text = text.translate(HOMOGLYPHS)
    if _SIGN.search(text):
        text = _SIGN_IN_WORD.sub(lambda m: m[0].translate(SIGNS), text)
    return text


@dataclass
class ToxicityModel:
    """Lexicon and calibration.  A term ending in ``*`` stands for all words that begin so."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    slope: float = 1.0
    offset: float = -3.0


class _Matcher:
    def __init__(self, model: ToxicityModel):
        self.model, self.words = model, ahocorasick.Automaton()
        found: dict[str, list[tuple[str, int, float]]] = {}  # a word, its beginning and a phrase may be the same letters
        for phrase in model.exceptions:
            found.setdefault(phrase, []).append(("", len(phrase), 0.0))
        for term, weight in model.weights.items():
            stem = term.removesuffix("*")
            found.setdefault(stem, []).append(("*" if term != stem else "word", len(stem), weight))
        for stem, kinds in found.items():
            self.words.add_word(stem, kinds)
        if len(self.words):
            self.words.make_automaton()

    def raw(self, text: str | None) -> float:
        """Weight found in the text over the logarithm of its length in words."""
        text = fold(text)
        if not len(self.words) or not text:
            return 0.0
        hits, spared = [], []
        for end, kind, size, weight in ((end, *k) for end, kinds in self.words.iter(text) for k in kinds):
            begin = end - size + 1
            if begin and text[begin - 1].isalpha():
                continue
            if kind != "*" and end + 1 < len(text) and text[end + 1].isalpha():
                continue
            (hits if kind else spared).append((begin, end, weight))
        # whether a span lies in one of those that begin before it: the furthest of their ends tells
        spared.sort()
        begins, ends = [a for a, _, _ in spared], list(accumulate((b for _, b, _ in spared), max))
        best: dict[int, float] = {}  # a word counts once, by its heaviest term
        for begin, end, weight in hits:
            place = bisect_right(begins, begin)
            if not place or ends[place - 1] < end:
                best[begin] = max(best.get(begin, 0.0), weight)
        return sum(best.values()) / math.log2(2 + len(_WORD.findall(text))) if best else 0.0

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.model.slope * self.raw(text) + self.model.offset))))


def toxicity_score(text: Column, spark: SparkSession, model: ToxicityModel) -> Column:
    """Score from 0 to 1 of a text; null and empty texts get that of a text without matches.

    The model is broadcast: its lexicon is bounded by the support that ``fit_toxicity`` asks for.
    A text is scored in time linear in its length, but for sorting its exception phrases.
    """
    shared, made = spark.sparkContext.broadcast(json.dumps(asdict(model))), []

    @arrow_udf("double")
    def toxicity(texts: pa.Array) -> pa.Array:
        if not made:
            made.append(_Matcher(ToxicityModel(**json.loads(shared.value))))
        return pa.array([made[0].score(t.as_py()) for t in texts], pa.float64())

    return toxicity(text)


def _support(texts: DataFrame, wanted: Broadcast | None = None) -> DataFrame:
    """(term, n): words of the texts and their beginnings, and the number of texts that hold them."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):  # bounds what a text's many terms take
                found: Counter[str] = Counter()
                for text in batch.column(0).slice(at, 64).to_pylist():
                    words = set(_WORD.findall(fold(text)))
                    own = words | {word[:n] + "*" for word in words for n in (4, 5, 6) if len(word) > n}
                    found.update(own if wanted is None else own & wanted.value)
                columns = [pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["term", "n"])

    return texts.select("text").mapInArrow(terms, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def _near_key(texts: Column) -> Column:
    """Least hash of a text's runs of three words: copies with a few other words mostly share it, other texts do not."""

    def least(text: str | None) -> int:
        words = (text or "").lower().split()
        runs = zip(words, words[1:], words[2:], strict=False) if len(words) > 2 else [words]
        return min(xxhash.xxh64_intdigest(" ".join(run)) for run in runs) >> 1

    @arrow_udf("long")
    def key(texts: pa.Array) -> pa.Array:
        return pa.array([least(t.as_py()) for t in texts], pa.int64())

    return key(texts)


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "toxic",
    id_column: str = "doc_id",
    text_column: str = "text",
    max_rows: int = 40_000,
    min_support: int = 3,
    min_share: float = 0.01,
    min_odds: float = 2.5,
    exceptions: tuple[str, ...] = EXCEPTIONS,
) -> ToxicityModel:
    """Learn term weights and the calibration from labelled texts (label 1: toxic).

    At most ``max_rows`` labelled rows are used (see ``labelled_sample``).  Equal
    texts count once, and so do copies that share their least hash (``_near_key``): words
    that a copied text repeats are no evidence.  A term weighs its log odds
    between toxic and other texts.  It needs ``min_support`` toxic texts, a share
    of ``min_share`` of them, log odds of ``min_odds``, and toxic texts in both halves of
    the sample, dealt by hash, and to be commoner there in each.  No number of terms is
    cut: those of that share are at most 1 / ``min_share`` times the mean number
    of terms in a toxic text.
    Rows with a null label are left out, texts without words support nothing;
    without toxic rows the lexicon is empty.
    """
    spark = docs.sparkSession
    rows = labelled_sample(docs, labels, label_column, id_column, text_column, max_rows)
    rows = written(rows.select("text", F.col("label").alias("toxic"), _near_key(F.col("text")).alias("near")), "toxicity-sample")
    one = rows.groupBy("near").agg(F.max("toxic").alias("toxic"), F.min_by("text", F.struct(-F.col("toxic"), F.xxhash64("text"))).alias("text"))
    one = written(one.withColumn("half", F.pmod(F.xxhash64("near"), F.lit(2))), "toxicity-texts")
    sizes = {(r["toxic"], r["half"]): r["count"] for r in one.groupBy("toxic", "half").count().collect()}
    bad, good = (sum(n for (toxic, _), n in sizes.items() if toxic == label) for label in (1, 0))
    if not bad:
        return ToxicityModel({}, exceptions)
    least = max(min_support, math.ceil(min_share * bad))
    in_bad = {r["term"]: r["n"] for r in _support(one.where("toxic = 1")).where(F.col("n") >= least).collect()}
    wanted = spark.sparkContext.broadcast(frozenset(in_bad))
    # others are only asked for the terms that toxic texts support
    found = {
        (toxic, half): {r["term"]: r["n"] for r in _support(one.where(f"toxic = {toxic} and half = {half}"), wanted).collect()}
        for toxic in (0, 1) for half in (0, 1)
    }
    wanted.unpersist()

    def odds(term: str, halves: tuple[int, ...]) -> float:
        share = [
            (sum(found[toxic, h].get(term, 0) for h in halves) + 0.5) / (sum(sizes.get((toxic, h), 0) for h in halves) + 1) for toxic in (0, 1)
        ]
        return math.log(share[1]) - math.log(share[0])

    weights = {}
    for term, n in in_bad.items():
        both = odds(term, (0, 1))
        if both >= min_odds and all(found[1, h].get(term) and odds(term, (h,)) > 0 for h in (0, 1)):
            weights[term] = both * min(1.0, math.log2(n + 1) / 5)  # the evidence grows with the support too
    model = ToxicityModel(dict(sorted(weights.items())), exceptions)
    raw = toxicity_score(F.col("text"), spark, ToxicityModel(model.weights, exceptions, 1.0, 0.0))
    points = rows.select("toxic", raw.alias("score")).toPandas()  # two numbers a sampled row
    model.slope, model.offset = _calibrate(points["score"].to_numpy(), points["toxic"].to_numpy())
    return model


def _calibrate(scores: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve over the raw score, by ridge-penalised Newton steps."""
    raw = np.log(scores / np.maximum(1 - scores, 1e-13))
    design = np.column_stack([raw, np.ones(len(raw))])
    weights = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (p - labels) + 0.01 * weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(curve, gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return float(max(weights[0], 1e-6)), float(weights[1])
