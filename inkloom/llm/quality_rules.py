"""Quality rules: counts, and divergence of a document's distributions from language references."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, col

SYMBOLS = "#*$%&|<>"
COMMON_WORDS = 60  # of a language's reference
# upper, lower, white space, digit, symbol, stop or comma, other ASCII sign, other letter or mark, everything else
CLASSES = 9
_TABLED = 0x3000  # code points with a class of their own; those beyond count as other letters


def _class_of(code: int) -> int:
    c = chr(code)
    if c.isspace():
        return 2
    if c.isupper():
        return 0
    if c.islower():
        return 1
    if c.isdigit():
        return 3
    if c.isalpha():
        return 7
    if c in ".,":
        return 5
    if code < 128:
        return 4 if c in SYMBOLS + "=+^~@\\_{}[]" else 6
    return 8


_CLASS = np.array([_class_of(code) for code in range(_TABLED)] + [7], np.uint8)


def character_classes(text: str) -> np.ndarray:
    """Number of characters of each class."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.bincount(_CLASS[np.minimum(codes, _TABLED)], minlength=CLASSES)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text."""
    words = text.encode("utf-8", "surrogatepass").split()
    blanks = sum(map(text.count, " \t\n\v\f\r"))
    seen: set[str] = set()
    repeated_lines = 0
    for line in text.split("\n"):
        if line.strip(" \t\v\f\r"):
            repeated_lines += line in seen
            seen.add(line)
    covered = 0
    if len(words) > 3:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
        pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
        windows, counts = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)[1:]
        again = counts[windows] > 1
        mark = np.zeros(len(words), bool)
        for shift in range(3):
            mark[shift : shift + len(again)] |= again
        covered = int(mark.sum())
    return len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), repeated_lines, covered


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms of some count each."""
    p, q = p / p.sum(), q / q.sum()
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / middle), 0.0).sum() for x in (p, q)]
    return math.sqrt(max(0.0, sum(parts) / 2))


@dataclass
class References:
    """Per language: character-class counts, its common words, their counts and that of all others."""

    classes: dict[str, list[float]]
    words: dict[str, list[str]]
    counts: dict[str, list[float]]


@dataclass
class DivergenceRules:
    """Limits of the distance to the nearest language.

    Short texts scatter around their language, so the limits fall with the
    length, and texts below the minimum lengths are not judged by them.
    """

    class_limit: float = 0.18
    class_scatter: float = 2.5  # over the root of the characters
    word_limit: float = 0.25
    word_scatter: float = 1.9  # over the root of the words
    min_chars: int = 200
    min_words: int = 50


def language_references(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", common: int = COMMON_WORDS
) -> References:
    """References from all texts of each language; a null language is one of its own.

    Counts are partial aggregates over the whole table; what reaches the driver
    is ``common`` words and ``CLASSES`` numbers for each language, without a
    limit of languages.  Languages without any word are left out.
    """

    @arrow_udf("array<long>")
    def classes(texts: pa.Array) -> pa.Array:
        return pa.array([character_classes(t.as_py() or "") for t in texts], pa.list_(pa.int64()))

    rows = docs.select(F.coalesce(col(lang_column).cast("string"), F.lit("")).alias("lang"), col(text_column).alias("text"))
    sums = [F.sum(F.get("n", i)).alias(f"n{i}") for i in range(CLASSES)]
    totals = rows.select("lang", classes("text").alias("n")).groupBy("lang").agg(*sums)
    kept = {r["lang"]: [r[f"n{i}"] for i in range(CLASSES)] for r in totals.collect()}
    words = rows.select(
        "lang", F.explode_outer(F.split(F.lower("text"), r"[\x20\x09-\x0D]+")).alias("word")
    )
    counted = words.where("word <> ''").groupBy("lang", "word").count()
    best = Window.partitionBy("lang").orderBy(F.desc("count"), "word")
    frequent = counted.withColumn("place", F.row_number().over(best)).where(col("place") <= common)
    every = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("count").alias("n")).collect()}
    found = References({}, {}, {})
    for r in frequent.orderBy("lang", "place").collect():
        found.words.setdefault(r["lang"], []).append(r["word"])
        found.counts.setdefault(r["lang"], []).append(float(r["count"]))
    for lang, counts in found.counts.items():
        found.classes[lang] = [float(n) for n in kept[lang]]
        counts.append(every[lang] - sum(counts))
    return found


def divergence(text: str, references: References) -> tuple[float, float]:
    """Least distance of the text's character classes, and of its common words, to any reference; 0 without words."""
    words = text.lower().encode("utf-8", "surrogatepass").split()
    if not words or not references.words:
        return 0.0, 0.0
    classes, counts = character_classes(text), Counter(words)
    near_class = min(jensen_shannon(classes, np.array(r)) for r in references.classes.values())
    near_word = 1.0
    for lang, common in references.words.items():
        own = [counts[w.encode("utf-8", "surrogatepass")] for w in common]
        near_word = min(near_word, jensen_shannon(np.array([*own, len(words) - sum(own)], float), np.array(references.counts[lang])))
    return near_class, near_word


def apply_rules(text: Column, references: References, rules: DivergenceRules | None = None) -> Column:
    """Struct of the base counts, ``base_failed``, ``class_distance``, ``word_distance`` and ``kept``.

    Null and empty texts have no words and fail the base rules.
    """
    rules = rules or DivergenceRules()
    fields = [(n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    fields += [("base_failed", pa.bool_()), ("class_distance", pa.float64()), ("word_distance", pa.float64()), ("kept", pa.bool_())]

    def judge(text: str) -> tuple:
        counts = base_counts(text)
        n_words, repeated = counts[0], counts[4]
        failed = n_words < 50 or 100 * repeated > 50 * n_words
        near_class, near_word = divergence(text, references)
        far = len(text) >= rules.min_chars and near_class > rules.class_limit + rules.class_scatter / math.sqrt(len(text))
        far |= n_words >= rules.min_words and near_word > rules.word_limit + rules.word_scatter / math.sqrt(n_words)
        return *counts, failed, near_class, near_word, not failed and not far

    @arrow_udf(
        "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long, "
        "base_failed: boolean, class_distance: double, word_distance: double, kept: boolean>"
    )
    def quality_rules(texts: pa.Array) -> pa.Array:
        rows = [judge(t.as_py() or "") for t in texts]
        return pa.StructArray.from_arrays([pa.array([r[i] for r in rows], k) for i, (_, k) in enumerate(fields)], [n for n, _ in fields])

    return quality_rules(text)
