"""License scans by diagonal voting, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import col

GRAM = 2  # words of a rolling k-gram
NEIGHBORS = 2  # diagonals this far apart belong to one occurrence: words put in or left out
MIN_COVERAGE = 0.75  # share of a template's k-grams that an occurrence needs

# Phrases that are looked for, and the labels they give.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "creative commons attribution 4 0 international license": "cc-by-4.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3.0",
    "this program is free software you can redistribute it and or modify it": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license version 2 0": "epl-2.0",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "permission to use copy modify and distribute this software for any purpose with or without fee": "isc",
    "this is free and unencumbered software released into the public domain": "unlicense",
}

# ASCII signs between words; words are ASCII letters and digits and all other characters.
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Words of a text with A-Z lower-cased; none for a null."""
    text = F.coalesce(text, F.lit(""))
    # Two letters outside ASCII have an ASCII lower case; a text with one of them goes letter by letter.
    lowered = F.when(text.rlike("[İK]"), F.translate(text, _UPPER, _LOWER)).otherwise(F.lower(text))
    return F.filter(F.split(lowered, _BETWEEN), lambda w: w != "")


def template_grams(spark: SparkSession, templates: dict[str, str], base: dict[str, str], gram: int) -> DataFrame:
    """(hash, words, template, place, size, label, is_base) of each k-gram of each template."""
    rows = []
    for number, (phrase, label) in enumerate([*base.items(), *templates.items()]):
        words = phrase.split()
        grams = [words[i : i + gram] for i in range(len(words) - gram + 1)]
        if not 0 < len(grams) < 64:
            raise ValueError(f"a template needs 1 to 63 k-grams: {phrase}")
        rows += [(g, number, place, len(grams), label, number < len(base)) for place, g in enumerate(grams)]
    known = spark.createDataFrame(rows, "t_words array<string>, template int, place int, size int, label string, is_base boolean")
    return known.withColumn("hash", F.xxhash64(*[F.get("t_words", i) for i in range(gram)]))


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    base: dict[str, str] = BASE_PHRASES,
    gram: int = GRAM,
    neighbors: int = NEIGHBORS,
    min_coverage: float = MIN_COVERAGE,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Find license phrases and texts in each document.

    All rolling k-grams of the words are hashed and joined with the template
    places of the same hash (a table of fixed size, broadcast); the words are
    compared, so a hash collision gives no match.  Matches vote for the diagonal
    word place - template place.  Neighbouring diagonals of a template are
    merged, and an occurrence counts if it covers ``min_coverage`` of the
    template's k-grams (all of a base phrase or of up to two k-grams) within a
    span not longer than the template by more than the words put in.  Where
    repeated k-grams chain diagonals to a longer span, the diagonals that reach
    the coverage alone, or with those close by, count by themselves.

    Returns per row: id, ``n_words``, ``n_base`` (places of base phrases),
    ``first_word`` and ``last_word`` (their least and greatest starts, else
    null), ``base_labels``, ``labels`` (distinct, sorted, comma-joined),
    ``score`` (the best coverage of any template, 0 to 1) and ``spans`` (label,
    first and last word, coverage of each occurrence).  Null and empty texts
    have no words.  Repeated rows give repeated rows; other columns are not read.
    """
    known = template_grams(docs.sparkSession, templates, base, gram)
    # every document also meets a sentinel template once, which carries its counts
    sentinel = "0L"
    marks = F.broadcast(
        known.unionByName(docs.sparkSession.range(1).select(F.expr(sentinel).alias("hash")), allowMissingColumns=True)
    )
    key = [col("key_id"), col("key_text")]
    rows = docs.select(
        col(id_column).alias("key_id"), F.xxhash64(text_column).alias("key_text"), words_of(col(text_column)).alias("words")
    )
    last = F.greatest(F.size("words") - gram, F.lit(-1))
    # the outer form, since for the inner one the planner would split the text once more in a filter
    rolled = rows.select("*", F.explode_outer(F.sequence(F.lit(-1), last)).alias("at"))
    hashed = F.xxhash64(*[F.get("words", col("at") + i) for i in range(gram)])
    rolled = rolled.withColumn("hash", F.when(col("at") < 0, F.expr(sentinel)).otherwise(hashed))
    is_same = F.when(col("at") < 0, col("template").isNull()).otherwise(
        F.slice("words", F.greatest(col("at") + 1, F.lit(1)), gram) == col("t_words")
    )
    votes = rolled.join(marks, "hash").where(is_same)
    votes = votes.select(
        *key, "template", "size", "label", "is_base", "at", (col("at") - col("place")).alias("diagonal"),
        F.expr("shiftleft(1L, place)").alias("bit"), F.when(col("at") < 0, F.size("words")).alias("n_words"),
    )
    diagonals = votes.groupBy(*key, "template", "size", "label", "is_base", "diagonal").agg(
        F.bit_or("bit").alias("bits"), F.min("at").alias("first"), F.max("at").alias("last"),
        F.max("n_words").alias("n_words"), F.count(F.lit(1)).alias("votes"),
    )
    # a base phrase stands at one place: its diagonals are not merged
    along = Window.partitionBy(*key, "template").orderBy("diagonal")
    apart = F.coalesce((col("diagonal") - F.lag("diagonal").over(along) > neighbors) | col("is_base"), F.lit(True))
    # a chain may run on through repeated k-grams: occurrences within it are what stands on diagonals close together
    ahead = Window.partitionBy(*key, "template").orderBy("diagonal").rangeBetween(0, 2 * neighbors)
    near = lambda own, seen: F.when(col("is_base"), col(own)).otherwise(seen.over(ahead))
    least = F.when(col("is_base") | (col("size") <= 2), 1.0).otherwise(min_coverage)
    own_coverage, near_coverage = F.bit_count("bits") / col("size"), F.bit_count("near_bits") / col("size")
    place = lambda alone, first, last, share: F.struct(
        "diagonal", F.lit(alone).alias("alone"), F.col(first).alias("first"), F.col(last).alias("last"), share.alias("coverage")
    )
    diagonals = diagonals.select(
        "*", near("bits", F.bit_or("bits")).alias("near_bits"), near("first", F.min("first")).alias("near_first"),
        near("last", F.max("last")).alias("near_last"),
    )
    candidate = F.when(own_coverage >= least, place(True, "first", "last", own_coverage)).when(
        near_coverage >= least, place(False, "near_first", "near_last", near_coverage)
    )
    diagonals = diagonals.select("*", candidate.alias("candidate"))
    merged = diagonals.withColumn("apart", apart).withColumn("group", F.sum(col("apart").cast("int")).over(along))
    merged = merged.groupBy(*key, "template", "size", "label", "is_base", "group").agg(
        F.bit_or("bits").alias("bits"), F.min("first").alias("first"), F.max("last").alias("last"),
        F.max("n_words").alias("n_words"), F.max("votes").alias("votes"),
        F.array_sort(F.collect_list("candidate")).alias("candidates"),
    )
    coverage = F.bit_count("bits") / col("size")
    fits = (col("last") - col("first") + 1 <= col("size") + 2 * neighbors) & (coverage >= least)
    span = lambda first, last, share: F.struct(
        "label", first.alias("first"), (last + gram - 1).alias("last"), share.alias("coverage")
    )
    # within a chain too long, a diagonal that reaches the coverage alone counts; others, if none of these or taken before is near
    alone = F.filter("candidates", lambda c: c["alone"])
    shared = F.filter(
        "candidates", lambda c: ~c["alone"] & ~F.exists(alone, lambda a: F.abs(a["diagonal"] - c["diagonal"]) <= 2 * neighbors)
    )

    def take(taken: Column, c: Column) -> Column:
        apart = (F.size(taken) == 0) | (c["diagonal"] - F.element_at(taken, F.greatest(F.size(taken), F.lit(1)))["diagonal"] > 2 * neighbors)
        return F.when(apart, F.concat(taken, F.array(c))).otherwise(taken)

    chosen = F.concat(alone, F.aggregate(shared, F.slice("candidates", 1, 0), take))
    within = F.transform(chosen, lambda c: span(c["first"], c["last"], c["coverage"]))
    occurrences = F.when(fits, F.array(span(col("first"), col("last"), coverage))).when(col("template").isNotNull(), within)
    found = merged.select("*", coverage.alias("coverage"), (fits & col("is_base")).alias("base"), occurrences.alias("occurrences"))
    found = found.withColumn("fits", F.coalesce(F.size("occurrences") > 0, F.lit(False)))
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    by_document = found.groupBy(*key).agg(
        F.max("n_words").cast("long").alias("n_words"),
        F.count_if("base").alias("n_base"),
        F.min(F.when(col("base"), col("first"))).cast("long").alias("first_word"),
        F.max(F.when(col("base"), col("first"))).cast("long").alias("last_word"),
        joined(F.when(col("base"), col("label"))).alias("base_labels"),
        joined(F.when(col("fits"), col("label"))).alias("labels"),
        F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
        F.array_sort(F.flatten(F.collect_list("occurrences"))).alias("spans"),
        # the votes of the sentinel are the repeated rows
        F.max(F.when(col("template").isNull(), col("votes"))).alias("copies"),
    )
    again = by_document.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    return again.select(col("key_id").alias(id_column), *names)
