"""Documents that every operator must take: nulls, empty and long texts, repeated rows, clashing columns."""

from pyspark.sql import DataFrame, SparkSession

LONG = "the quick brown fox jumps over the lazy dog and " * 4000
ROWS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "All rights reserved, a b c d e f"),
    (6, "All rights reserved, a b c d e f"), (6, "All rights reserved, a b c d e f"), (None, "nobody's text"), (None, None),
    (7, LONG), (8, "Ünïcode ☃ текст 日本語 ​ x"), (9, "a b  c"),
]
SCHEMA = "doc_id long, text string, score double, hash string, `key` string, kind int, word string, `range` int, length int, `print` string"


def documents(spark: SparkSession, rows=None) -> DataFrame:
    """A table whose other columns bear names that operators use."""
    rows = ROWS if rows is None else rows
    return spark.createDataFrame([(i, t, 0.5, "h", "k", 1, "w", 2, 3, "p") for i, t in rows], SCHEMA).repartition(3)


def by_id(df: DataFrame) -> list:
    return sorted((tuple(r) for r in df.collect()), key=repr)
