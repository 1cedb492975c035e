"""Rows that operators must take: nulls, empty and long texts, repeats, names that clash."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "n_words long, host string, kept string, print long, t string, d string, tokens string, rate string, "
    "number string, place string, component string, base string, spans string, m string, label string"
)
LONG = " ".join(f"Word{i % 977} mail{i}@long.example.org" if i % 500 == 0 else f"w{i * 7919 % 5003}" for i in range(40_000))
PLAIN = " ".join(f"alpha{i} beta{i % 7} gamma" for i in range(60))
EDGE = [
    (None, "A text without an id. " * 9, "en", "a"),
    (None, "A text without an id. " * 9, "en", "a"),
    (1, None, "en", "a"),
    (2, "", None, "a"),
    (2, "", None, "a"),
    (3, LONG, "de", None),
    (4, PLAIN, "en", "b"),
    (5, PLAIN, "en", "b"),
    (5, PLAIN, "en", "b"),
    (6, " \n\t ", "en", "b"),
    (7, "é" * 50_000, "fr", "c"),
    (8, "one two", "fr", "c"),
    (9, PLAIN + " Delta", "fr", "c"),
    (10, "\x1c\x85　 ß İ Σς <|endoftext|> 😀", "xx", "c"),
]


def edge_docs(spark: SparkSession) -> DataFrame:
    rows = [(*r, None if r[1] is None else len(r[1]), *([None] * 15)) for r in EDGE]
    return spark.createDataFrame(rows, SCHEMA)


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def labels(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, text string, words string")
