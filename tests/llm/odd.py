"""Rows that every operator must stand: nulls, empty and very long texts, repeats, clashing columns."""

from pyspark.sql import functions as F

LONG = "lorem ipsum dolor sit amet " * 3000 + "\n" + "x" * 20000
TEXTS = [
    (1, "The first text, with words.\nAnd a second line of it.", "en", "a"),
    (1, "The first text, with words.\nAnd a second line of it.", "en", "a"),
    (2, "", "en", "a"),
    (3, None, None, None),
    (4, LONG, "en", "b"),
    (None, "a row without an id", None, "b"),
    (5, "   \n\n\t ", "de", None),
    (6, "Größe 東京 ελ \U0001f600 naïve", "de", "c"),
    (7, "tie", "en", "c"),
    (8, "tie", None, "c"),
    (9, "\u0000\u0001 |r <|endoftext|> <s> ▁ _", "fr", "é"),
]


def odd(spark):
    """Documents with the columns of the table and others whose names operators use themselves."""
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.length("text").cast("long"))
    for name in ("_score", "_wkey", "_id", "_spans", "_gone", "_n_lines", "own0", "row", "size", "label", "taken", "_s", "media"):
        docs = docs.withColumn(name, F.lit("extra"))
    return docs


def none(spark):
    return odd(spark).limit(0)
