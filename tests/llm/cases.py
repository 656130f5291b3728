"""Small tables of odd rows: NULLs, empty and long texts, ties, repeats, clashing extra columns."""

from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))

ODD = [
    (1, "The quick brown fox jumps over the lazy dog.", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog.", "en", "a"),
    (2, "the QUICK brown fox jumps over the lazy dog.", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, " \t\n\x0b ", None, "b"),
    (None, "a row without id", "en", None),
    (7, "É ÀÉ x  \n\n  tail's'x 123abc", "fr", "c"),
    (8, LONG, "en", "a"),
    (9, "word", "en", "c"),
    (10, "x" * 200_000, "en", "c"),
    (10, "another text of the same id", "en", "c"),
]


def docs(spark, rows=ODD):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    df = df.withColumn("n_chars", F.length("text").cast("long"))
    for c in ("size", "key", "fp", "k", "taken", "target", "ids", "score", "row", "n", "_pid", "digest", "_id", "_copies", "_words", "_rest", "_whole",
              "_spans", "_digest", "_source", "_taken", "_size", "_row", "_text", "doc", "of", "text_digest", "a.b", "c`d"):
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)


def empty(spark):
    return docs(spark).limit(0)
