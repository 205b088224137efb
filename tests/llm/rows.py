"""Small documents that every operator must take: nulls, empties, ties, repeats, long texts, clashing columns."""

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("_bucket", T.LongType()),
        T.StructField("fp", T.StringType()),
        T.StructField("kept", T.StringType()),
    ]
)


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), 7, "x", "y")


LONG = " ".join(f"word{i % 997}x{i % 31}" for i in range(30_000))
ODD = [
    row(1, None), row(2, ""), row(3, "  \n\t "), row(4, "one"), row(4, "one"), row(None, "one"), row(None, None),
    row(5, "One TWO three four five six", None, None), row(6, LONG, "de", "b"), row(7, LONG + " tail", None, "b"), row(8, "ééé ñandú \u00a0 0", "es", None),
]


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def docs(spark, texts, source="a", lang="en"):
    return spark.createDataFrame([row(i, t, lang, source) for i, t in enumerate(texts)], SCHEMA)
