"""Rows every operator must take: nulls, empty and very long texts, repeated
rows, ties, and extra columns whose names clash with the operators' own."""

from pyspark.sql import types as T

LONG = "Long words, " * 9000

DOCS = [
    (1, "One two three four five six seven.", "en", "b", 1),
    (2, "One two three four five six seven.", "en", None, 1),
    (2, "One two three four five six seven.", "en", None, 1),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (None, " \t\n", "en", "a", 3),
    (None, "One two three four five six seven.", "fr", "c", 1),
    (5, LONG, "en", "b", 2),
    (6, "one TWO", "en", "b", 2),
    (7, "été à 中文 naïve x", "fr", "c", 2),
    (8, "All rights reserved. CC BY! cc-by; General\nPublic License", "en", "c", 2),
]
_NAMES = "doc_id text lang source n_chars".split()


def docs_frame(spark, rows=DOCS):
    """Documents with extra columns that operators might use themselves."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType()), T.StructField("at", T.StringType()),
                           T.StructField("size", T.StringType()), T.StructField("kept", T.StringType()),
                           T.StructField("fp", T.StringType()), T.StructField("copy", T.StringType())])
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x") for r in rows], schema)


def empty_frame(spark):
    return docs_frame(spark, [])


def from_table(spark, sf_dir, name="documents"):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
