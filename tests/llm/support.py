"""Tables that every operator must take: nulls, empty and very long texts, repeats, odd columns."""

from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do " * 30_000

ODD_TEXTS = [None, "", " ", "\n\n", "word", "Two  spaces\tand\u00a0more \n lines\n", "<|endoftext|>tail <|endoftext|> x", "don't we'll 12345 ???", "ÀÉ ünï çode 漢字かな 🙂🙂 עברית", "x" * 5000, "a\x00b \x1c c", LONG]


def documents(spark, texts=ODD_TEXTS, **extra):
    """One row a text; ids descend so that order is not given; extra columns clash with results."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
                           T.StructField("digest", T.StringType()), T.StructField("score", T.StringType()), T.StructField("n", T.StringType())])
    rows = [(len(texts) - i, t, None if i % 3 == 0 else "en", None, None, "k", "d", "s", "n") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, schema)


def rows(df):
    return [r.asDict() for r in df.collect()]
