import pytest
from pyspark.sql import types as T


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, with further columns."""
    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType())])

    def build(rows, source="a"):
        full = [(i, t, "en", source(i) if callable(source) else source, len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, schema)

    return build


#: Nulls, empty and blank texts, a long one, repeats, and odd characters.
ODD = [(1, "The cat, it SAT on\tthe mat."), (2, None), (3, ""), (4, " \n\t "), (5, "the cat " * 20_000), (5, "the cat " * 20_000),
       (6, "é́ naïve ΣΊΣΥΦΟΣ İ x y 12 <|endoftext|>z 汉字 \x1c a"), (7, "x" * 30_000), (None, "no id"), (None, None), (1, "other text, same id")]


@pytest.fixture(scope="session")
def odd():
    return ODD
