import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                       T.StructField("n_chars", T.LongType())])


def make(spark, texts, ids=None):
    """A documents table with the texts under 0, 1, ... or the given ids."""
    rows = [(i if ids is None else ids[i], t, "en", "src0", 0 if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    """The documents of the smallest data set, as rows and as a table."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return df.orderBy("doc_id").collect(), df


#: null, empty, blank, one word, odd characters, repeated rows, one very long text
EDGE = [None, "", " \n\t ", "word", "é Ü   x", "same text here", "same text here",
        "a" * 5000, "long words of text \n" * 3000, None, "<|endoftext|> tail"]
EDGE_IDS = [0, 1, 2, 3, 4, 5, 5, 6, 7, None, None]
