import pytest
from pyspark.sql import types as T

from tessera.llm.queries import BYTE_BPE

#: Columns of documents in another order, with names the operators use inside.
SCHEMA = T.StructType([
    T.StructField("n_words", T.StringType()), T.StructField("text", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("tag", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("copies", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("key", T.StringType()), T.StructField("row", T.StringType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        full = [("x", r[1], r[2] if len(r) > 2 else "src0", None, r[0], "c", None, "k", "r") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty and blank texts, a very long one, control characters, ties and repeated rows."""
    long_text = " ".join(f"w{i % 977} longword{i}" for i in range(15_000))
    passage = " ".join(f"shared{i}" for i in range(60))
    return [(1, None), (2, ""), (3, "  \n\t "), (None, "a row without an id " + passage), (None, None), (4, long_text), (5, "début " + passage + " fin"),
            (6, "start " + passage), (6, "start " + passage), (6, "other text of the same id"), (7, "one two three"), (8, "One TWO three"),
            (9, "x\x00y \x1c\x1d\x85   \U0001f600 日本語 " * 4), (10, "start " + passage), (2**62, passage.upper())]


@pytest.fixture(scope="session")
def bpe():
    return BYTE_BPE
