import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) rows, with extra columns whose names operators use themselves."""

    def make(rows):
        names = ["doc_id", "text", "score", "size", "shard", "key", "content", "bucket", "ghost", "n_words", "ids"]
        kinds = [LongType(), StringType()] + [StringType()] * (len(names) - 2)
        schema = StructType([StructField(n, k) for n, k in zip(names, kinds)])
        return spark.createDataFrame([(*r, *["x"] * (len(names) - 2)) for r in rows], schema)

    return make


#: Null, empty, blank, tiny, repeated, tied, non-ASCII and very long texts.
ODD = [
    (1, None),
    (2, ""),
    (3, "   \n\t "),
    (4, "a"),
    (5, "Ünï 日本語 \U0001f600 ok"),
    (6, "one two three four five six seven eight nine ten eleven"),
    (6, "one two three four five six seven eight nine ten eleven"),
    (7, "one two three four five six seven eight nine ten eleven"),
    (None, "a row without an id"),
    (None, None),
    (8, "word " * 60_000),
    (9, "x" * 300_000),
    (10, "\x00\x1f\x7f\x85  mixed \r\n"),
]


@pytest.fixture(scope="session")
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture(scope="session")
def none(docs_of):
    return docs_of([])
