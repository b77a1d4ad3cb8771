import pytest
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType())])
LABELS = StructType([StructField("doc_id", LongType()), StructField("quality", IntegerType()), StructField("toxic", IntegerType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """docs_of(rows or texts, **extra columns): a documents table."""
    def make(rows):
        full = []
        for i, r in enumerate(rows):
            r = (i, r) if isinstance(r, str) or r is None else tuple(r)
            r = r + (None, None)[len(r) - 2:] if len(r) < 4 else r
            full.append((*r[:4], len(r[1]) if r[1] is not None else None))
        return spark.createDataFrame(full, DOCS)
    return make


MESSY = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \n\t ", None, None), (None, "a null id with some words in it", "en", "b"),
    (None, "another null id and other words in it", None, "b"), (4, "one two three four five six seven eight", "en", "a"),
    (4, "one two three four five six seven eight", "en", "a"), (5, "one two three four five six seven eight", "de", "b"),
    (4, "the same id with another text of its own", "en", "a"), (6, "wort " * 60_000, "de", None),
    (7, "é" * 900, "fr", "c"), (8, "é" * 900, "fr", "c"), (9, "Line of it\n" * 50, "en", "a"), (10, "ab" * 3000, "en", "c"),
    (11, "Released under the MIT License.\nAnd CC BY too", "en", "c"),
]


@pytest.fixture(scope="session")
def messy(docs_of):
    return docs_of(MESSY)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], LABELS)
