import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
NAMES = "doc_id long, text string, at string, fp long, score double, fingerprint string, spans string, ids string"

#: Nulls, empty and blank texts, repeated rows and ids, and one very long text.
ODD = [
    (1, "the quick brown fox jumps over the lazy dog"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (None, "a text without an id"),
    (None, None),
    (5, "the quick brown fox jumps over the lazy dog"),
    (5, "the quick brown fox jumps over the lazy dog"),
    (6, "x"),
    (7, "né ß İstanbul 中文 \U0001f600 " + "word " * 30_000),
    (7, "other text of the same id"),
    (8, "z" * 20_000),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, "at", 1, 0.5, "f", "s", "i") for i, t in ODD], NAMES).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], NAMES)


@pytest.fixture(scope="session")
def documents(spark, data):
    return spark.read.parquet(f"{data}/documents.parquet")


@pytest.fixture(scope="session")
def rows(documents):
    """doc_id and text, on the driver."""
    return [(r["doc_id"], r["text"] or "") for r in documents.select("doc_id", "text").orderBy("doc_id").collect()]
