import pytest
from pyspark.sql import functions as F

#: Columns whose names the operators use inside.
CLASHING = ["s", "h", "n", "row", "rank", "block", "k", "th", "score", "rep", "bin", "at", "source_", "x"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def odd_rows():
    """NULLs, empty and blank texts, repeated rows and ids, a very long text, odd characters."""
    base = " ".join(f"word{i % 97} thing{i}" for i in range(120))
    near = base.replace("thing7 ", "other ")
    texts = [
        (1, base, "a"), (2, base, "a"), (3, near, "b"), (3, near, "b"), (4, None, "b"), (5, "", None),
        (6, " \t\n ", "b"), (None, base + " end", "c"), (None, None, None), (7, "one", "c"),
        (8, "one two three four", "c"), (9, "ONE Two three four", ""), (10, "é İ ß <|endoftext|> \x1c\x85 x", "c"),
        (11, " ".join(f"long{i}" for i in range(30_000)), "a"), (12, "same same same same " * 40, "a"),
        (7, "another text with that id", "c"),
    ]
    return [(i, t, "en", s, len(t or "")) for i, t, s in texts]


@pytest.fixture(scope="session")
def odd(spark):
    made = spark.createDataFrame(odd_rows(), SCHEMA)
    return made.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHING)])


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}
