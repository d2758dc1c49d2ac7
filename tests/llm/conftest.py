import pytest
from pyspark.sql import types as T

from ratewright.storage import materialise

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    """{doc_id: text} of the small table."""
    return {r["doc_id"]: r["text"] or "" for r in documents.collect()}


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, source]) rows, in a few partitions."""

    def build(rows, partitions=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
        return materialise(spark.createDataFrame(full, DOCUMENTS).repartition(partitions), "documents")

    return build


LONG = "lorem ipsum dolor sit amet " * 8000


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and blank texts, a very long one, repeated rows, a NULL source."""
    text = "the quick brown fox jumps over the lazy dog again and again until night falls"
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, text), (5, text), (6, text, None), (None, text),
        (7, "x"), (8, "\U0001d11e 漢字 café ▁ \x00"), (9, None, None),
    ]


@pytest.fixture(scope="session")
def odd(make, odd_rows):
    """The odd rows with extra columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    df = make(odd_rows)
    return df.withColumns({c: F.lit(7) for c in ("row", "size", "token", "node", "grp", "score", "spans", "turn", "label")})
