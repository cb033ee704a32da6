import pytest

from tidemark.session import local_session

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    yield local_session(4, shuffle_partitions=8, app="tidemark-tests")


def words(seed: int, n: int, size: int = 400) -> list[str]:
    import random

    r = random.Random(seed)
    return ["w" + "abcdefghij"[r.randrange(10)] * (r.randrange(3) + 1) + str(r.randrange(size)) for _ in range(n)]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns that clash
    with working names of the operators."""
    long = " ".join(words(1, 60_000, 5000))
    some = " ".join(words(2, 120))
    rows = [
        (1, some, "en", "a", len(some)), (2, some, "en", "a", len(some)), (2, some, "en", "a", len(some)),
        (3, None, "en", "a", 0), (4, "", None, None, None), (5, "   \n\t ", "fr", "b", 6),
        (6, long, "en", "b", len(long)), (None, some, "en", "a", 5), (None, None, None, None, None),
        (7, "one two", "de", "c", 7), (8, " ".join(words(3, 90)), "de", "c", None), (9, "É ç 😀 " * 30, "fr", "c", 1),
    ]
    df = spark.createDataFrame(rows, DOCS)
    clash = {"row": "x", "key": 1, "host_key": "y", "prob": 2.0, "topic": "z", "label": 3, "score": 0.5, "bucket": 4, "tokens": 9, "a.b": 1}
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in clash.items()})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (3, 0, 1), (8, 0, 1), (8, 0, 1), (9, 1, None), (9, 0, None), (None, 1, 1), (6, None, None), (77, 1, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
