import pytest

LONG = "lorem ipsum dolor sit amet " * 20_000
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept boolean, _text string, key string, score int"


def rows(texts):
    return [(i, t, "en", s, 0, None, "x", "k", 1) for i, t, s in texts]


@pytest.fixture
def odd(spark):
    """Null, empty and very long texts, ties, repeated rows, a null id, null sources, and clashing column names."""
    return spark.createDataFrame(rows([
        (1, None, "a"), (2, "", "a"), (3, LONG, "a"), (4, "one two", None), (4, "one two", None), (5, "one two", "b"),
        (None, "alone here", "b"), (6, " \t\n ", None), (7, "Zwölf Boxkämpfer jagen Viktor quer über den Sylter Deich", "c"),
        (8, "a" * 50_000, "c"),
    ]), SCHEMA)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
