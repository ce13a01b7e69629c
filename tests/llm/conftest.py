import pytest

#: Null, empty, long, repeated and tied rows, and columns whose names operators use inside.
DOCS = [
    (1, "alpha beta.\ngamma delta, epsilon zeta eta theta.\nalpha beta.", "en", "b", 10, "x"),
    (2, "alpha beta.\ngamma delta, epsilon zeta eta theta.\nalpha beta.", "en", "b", 10, None),
    (3, None, None, None, None, None),
    (4, "", "en", "a", 0, ""),
    (5, "word " * 20000, "en", "a", 100000, "y"),
    (6, "one two three four five six seven eight nine ten eleven twelve", "en", "c", 5, "z"),
    (6, "one two three four five six seven eight nine ten eleven twelve", "en", "c", 5, "z"),
    (7, "one two three four five six seven eight nine ten eleven thirteen fourteen", "fr", "c", 5, "z"),
    (8, "  \t\n\n ", "fr", "c", 5, "z"),
    (None, "no id here, é漢😀 <|endoftext|> you idiot", "fr", "d", 5, "z"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
