import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def rows(docs):
    return [r.asDict() for r in docs.collect()]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated
    rows, and extra columns named like those that operators add."""
    long = " ".join(f"word{i} of the long text" for i in range(40_000))
    texts = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, None), (3, ""), (4, " \n "),
             (5, long), (6, "ünïcode ÉCOLE 漢字 mit license"), (7, "one two"), (8, "one two"), (8, "one two"),
             (None, "one two"), (None, None), (9, "!!! ??? ..."), (10, "alpha beta gamma delta epsilon zeta eta theta iota kappa")]
    extra = "score double, kept boolean, id bigint, node string, row bigint, h string, label int, text_sha256 string"
    return spark.createDataFrame(
        [(i, t, None, "src", None, 1.0, None, 7, "n", 1, "h", 1, "s") for i, t in texts],
        f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)
