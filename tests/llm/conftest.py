import pytest

#: rows that every operator has to bear: nulls, empty, short, very long, repeated rows
TEXTS = [
    (1, "one two three four five six seven eight nine ten " * 30, "en", "a"), (2, None, "en", "a"), (3, "", None, "a"), (4, "word", "en", None),
    (None, "a text without an id, which is long enough for five words", "en", "a"), (5, "x " * 30_000, "de", "b"),
    (6, "equal rows are here twice and more", "en", "a"), (6, "equal rows are here twice and more", "en", "a"), (7, " \n\t ", "fr", "c"),
]
EXTRA = "doc long, node long, `key` string, kept string, anchor long, score double, _pii_found string, _kept_id long, `a.b` string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """The odd rows, with extra columns whose names the operators use inside."""
    rows = [(*r, len(r[1] or ""), 0, 0, "k", "yes", 1, 0.5, "p", 2, "dot") for r in TEXTS]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def some_docs():
    """(doc_id, text) of the smallest given table, read without Spark."""
    import duckdb
    return duckdb.connect().execute("select doc_id, text from '/root/testdata/sf0.001/documents.parquet' order by doc_id").fetchall()
