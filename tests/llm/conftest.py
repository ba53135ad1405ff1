import pytest

#: Extra columns with names that the operators use inside.
EXTRA = "lang string, source string, n_chars long, n long, node long, block long, word string, tokens string, key string"


@pytest.fixture(scope="session")
def table(spark):
    """Rows of (doc_id, text, ...) as a documents table with clashing extra columns."""

    def make(rows, lang="en"):
        full = [(i, t, lang if len(r) == 0 else r[0], "src", 1, 2, 3, 4, "w", "t", "k") for i, t, *r in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, {EXTRA}").repartition(3)

    return make


@pytest.fixture(scope="session")
def by_id():
    def rows(df):
        return {r["doc_id"]: r for r in df.collect()}

    return rows
