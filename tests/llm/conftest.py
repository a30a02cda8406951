import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) pairs, with NULLs in the other columns."""

    def build(rows):
        full = [(i, t, None, None, None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(autouse=True, scope="session")
def shipped(spark):
    from spillway.session import ship

    ship(spark)
