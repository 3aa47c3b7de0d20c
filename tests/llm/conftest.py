import pytest

#: A row of every odd kind, with columns whose names the operators use themselves.
SCHEMA = "doc_id bigint, text string, lang string, score string, ids string, _row string, kept string"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) or (id, text, lang), with further columns of clashing names."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", "i", "r", "k") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
