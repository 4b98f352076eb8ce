import pytest

DOCS = "doc_id long, text string, lang string, score int, shard string, kept string, record string, rep long"


@pytest.fixture
def docs(spark):
    """Makes a table of (doc_id, text[, lang]) whose other columns have names that operators use themselves."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", 7, "s", "k", "r", 1) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make
