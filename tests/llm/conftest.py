import pytest


@pytest.fixture()
def documents(spark):
    """Rows (doc_id, text, ...) with clashing extra columns; texts may be None."""
    def make(rows):
        return spark.createDataFrame([(i, t, s, 1, "x") for i, t, s in rows],
                                     "doc_id long, text string, source string, g int, kept string")
    return make
