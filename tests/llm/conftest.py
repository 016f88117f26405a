import pytest


@pytest.fixture()
def frame(spark):
    """Rows to a documents-like DataFrame with extra, clashing column names."""
    def make(rows, ddl="doc_id long, text string"):
        return spark.createDataFrame(rows, ddl)
    return make
