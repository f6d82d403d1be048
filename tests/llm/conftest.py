
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) rows, with columns that operators must not mind."""

    def make(*rows):
        full = [(i, t, *(rest or ("en", "s")), 7, "x") for i, t, *rest in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score string")

    return make


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
