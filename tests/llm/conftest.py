import pytest

from phenoloom.session import drop_staged

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}


@pytest.fixture
def make(spark):
    """Small tables of documents: (doc_id, text) pairs, with columns whose names clash."""

    def table(rows, extra=True):
        listed = [(i, t, "en", "src", None) for i, t in rows]
        df = spark.createDataFrame(listed, DOCS)
        return df.selectExpr("*", "1 AS _id", "2 AS _text", "3 AS score", "4 AS ids") if extra else df

    return table


@pytest.fixture(autouse=True, scope="module")
def clean(spark):
    yield
    drop_staged(spark)
