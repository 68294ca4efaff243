import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows, with clashing extra columns."""

    def make(*rows, extra=True):
        full = [(r[0], r[1], None, r[2] if len(r) > 2 else "a", None) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        names = ["size", "order", "bucket", "kept", "key", "n_tokens", "ids", "word", "score", "rank", "n", "sig", "rid"]
        if extra:
            for name in names:
                df = df.selectExpr("*", f"'x' as {name}")
        return df

    return make


@pytest.fixture
def sample(spark):
    """Real documents, the smallest given table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
