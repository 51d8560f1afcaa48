import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Rows of (doc_id, text[, source]) as a documents table with columns that clash."""

    def documents(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            from pyspark.sql import functions as F

            for name in ("row", "_id", "_text", "size", "key", "label", "a", "kept", "taken", "_row"):
                df = df.withColumn(name, F.lit(None).cast("string"))
        return df

    return documents
