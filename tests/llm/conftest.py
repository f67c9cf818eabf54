import pytest

NAMES = ["row", "key", "w", "at", "gram", "n", "label", "first", "bucket", "score", "host", "rule", "__id", "__score"]


@pytest.fixture
def clashing():
    """Adds columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    def add(df):
        return df.select("*", *[F.lit("x").alias(n) for n in NAMES if n not in df.columns])

    return add


@pytest.fixture
def documents(spark):
    def build(*rows):
        return spark.createDataFrame(
            [(i, t, "en", "src", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")

    return build
