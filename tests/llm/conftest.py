import pytest
from pyspark.sql import functions as F


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a frame with further columns, some of whose names operators use themselves."""

    def make(rows, **extra):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for name in ("spans", "kept", "n_words", "place", "class_id", "rejected_by", "n_removed", "kinds"):
            df = df.withColumn(name, F.lit("theirs"))
        return df

    return make
