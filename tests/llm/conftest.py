import os

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # names that operators use themselves
        T.StructField("score", T.StringType()),
        T.StructField("n_words", T.StringType()),
        T.StructField("row", T.StringType()),
        T.StructField("kept", T.StringType()),
    ]
)


@pytest.fixture
def make(spark):
    """A documents table of (doc_id, text) rows, with nulls and clashing columns beside them."""

    def build(rows):
        full = [(i, t, None if k % 3 else "en", None if k % 2 else "src", None if t is None else len(t), "s", None, "r", "k") for k, (i, t) in enumerate(rows)]
        return spark.createDataFrame(full, DOCS)

    return build


@pytest.fixture
def folder(spark, tmp_path):
    """Tables written where a query looks for them."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(os.path.join(str(tmp_path), f"{name}.parquet"))
        return str(tmp_path)

    return write
