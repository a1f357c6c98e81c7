import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from wirelake.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "wirelake-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(base / "shared"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
            "spark.sql.streaming.stateStore.providerClass": (
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
            ),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables here")
    return SF_DIR


def at(text):
    """A time literal's Spark column."""
    from pyspark.sql import functions as F

    return F.lit(text).cast("timestamp")


def seconds(spark, rows, schema, column):
    """Rows whose ``column`` is given in seconds, as a timestamp."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, schema)
    return df.withColumn(column, F.timestamp_micros((F.col(column) * 1_000_000).cast("bigint")))
