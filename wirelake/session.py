"""Session helpers: a UTC session and the shared working folder."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"
_STATE = "spark.sql.streaming.stateStore"
#: State in files with a bounded share of memory; a micro-batch writes what it changed, and none
#: without rows opens all of it only to evict, which the next one with rows does as well.
_DISK_STATE = {
    f"{_STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STATE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STATE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STATE}.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def build_session(app: str = "wirelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on: UTC zone and adaptive plans."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        REPEATED_KEYS: "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Hour chunks and timestamp texts are defined in UTC, whatever zone the host is in.

    Of a key that a JSON document repeats, the last value counts, as everywhere in the library.
    """
    spark.conf.set(REPEATED_KEYS, "true")
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Without that setting it lies in the warehouse, which executors share as well.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work"
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, so that two runs never meet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start meanwhile keep their state on disk instead of in the heap of the executors.

    Not for streams that give rows only when the watermark passes: the last ones would wait for more input.
    """
    before = {key: spark.conf.get(key, None) for key in _DISK_STATE}
    for key, value in _DISK_STATE.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def send_code_with_tasks(module: str) -> None:
    """Let Python workers receive a module's functions with the task.

    They need not find this package on their own path, on whatever machine they run.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])
