from datetime import datetime

import pytest
from pyspark.sql import functions as F

from wirelake.operators import compaction as C
from wirelake.operators import storage
from pyspark.sql import types as T

from wirelake.schema import PACKETS, PACKET_COLUMNS, STORED_PACKETS
from wirelake.sources import files

NOW = "2024-01-02 00:00:00"
BATCHES = T.StructType([*STORED_PACKETS.fields, T.StructField("batch_id", T.LongType())])


def packets(spark, rows):
    """Packets of (hour, minute, number)."""
    full = [
        (datetime(2024, 1, 1, h, m), f"10.0.0.{n % 7}", "10.1.0.1", n, None, "eth:ip:tcp", 60 + n, f'{{"n": {n}}}') for h, m, n in rows
    ]
    return spark.createDataFrame(full, PACKETS)


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in PACKET_COLUMNS]).collect())


def per_hour(spark, path):
    found = files.file_sizes(spark, path).groupBy(F.hour("chunk").alias("h")).count().collect()
    return {r["h"]: r["count"] for r in found}


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "packets")
    for part in range(4):
        storage.append_packets(packets(spark, [(h, m, part * 100 + m) for h in (1, 2, 23) for m in range(part, 60, 4)]), path)
    return path


def test_closed_hours_become_one_file(spark, table):
    before = rows_of(spark.read.parquet(table))
    assert min(per_hour(spark, table).values()) >= 4
    assert C.compact_table(spark, table, "2024-01-01 23:30:00") == 2
    after = per_hour(spark, table)
    assert after[1] == after[2] == 1 and after[23] >= 4  # the last hour is still open
    assert rows_of(spark.read.parquet(table)) == before
    assert C.compact_table(spark, table, "2024-01-01 23:30:00") == 0
    assert C.compact_table(spark, table, NOW, late="2 hours") == 0 and C.compact_table(spark, table, NOW) == 1


def test_a_large_hour_becomes_files_of_a_size(spark, tmp_path):
    path = str(tmp_path / "packets")
    for part in range(12):
        storage.append_packets(packets(spark, [(5, n % 60, part * 200 + n) for n in range(200)]), path)
    before, sizes = rows_of(spark.read.parquet(path)), files.file_sizes(spark, path)
    total = sizes.agg(F.sum("length")).first()[0]
    bins = -(-total // (total // 3))
    C.compact_table(spark, path, NOW, file_bytes=total // 3)
    assert per_hour(spark, path)[5] == bins and rows_of(spark.read.parquet(path)) == before
    most, least = files.file_sizes(spark, path).agg(F.max("length"), F.min("length")).first()
    assert most < 2 * least  # hashed minutes of pairs fill the files alike


def land(spark, folder, batch, rows):
    shaped = storage.with_chunk(packets(spark, rows)).withColumn("batch_id", F.lit(batch).cast("bigint"))
    shaped.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk", "batch_id").parquet(folder)


def test_micro_batches_move_and_count_once(spark, tmp_path):
    landed, compacted = f"{tmp_path}/packets", f"{tmp_path}/compacted"
    for batch in range(5):
        land(spark, landed, batch, [(h, m, batch) for h in (1, 2) for m in range(6)])
    before = rows_of(C.current(spark, landed, compacted, BATCHES))
    assert len(before) == 60
    assert C.compact_ingested(spark, landed, compacted, NOW, BATCHES) == 2
    assert per_hour(spark, compacted) == {1: 1, 2: 1} and per_hour(spark, landed) == {}
    assert rows_of(C.current(spark, landed, compacted, BATCHES)) == before
    # the last micro-batch is run again after a restart, and a late one comes for an old hour
    land(spark, landed, 4, [(h, m, 4) for h in (1, 2) for m in range(6)])
    land(spark, landed, 5, [(1, 30, 77), (3, 0, 78)])
    more = before + rows_of(packets(spark, [(1, 30, 77), (3, 0, 78)]))
    assert rows_of(C.current(spark, landed, compacted, BATCHES)) == sorted(more)
    C.compact_ingested(spark, landed, compacted, NOW, BATCHES)
    assert rows_of(C.current(spark, landed, compacted, BATCHES)) == sorted(more)
    assert per_hour(spark, compacted)[1] == 1 and 1 not in per_hour(spark, landed)


def test_a_stop_before_the_old_files_go(spark, tmp_path, monkeypatch):
    landed, compacted = f"{tmp_path}/packets", f"{tmp_path}/compacted"
    for batch in range(3):
        land(spark, landed, batch, [(1, m, batch) for m in range(4)])
    before = rows_of(C.current(spark, landed, compacted, BATCHES))

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(C.files, "remove_folder", stop)
        with pytest.raises(RuntimeError):
            C.compact_ingested(spark, landed, compacted, NOW, BATCHES)
    assert per_hour(spark, landed) == {1: 3} and per_hour(spark, compacted) == {1: 1}
    assert rows_of(C.current(spark, landed, compacted, BATCHES)) == before
    C.compact_ingested(spark, landed, compacted, NOW, BATCHES)
    assert per_hour(spark, landed) == {} and rows_of(C.current(spark, landed, compacted, BATCHES)) == before


def test_expiry_of_folders(spark, table):
    kept = rows_of(spark.read.parquet(table).filter("hour(ts) >= 2"))
    # an hour goes once it lies wholly before the limit
    assert C.expire_folders(spark, table, "2024-01-02 02:59:59", at_once=1) == ["2024-01-01 01:00:00"]
    assert rows_of(spark.read.parquet(table)) == kept
    assert C.expire_folders(spark, table, "2024-01-02 02:59:59") == []
    assert C.expire_folders(spark, table, "2024-01-02 03:00:00") == ["2024-01-01 02:00:00"]
    assert C.expire_folders(spark, f"{table}-none", NOW) == []


def test_no_table(spark, tmp_path):
    assert C.compact_table(spark, f"{tmp_path}/none", NOW) == 0
    assert C.compact_ingested(spark, f"{tmp_path}/a", f"{tmp_path}/b", NOW, BATCHES) == 0
