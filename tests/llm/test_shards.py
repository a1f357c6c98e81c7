import collections
import zlib

import pytest
from pyspark.sql import functions as F

from wirelake.llm import shards


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3)])
def test_curve_visits_neighbours(spark, dims, bits):
    side = 1 << bits
    cells = [[(n // side**d) % side for d in range(dims)] for n in range(side**dims)]
    names = [f"c{d}" for d in range(dims)]
    df = spark.createDataFrame(cells, ", ".join(f"{n} int" for n in names))
    rows = df.withColumn("h", shards.hilbert_index([F.col(n) for n in names], bits)).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(side**dims))
    assert all(sum(abs(a[n] - b[n]) for n in names) == 1 for a, b in zip(rows, rows[1:]))


def test_runs_are_even_and_gapless(make):
    rows = [(i, "x" * (i % 50)) for i in range(997)] + [(5, "same")] * 20 + [(None, None), (7, "")]
    got = shards.hilbert_shards(make(rows), shards=40).collect()
    assert len(got) == len(rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert sorted(slots) == list(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_fewer_rows_than_shards_and_none(make):
    few = shards.hilbert_shards(make([(1, "a"), (2, None), (3, "é")]), shards=40).collect()
    assert sorted((r["doc_id"], r["size"], r["text_crc32"], r["slot"]) for r in few) == [(1, 17, 3904355907, 0), (2, 16, 0, 0), (3, 18, zlib.crc32("é".encode()), 0)]
    assert len({r["shard"] for r in few}) == 3
    assert shards.hilbert_shards(make([])).count() == 0


def test_shards_prune(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kinds = [r["n"] for r in shards.hilbert_shards(docs, shards=20).groupBy("shard").agg(F.countDistinct("lang").alias("n")).collect()]
    assert sum(kinds) / len(kinds) < 0.75 * docs.select("lang").distinct().count()


def test_query(spark, sf_dir):
    got = shards.op3(spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert got.select("law", "grown_shard").distinct().collect() == [("rows", None)]


def test_written_shards(spark, make, tmp_path):
    docs = make([(i, f"text {i}") for i in range(100)])
    places = shards.hilbert_shards(docs, shards=5)
    shards.write_shards(docs, places, str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert {(r["doc_id"], r["text"]) for r in got.collect()} == {(i, f"text {i}") for i in range(100)}
    assert got.select("shard").distinct().count() == 5


def test_texts_count_whole(spark):
    rows = [(f"https://site{i:02}.example/" if i else None,) for i in range(40) for _ in range(25)]
    df = spark.createDataFrame(rows, "source string")
    value = shards.sortable("source", df.schema["source"].dataType)
    bounds = shards.text_bounds(df, value, 64)
    ordered = sorted(r[0] or "" for r in rows)
    assert bounds == [ordered[-(-(k * len(ordered)) // 64) - 1] for k in range(1, 64)]
    cells = df.select("source", shards.cell_of(value, bounds).alias("c")).distinct().collect()
    assert len(cells) == 40 == len({r["c"] for r in cells})
    assert [r["source"] for r in sorted(cells, key=lambda r: r["c"])] == sorted({r[0] for r in rows}, key=lambda s: s or "")
    assert shards.text_bounds(df.limit(0), value, 64) == []
    one = spark.createDataFrame([("same",)] * 9 + [("z",)], "source string")
    assert shards.text_bounds(one, value, 4) == ["same"] * 3
