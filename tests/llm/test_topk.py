import math

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from wirelake.llm import topk

SCHEMA = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        # names that the operator uses itself
        *[T.StructField(n, T.StringType()) for n in ("score", "query", "place", "vector", "row", "length", "wave")],
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(i, v, *"abcdefg") for i, v in rows], SCHEMA)


def brute(rows, k=5, every=50):
    """Scores of all row pairs; the result is one sorted list per query row."""
    usable = []
    for i, v in rows:
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for a, (i, v) in enumerate(usable):
        if i is None or i % every:
            continue
        scores = [(-sum(x * y for x, y in zip(v, w)), j is None, j or 0, j) for b, (j, w) in enumerate(usable) if a != b]
        out.append([(i, r + 1, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k])])
    return sorted(map(repr, out))


def got(df):
    lists = {}
    for r in sorted(df.collect(), key=lambda r: (r["query"], r["rank"])):
        lists.setdefault(r["query"], []).append((r["query_id"], r["rank"], r["vec_id"], r["score"]))
    return sorted(map(repr, lists.values()))


def chosen():
    return F.col("vec_id") % 50 == 0


@pytest.mark.parametrize("waves", [16, 10_000])
@pytest.mark.parametrize("shape", ["random", "low rank", "copies", "lengths"])
def test_against_all_pairs(spark, waves, shape):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 12)) / 3
    if shape == "low rank":
        x = rng.normal(size=(200, 2)) @ rng.normal(size=(2, 12))
    if shape == "copies":
        x = np.repeat(x[:4], 50, axis=0)
    if shape == "lengths":
        x *= np.exp(rng.normal(size=(200, 1)))
    rows = [(int(i), v.tolist()) for i, v in enumerate(x)]
    df = table(spark, rows).repartition(5)
    # waves and blocks of queries that are far smaller than production's
    found = topk.top_products(df, chosen(), first_wave=waves, block_bytes=12 * 8 * 3)
    assert got(found) == brute(rows)


def test_nulls_repeats_and_odd_vectors(spark):
    rows = [
        (0, [1.0, -0.5]), (0, [1.0, -0.5]), (0, [2.0, 0.25]), (50, []), (100, None), (150, [1.0, None]),
        (200, [float("nan"), 1.0]), (250, [float("inf"), 1.0]), (None, [3.0, 3.0]), (None, [3.0, 3.0]),
        (7, [0.001, -0.001]), (8, [1.0, 2.0, 3.0]), (-50, [-1.0]), (9, [1.0, -0.5]),
    ]
    assert got(topk.top_products(table(spark, rows), chosen())) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(50 * i, [3e6 + i / 4, -2.9e6 - i, 1.5e6]) for i in range(12)]
    assert got(topk.top_products(table(spark, rows), chosen(), first_wave=3)) == brute(rows)


def test_few_and_no_rows(spark):
    assert got(topk.top_products(table(spark, []), chosen())) == []
    assert got(topk.top_products(table(spark, [(1, [1.0])]), chosen())) == []
    assert got(topk.top_products(table(spark, [(0, [1.0])]), chosen())) == []
    rows = [(0, [1.0]), (1, [2.0])]
    assert got(topk.top_products(table(spark, rows), chosen())) == brute(rows)


def test_a_long_vector_spares_most_products(spark, monkeypatch):
    """Directions and lengths decide before exact products do."""
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(4000, 3)) * np.exp(rng.normal(size=(4000, 1)))) @ rng.normal(size=(3, 16))
    whole = np.floor(256 * x).astype(np.int64)
    whole = whole[np.argsort(-(whole**2).sum(axis=1))]
    turn = np.linalg.svd(whole.astype(float))[2].T
    queries, places = whole[:100], np.arange(100)
    best = topk.Best(np.full(100, topk._LEAST), 5)
    counted = []
    exact = topk.pair_products
    monkeypatch.setattr(topk, "products", lambda a, b, bound, run=topk.products: (counted.append(len(a) * len(b)), run(a, b, bound))[1])
    monkeypatch.setattr(topk, "pair_products", lambda a, b, bound: (counted.append(len(a)), exact(a, b, bound))[1])
    monkeypatch.setattr(topk, "CANDIDATE_ROWS", 200)
    topk.search_rows(best, queries, places, topk.Rotated(queries, turn), whole, np.arange(4000), np.arange(4000), turn)
    wanted = np.sort(np.where(np.arange(4000) == places[:, None], topk._LEAST, queries @ whole.T), axis=1)[:, :-6:-1]
    assert (best.scores == wanted).all()
    assert sum(counted) < 0.2 * 100 * 4000
