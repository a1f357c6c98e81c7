import random
import re

import pytest

from wirelake.llm import jaccard
from wirelake.llm.components import components

WORD = re.compile("[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, n, percent):
    sets, parent = [], {}
    for i, text in rows:
        w = WORD.findall((text or "").translate(LOWER))
        sets.append((i, frozenset(tuple(w[k : k + n]) for k in range(max(len(w) - n + 1, 1))) if w else frozenset()))
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    r, s = root(i), root(j)
                    parent[max(r, s)] = min(r, s)
    return sorted((i, len(s), root(i)) for i, s in sets)


def found(docs, n, percent):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_join(docs, n, percent).collect())


@pytest.mark.parametrize("n,percent,seed", [(3, 90, 1), (5, 80, 2), (3, 50, 3)])
def test_near_copies_of_all_sizes(make, n, percent, seed):
    rng, texts = random.Random(seed), []
    for size in (1, 2, 4, 9, 12, 20, 40, 63, 66, 72, 90, 200, 700, 2000):
        base = [f"w{rng.randrange(10_000)}" for _ in range(size)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, max(1, size // 100), max(1, size // 60), max(1, size // 30)])):
                copy[rng.randrange(size)] = rng.choice(["NEW", f"n{rng.randrange(99)}"])
            if rng.random() < 0.4:
                copy = copy[: max(1, size - rng.randrange(max(2, size // 15)))]
            texts.append(rng.choice([" ", "\n", " \t"]).join(copy))
    ids = rng.sample(range(10_000), len(texts))
    rows = list(zip(ids, texts))
    wanted = brute(rows, n, percent)
    assert len({r[2] for r in wanted}) < len(wanted) - 30
    assert found(make(rows), n, percent) == wanted


def test_odd_rows(make):
    rows = [(3, "One two three four"), (1, "one TWO three four"), (2, None), (4, ""), (5, " \n "), (6, "one two"), (7, "One  two"), (8, "É x y z"), (9, "é x y z"), (10, "long " * 60_000)]
    assert found(make(rows), 3, 90) == brute(rows, 3, 90)
    got = jaccard.jaccard_join(make([(3, "a b c d")] * 3 + [(None, "a b c d"), (None, None)])).collect()
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in got) == [(-1, 0, -1), (-1, 2, -1), (3, 2, 3), (3, 2, 3), (3, 2, 3)]
    assert jaccard.jaccard_join(make([])).count() == 0


def test_a_cluster_over_several_tasks(make, monkeypatch):
    rng = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(rng.choice([1, 2, 8])):
            copy[rng.randrange(150)] = f"n{rng.randrange(9999)}"
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(jaccard, "TASK_GRAMS", 4000)
    assert found(make(rows), 3, 90) == brute(rows, 3, 90)


@pytest.mark.parametrize("rows", [4, 256])
def test_product_in_blocks(monkeypatch, rows):
    import numpy as np

    monkeypatch.setattr(jaccard, "ROWS", rows)
    monkeypatch.setattr(jaccard, "COLUMNS", 32)
    monkeypatch.setattr(jaccard, "PIVOTS", 1)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.choice(60, rng.integers(30, 55), replace=False)).astype(np.uint64) for _ in range(60)]
    bounds = jaccard.Bounds(70)
    parent = list(range(60))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(60):
        for y in range(x):
            both = len(np.intersect1d(sets[x], sets[y]))
            if 100 * both >= 70 * (len(sets[x]) + len(sets[y]) - both):
                parent[max(root(x), root(y))] = min(root(x), root(y))
    wanted = [root(x) for x in range(60)]
    parent = list(range(60))
    for x, y in jaccard.forest(sets, bounds):
        parent[max(root(x), root(y))] = min(root(x), root(y))
    assert [root(x) for x in range(60)] == wanted


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 150), (7, 7)] + [(500, k) for k in range(501, 560)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 200: 100, 150: 100} | {k: 500 for k in range(500, 560)}


def test_steps_of_one_class_go_to_many_buckets():
    import pyarrow as pa

    text = "the same words again and again " * 40_000
    batch = pa.RecordBatch.from_arrays([pa.array(range(24)), pa.array([text] * 24)], ["doc_id", "text"])
    rows = pa.Table.from_batches(list(jaccard._map(iter([batch]), 3, 90, 16))).to_pylist()
    docs = [r for r in rows if r["kind"] == jaccard._DOCS]
    assert sum(len(r["data"]) // 32 for r in docs) == 24
    assert len({r["bucket"] for r in docs}) > 4


def test_a_common_line_makes_no_candidates():
    import numpy as np

    rng = random.Random(6)
    line = " ".join(f"c{k}" for k in range(40))
    values = [" ".join([*(f"w{rng.randrange(10**9)}" for _ in range(500)), line, *(f"w{rng.randrange(10**9)}" for _ in range(500))]) for _ in range(300)]
    values += [values[0] + " and more", values[1].replace("c7", "d7")]
    row, sig, band = jaccard.signatures(*jaccard.gram_sets([v.encode() for v in values], 5), jaccard.Bounds(80))
    order = np.argsort(sig, kind="stable")
    row, sig = row[order], sig[order]
    same = sig[1:] == sig[:-1]
    shared = set(row[1:][same]) | set(row[:-1][same])
    assert {0, 1, 300, 301} <= shared and len(shared) < 150


@pytest.mark.parametrize("percent", [50, 70, 80, 90])
def test_similar_sets_share_a_signature(percent):
    import numpy as np

    rng, bounds = np.random.default_rng(percent), jaccard.Bounds(percent)
    for size in (64, 70, 90, 150, 400, 1500, 6000):
        for _ in range(12):
            # as many n-grams as allowed go, come or are others
            both = rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2)
            spare = size * (100 - percent) // percent
            left = rng.choice([0, spare // 2, spare])
            new = lambda k: rng.integers(0, 2**63, k).astype(np.uint64) * np.uint64(2) + np.uint64(1)
            pair = [np.unique(np.concatenate([both, new(k)])) for k in (left, spare - left)]
            at = np.cumsum([0, *map(len, pair)])
            assert bounds.similar(size, *map(len, pair))
            row, sig, band = jaccard.signatures(np.concatenate(pair), at, bounds)
            assert set(zip(sig[row == 0].tolist(), band[row == 0].tolist())) & set(zip(sig[row == 1].tolist(), band[row == 1].tolist()))


def test_texts_of_no_cluster_are_not_sent(make, spark):
    docs = make([(k, f"text {k}") for k in range(2000)])
    members = spark.createDataFrame([(k,) for k in range(0, 100, 2)], "node bigint")
    got = {r["doc_id"] for r in jaccard._perhaps_in(docs.select("doc_id", "text"), members).collect()}
    assert got >= set(range(0, 100, 2)) and len(got) < 60
    assert jaccard._perhaps_in(docs.select("doc_id", "text"), members.limit(0)).count() == 0
