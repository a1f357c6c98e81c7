import random
import zlib

import pytest

from wirelake.llm import toxicity


def corpus(seed, n):
    rng = random.Random(seed)
    common = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(20, 200))]
        bad = i % 4 == 0
        for _ in range(3 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["Grumbnik", "zwobble", "quixfart", "hmpfdrek"]))
        rows.append((i, " ".join(words), int(bad)))
    return rows


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rows = corpus(1, 900)
    path = tmp_path_factory.mktemp("toxic")
    spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id bigint, text string").write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, y) for i, _, y in rows] + [(3, None, None), (None, 1, 1), (5000, 1, 1), (3, 1, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), rows


def test_held_out_accuracy(spark, tables):
    path, rows = tables
    label = {i: y for i, _, y in rows}
    got = toxicity.op6(spark, path).collect()
    assert len(got) == len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    right = [r["predicted"] == label[r["doc_id"]] for r in got if r["held_out"]]
    assert sum(right) >= 0.97 * len(right)


def test_held_out_rows_are_never_learned_from(spark, tables):
    path, _ = tables
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "IF(crc32(string(doc_id)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    assert toxicity.learned(docs, labels) == toxicity.learned(docs, flipped)


def test_odd_rows(make):
    model = toxicity.fit([(t.encode(), y) for _, t, y in corpus(2, 200)], 0.25)
    rows = [(1, None), (2, ""), (3, " "), (4, "x" * 100_000), (None, "grumbnik zwobble"), (5, "grumbnik " * 3), (5, "grumbnik " * 3)]
    got = toxicity.scored(make(rows), model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert toxicity.scored(make([]), model).count() == 0


def phrases(seed, n):
    """Toxic texts have no word of their own, only an order of words."""
    rows, bad = [], "tola nero sali vuma peto"
    rng = random.Random(seed)
    common = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 7))) for _ in range(100)] + bad.split()
    for i in range(n):
        words = [rng.choice(common) for _ in range(60)]
        if i % 4 == 0:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), bad)
        rows.append((" ".join(words).encode(), int(i % 4 == 0)))
    return rows


def test_phrases_of_ordinary_words_count():
    rows = phrases(5, 1200)
    model = toxicity.fit(rows[:900], 0.25)
    right = [(model.score(t) >= 0.5) == bool(y) for t, y in rows[900:]]
    assert sum(right) >= 0.9 * len(right)


def test_one_class_or_none(make):
    assert toxicity.fit([], 0.0).score(b"anything") < 0.5
    assert toxicity.fit([(b"a b", 0)] * 9, 0.0).score(b"anything") < 0.5


def test_windows_cover_the_text():
    rng = random.Random(4)
    for _ in range(300):
        text = b"".join(rng.choice([b" ", b"a", b"bc"]) for _ in range(rng.randint(0, 400)))
        text += b"w" * rng.choice([0, 0, 500])
        found = toxicity.windows(text)
        words = [w for w in text.split() if len(w) <= toxicity.WINDOW]
        assert all(any(w in f for f in found) for w in words)
        assert sum(map(len, found)) >= len(text.strip()) and bool(found) == bool(text)
