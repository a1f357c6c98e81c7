import hashlib
import random

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from wirelake.llm import bpe, common
from wirelake.sources import files as sources
from tests.llm import test_decontaminate, test_jaccard, test_rules, test_suffix_dedup


def documents(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, leak = text(70), text(30)
    clean = [text(rng.randint(30, 200)) for _ in range(80)]
    rows = [*clean]
    rows += [clean[k] for k in (3, 3, 4)] + [clean[5] + " and one more", clean[6].replace("a", "A")]
    rows += [text(50) + " " + passage + " " + text(40) for _ in range(6)] + [text(40) + " " + leak + " " + text(20) for _ in range(4)]
    rows += [" ".join(w + "###$$$" for w in text(60).split()) for _ in range(60)] + [(text(5) + " ") * 30 for _ in range(40)] + ["", None, "too short"]
    order = rng.sample(range(1000), len(rows))
    full = [(i, t, "en", "s", 0 if t is None else len(t)) for i, t in zip(order, rows)] + [(None, text(40), None, None, None)]
    # an id with another text is another document; a copy without an id is a copy
    full += [(order[0], text(60), "en", "s", 1), (None, clean[9], None, "s", 2), full[10], full[10]]
    # columns with names that operators use, of types that they cannot compare
    full = [(*r, "g", [1, None], bytearray(b"\xff"), {"a": k}, "yes", k) for k, r in enumerate(full)]
    junk = {i for i, t, *_ in full if t and "###" in t}
    docs = spark.createDataFrame(full, "doc_id bigint, text string, lang string, source string, n_chars bigint, "
        "g string, n_bytes array<int>, kept_sha256 binary, _key map<string,int>, kept string, n_words int")
    labels = spark.createDataFrame([(i, 0 if i in junk else 1, 0) for i, *_ in full if i is not None], "doc_id bigint, quality int, toxic int")
    return docs, labels, spark.createDataFrame([(1, leak), (2, "never seen " * 6)], "item_id bigint, text string"), junk


def test_each_stage_by_brute_force(spark, folder):
    docs, labels, items, junk = documents(spark)
    path = folder(documents=docs, labels=labels, benchmark=items)
    now = spark.read.parquet(f"{path}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES:
        kept.append(now)
        given, now = now, common.written(stage(spark, now, path), "stage")
        if len(kept) < len(corpus_pipeline.STAGES):
            assert now.columns == given.columns and now.dtypes == given.dtypes
    kept.append(now)
    rows = [[(r["doc_id"], r["text"]) for r in k.collect()] for k in kept[:5]]

    def base(t):
        n, *_, again = test_rules.brute(t)
        return n >= 20 and 100 * again <= 30 * n

    assert {i for i, _ in rows[1]} == {i for i, t in rows[0] if base(t) and i not in junk}
    each = sorted(set(rows[1]), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    groups = test_jaccard.brute([(k, t) for k, (_, t) in enumerate(each)], 5, 80)
    assert sorted(rows[2], key=str) == sorted((each[k] for k, _, c in groups if k == c), key=str)
    assert len(rows[2]) < len(rows[1])
    cut = test_suffix_dedup.brute(rows[2])
    assert sorted(len((t or "").encode()) for _, t in rows[3]) == sorted(n - gone for _, n, gone, _, _ in cut)
    assert {hashlib.sha256(t.encode()).hexdigest() for _, t in rows[3]} == {r[4] for r in cut} and sum(r[2] for r in cut) > 300
    bad = test_decontaminate.brute(rows[3], [(1, items.first()["text"])])
    assert {i for i, _ in rows[4]} == {None if d == -1 else d for d, *_, hit in bad if not hit} and len(rows[4]) < len(rows[3])
    own = bpe.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    assert sorted(r["ids"] for r in now.collect()) == sorted(own.encode(t) for _, t in rows[4])


def test_run_on_an_empty_table(spark, folder):
    docs, labels, items, _ = documents(spark)
    assert corpus_pipeline.run(spark, folder(documents=docs.limit(0), labels=labels, benchmark=items)).count() == 0


def test_stages_leave_neither_their_input_nor_shuffle_files(spark, folder, monkeypatch):
    shuffled = lambda: sum(f.getName().startswith("shuffle_") for f in _java_list(spark))
    docs, labels, items, _ = documents(spark)
    path = folder(documents=docs, labels=labels, benchmark=items)
    made, given = [], corpus_pipeline.run_folder
    monkeypatch.setattr(corpus_pipeline, "run_folder", lambda s, name: made.append(given(s, name)) or made[-1])
    assert corpus_pipeline.run(spark, path).count() > 0
    assert [sources.exists(spark, p) for p in made] == [False] * (len(corpus_pipeline.STAGES) - 1) + [True]

    before = shuffled()
    common.written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert shuffled() <= before


def _java_list(spark):
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return [found.apply(k) for k in range(found.size())]
