import hashlib
import random

import numpy as np
import pytest

from wirelake.llm import suffix_dedup


def brute(rows, span=50):
    raw = [(i, (t or "").encode()) for i, t in rows]
    starts = {}
    for i, t in raw:
        if i is not None:
            for k in range(len(t) - span + 1):
                s = t[k : k + span]
                starts[s] = min(starts.get(s, i), i)
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        if i is not None:
            for k in range(len(t) - span + 1):
                if starts[t[k : k + span]] < i:
                    gone[k : k + span] = b"\1" * span
        runs = len([r for r in bytes(gone).split(b"\0") if r])
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((-1 if i is None else i, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def found(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect())


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 9)))
    passages = [" ".join(word() for _ in range(rng.randint(4, 40))) for _ in range(12)] + ["x" * 49, "y" * 50, "z" * 51, "ab" * 60, " " * 80]
    rows = []
    for i in range(120):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(word() for _ in range(rng.randint(1, 20))) for _ in range(rng.randint(0, 6))]
        rows.append((i, rng.choice(["", " ", "\n"]).join(parts)))
    rows += [(200 + k, rows[5][1]) for k in range(5)] + [(300, None), (301, ""), (302, "y" * 50), (7, rows[9][1]), (8, rows[8][1]), (None, rows[5][1]), (None, None)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,group", [(1, 4 << 20), (2, 500)])
def test_brute_force(make, monkeypatch, seed, group):
    monkeypatch.setattr(suffix_dedup, "GROUP_BYTES", group)
    rows = corpus(seed)
    assert found(suffix_dedup.suffix_dedup(make(rows))) == brute(rows)


def test_very_long_and_periodic(make, monkeypatch):
    rows = [(2, "a" * 300_000), (1, "a" * 60), (3, "b" + "a" * 49 + "c"), (4, "ab" * 100_000), (5, "ba" * 30)]
    monkeypatch.setattr(suffix_dedup.blocks, "STEP_BYTES", 1000)
    assert found(suffix_dedup.suffix_dedup(make(rows))) == brute(rows)


def test_other_columns_and_cut_characters(spark):
    shared = "a" + "é" * 24  # 49 bytes, and the next two letters begin with the same byte
    rows = [(1, "ñ" * 40), (2, "x" + "ñ" * 40 + "y"), (3, shared + "é."), (4, "z" + shared + "è!"), (None, "ñ" * 40)]
    schema = "doc_id bigint, text string, g string, n_bytes int, n_removed array<int>, kept_sha256 binary, bucket map<string,double>, data struct<kind: date>"
    docs = spark.createDataFrame([(i, t, "g", None, [k, None], bytes([k, 255]), {"x": float(k)}, (None,)) for k, (i, t) in enumerate(rows)], schema)
    done = suffix_dedup.without_repeats(docs)
    assert done.schema == docs.schema
    got = {r["doc_id"]: r for r in done.collect()}
    assert {i: r["text"] for i, r in got.items()} == {1: "ñ" * 40, 2: "xy", 3: shared + "é.", 4: "zè!", None: "ñ" * 40}
    assert [(got[i]["n_removed"], got[i]["kept_sha256"], got[i]["bucket"]) for i in (2, None)] == [
        ([1, None], b"\1\xff", {"x": 1.0}), ([4, None], b"\4\xff", {"x": 4.0})
    ]
    assert found(suffix_dedup.suffix_dedup(docs)) == brute(rows)
    assert suffix_dedup.suffix_dedup(docs.limit(0)).count() == 0


def test_pieces_of_long_texts():
    texts = [b"", b"0123456789" * 30, b"short"]
    parts, whose, offset = suffix_dedup.blocks.pieces(texts, 9, 40)
    starts = {(w, o + k): p[k : k + 10] for p, w, o in zip(parts, whose.tolist(), offset.tolist()) for k in range(min(40, len(p) - 9))}
    assert starts == {(i, k): t[k : k + 10] for i, t in enumerate(texts) for k in range(len(t) - 9)}
    assert max(map(len, parts)) == 49


def test_cover_ranks_order_the_rests():
    rng = np.random.default_rng(2)
    text = rng.integers(97, 99, (200, 80)).astype(np.uint8)
    text[50:90] = text[10]
    ranks = suffix_dedup.cover_ranks(text)
    for k, place in enumerate(range(0, 80, suffix_dedup.PERIOD)):
        rest = [row[place:].tobytes() for row in text]
        number = {s: n for n, s in enumerate(sorted(set(rest)))}
        assert ranks[k].tolist() == [number[s] for s in rest]


def test_the_documents_are_shuffled_once(spark, sf_dir):
    df = suffix_dedup.suffix_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan and plan.count("FlatMapCoGroupsInArrow") >= 3
