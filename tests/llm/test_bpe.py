import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from wirelake.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("seed", range(4))
def test_random_texts(library, seed):
    rng, own = random.Random(seed), bpe.encoder(PATH, public_tokenizers.PATTERN)
    letters = "ab e\n\t \xa0 　 \x1c\x85'sS1２!é漢🙂́\r\x0b​<|>"
    for _ in range(4000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        assert own.encode(text) == library.encode_ordinary(text), repr(text)
        assert own.decode(own.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 5000, "ab" * 3000, "aab" * 2000, " " * 3000, "!" * 3000, "the" * 3000, "é" * 3000])
def test_very_long_matches(library, text):
    assert bpe.encoder(PATH, public_tokenizers.PATTERN).encode(text) == library.encode_ordinary(text)


def test_rank_queue_gives_the_least_rank():
    rng, queue = random.Random(1), bpe.RankQueue(60_000)
    pairs = [(rng.randrange(60_000) if rng.random() < 0.5 else rng.randrange(5), p) for p in range(3000)]
    for rank, place in pairs:
        queue.bucket(rank, list).append(place)
    found = []
    while queue.top:
        rank = queue.least()
        found += [(rank, p) for p in queue.take(rank)]
    assert found == sorted(pairs)
    assert not queue.buckets and not any(queue.low) and not any(queue.mid)


def test_shared_queue_equals_own_queues():
    rng, own = random.Random(2), bpe.encoder(PATH, public_tokenizers.PATTERN)
    tokens = ["".join(rng.choice("aabeinorst é") for _ in range(rng.randint(1, 40))).encode() for _ in range(3000)]
    tokens += [b"a" * k for k in range(1, 60)]
    tokens = [t for t in tokens if t not in own.ranks]
    assert own.merge_all(tokens) == [bpe._packed(own.merge(t)) for t in tokens]
    assert own.merge_all([]) == []


def test_full_memory_keeps_what_is_met_often(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 300)
    own, learnt = bpe.Encoder(bpe.load_ranks(PATH), public_tokenizers.PATTERN), []
    learn = own._learn
    monkeypatch.setattr(own, "_learn", lambda pieces: learnt.extend(pieces) or learn(pieces))
    rng = random.Random(3)
    for step in range(40):
        rare = ["".join(rng.choice("qxzjkvw") for _ in range(9)) for _ in range(100)]
        texts = [" zqxjoften" * 3 + " " + " ".join(rare), "z" * 100 + f" {step}", ""]
        assert [ids.tolist() for ids in own.encode_all(texts)] == list(map(library.encode_ordinary, texts))
        assert max(len(own.chunks), len(own.pieces)) <= 300
    assert learnt.count(" zqxjoften") == 1
    assert learnt.count("z" * 100) == 40  # not remembered


def test_a_failed_call_leaves_nothing_behind():
    own = bpe.Encoder({b"a": 0, b"b": 1, b"ab": 2}, public_tokenizers.PATTERN)
    with pytest.raises(KeyError):
        own.encode("aba cab")
    assert own.encode("aabb") == [0, 2, 1] and own.decode([0, 2, 1]) == b"aabb" and own.decode([]) == b""


def test_table(library, make):
    rows = [(1, "hello world"), (2, None), (3, ""), (None, "x"), (1, "hello world"), (4, "word " * 40_000)]
    got = bpe.encode_column(make(rows), PATH, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(t for i, t in rows if i == r["doc_id"] ) or ""
        ids = library.encode_ordinary(text)
        assert (r["n_tokens"], r["ids"]) == (len(ids), ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_column(make([]), PATH, public_tokenizers.PATTERN).count() == 0


def test_query_over_documents(spark, sf_dir, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = bpe.op2(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r["doc_id"]] or "")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
