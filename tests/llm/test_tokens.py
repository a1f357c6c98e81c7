import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wirelake.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    own = Tokenizer.from_file(PATH)
    own.encode_special_tokens = True
    return own


def test_random_texts(library):
    rng, own = random.Random(1), tokens.words(PATH)
    letters = "ab E\n\t \xa0 \x1c\x85'sS1２!é漢🙂́\r\x0b​<|>İΣσǰK"
    for _ in range(6000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 25)))
        assert np.frombuffer(own.encode(text.encode()), "<i4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def check(got, rows, library):
    start = 0
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted(-1 if i is None else i for i, _ in rows)
    left = sorted(((-1 if i is None else i, [*library.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows), key=lambda r: r[0])
    for i, first, n, crc in got:
        mine = next(k for k, (j, ids) in enumerate(left) if j == i and zlib.crc32(np.array(ids, "<u4").tobytes()) == crc)
        assert (first, n) == (start, len(left.pop(mine)[1]))
        start += n


def test_files(spark, make, tmp_path, library):
    rows = [(9, "nine"), (1, None), (2, ""), (None, "none"), (5, "same"), (5, "other"), (5, "same"), (7, "<|endoftext|> x"), (3, "long word " * 30_000)]
    path = str(tmp_path / "ids")
    tokens.write_tokens(make(rows), PATH, path)
    check(tokens.with_checksums(tokens.read_tokens(spark, path)).collect(), rows, library)
    some = tokens.read_tokens(spark, path, 5, 8).collect()
    assert sorted(r["doc_id"] for r in some) == [5, 5, 5, 7]
    whole = {(r["doc_id"], r["start"]): r["ids"] for r in tokens.read_tokens(spark, path).collect()}
    assert all(whole[r["doc_id"], r["start"]] == r["ids"] for r in some)


def test_metadata_is_read_alone(spark, make, tmp_path):
    path = str(tmp_path / "ids")
    tokens.write_tokens(make([(1, "a b"), (2, "c")]), PATH, path)
    plan = tokens.read_tokens(spark, path, 2, 2).select("doc_id", "start")._jdf.queryExecution().executedPlan().toString()
    assert "ids#" not in plan.split("ReadSchema")[1] and "GreaterThanOrEqual(doc_id,2)" in plan


def test_empty(spark, make, tmp_path):
    tokens.write_tokens(make([]), PATH, str(tmp_path / "ids"))
    assert tokens.read_tokens(spark, str(tmp_path / "ids")).count() == 0


def test_query(spark, sf_dir, library):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    check(tokens.op5(spark, sf_dir).collect(), rows, library)


def test_added_tokens_match_as_in_the_library(spark, make, folder):
    default, own, rng = Tokenizer.from_file(PATH), tokens.words(PATH), random.Random(2)
    assert np.frombuffer(own.encode_added(b"hello <|endoftext|> world"), "<i4").tolist() == [3306, 49407, 1002]
    parts = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "<|", " ", "\n", "a", "E", "é", "\u0301", "'s", "1", "漢"]
    for _ in range(6000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(own.encode_added(text.encode()), "<i4").tolist() == default.encode(text, add_special_tokens=False).ids, repr(text)
    rows = [(1, "hello <|endoftext|> world"), (2, "x<|startoftext|><|startoftext|>"), (3, "plain")]
    check(tokens.op5(spark, folder(documents=make(rows))).collect(), rows, default)


def test_other_added_tokens_are_left_to_the_library(tmp_path):
    from tokenizers import AddedToken

    own, path = Tokenizer.from_file(PATH), str(tmp_path / "own.json")
    own.add_tokens([AddedToken("HeLLo", normalized=True), AddedToken("<x>", lstrip=True, single_word=True)])
    own.save(path)
    for text in ("hello Hello you", "a <x> b", "a<x>b"):
        assert np.frombuffer(tokens.words(path).encode_added(text.encode()), "<i4").tolist() == own.encode(text, add_special_tokens=False).ids
