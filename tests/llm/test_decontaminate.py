import re

import pytest

from wirelake.llm import decontaminate

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short item, HERE"), (3, None), (4, ""), (5, "?!"),
    (10, "one two three four five six seven eight nine ten"), (11, "one two three four five six seven eight nine ten"),
    (12, "é ü ñ"), (None, "nobody asked"), (13, "ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty one two"),
]
DOCS = [
    (1, "xx alpha BETA gamma-delta epsilon zeta eta theta iota kappa lambda mu yy"), (2, "beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (3, "alpha beta gamma delta epsilon zeta eta theta iota"), (4, "a short item here. short item here short item"), (5, None), (6, ""),
    (7, "É ü ñ x é ü ñ"), (8, "zero one two three four five six seven eight nine ten eleven " * 3), (None, "short item here"), (4, "short item, here"),
    (9, "item here"), (10, "short"), (11, "item here short item"), (12, "word " * 100_000 + " short item here"), (13, "nobody asked"),
]


def brute(docs, items, window=10):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    tests = []
    for i, t in items:
        w = words(t)
        if i is not None:
            tests += [(i, w[k : k + window]) for k in range(max(len(w) - window, 0) + 1) if w]
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for i, g in tests:
            for k in range(len(w) - len(g) + 1):
                if w[k : k + len(g)] == g:
                    hit.update(range(k, k + len(g)))
                    found.add(str(i))
        out.append((d if d is not None else -1, len(w), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(out)


def rows(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["item_ids"], r["contaminated"]) for r in df.collect())


@pytest.mark.parametrize("pass_bytes", [1, 8 << 20])
def test_brute_force(spark, make, monkeypatch, pass_bytes):
    monkeypatch.setattr(decontaminate, "PASS_BYTES", max(pass_bytes, 60))
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert rows(decontaminate.decontamination(make(DOCS), items)) == brute(DOCS, ITEMS)


def test_matches_have_places(spark, make):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    text = "Zwölf: " + ITEMS[0][1] + "!"
    found = [r for r in decontaminate.longest_matches(make([(1, text)]), items).collect() if r["item_id"] is not None]
    assert [(r["item_id"], r["start"], r["words"]) for r in found] == [(1, 1, 12)]
    assert text.encode()[found[0]["from_byte"] : found[0]["to_byte"]].decode() == ITEMS[0][1]


def test_clean_documents(spark, make):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    docs = make(DOCS)
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns
    wanted = {(d, n) for d, n, _, _, _, bad in brute(DOCS, ITEMS) if not bad}
    assert {(r["doc_id"], len(WORD.findall(r["text"] or ""))) for r in kept.collect()} == wanted


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert rows(decontaminate.decontamination(make(DOCS), none)) == brute(DOCS, [])
    assert decontaminate.decontamination(make([]), spark.createDataFrame(ITEMS, none.schema)).count() == 0
    assert decontaminate.clean_documents(make(DOCS), none).count() == len(DOCS)
