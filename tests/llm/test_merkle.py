import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from wirelake.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def climb(nodes, fan):
    """All levels of one tree, the nodes first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + fan]) for i in range(0, len(levels[-1]), fan)])
    return levels


def siblings(levels, place, fan):
    out = []
    for nodes in levels[:-1]:
        first = place // fan * fan
        out.append((place - first, [d for i, d in enumerate(nodes[first : first + fan], first) if i != place]))
        place //= fan
    return out


def brute(rows, fan=16):
    """One tuple per row of (doc_id, source, lang, n_chars, text), by plain lists."""
    trees = {}
    for row in rows:
        trees.setdefault(row[1], []).append(row)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels, sorted_rows = {}, {}
    for source in order:
        sorted_rows[source] = sorted(trees[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        levels[source] = climb([leaf_of(r) for r in sorted_rows[source]], fan)
    top = climb([levels[s][-1][0] for s in order], fan)
    out = []
    for s, source in enumerate(order):
        for i, row in enumerate(sorted_rows[source]):
            path = siblings(levels[source], i, fan) + siblings(top, s, fan)
            claim = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                claim = (*row[:4], "".join(c.lower() if c.isascii() else c for c in row[4]))
            value = leaf_of(claim)
            for at, others in path:
                value = h(*others[:at], value, *others[at:])
            out.append((row[0], leaf_of(row), levels[source][-1][0], top[-1][0], h(*[x for _, o in path for x in o]), value, value == top[-1][0]))
    return sorted(map(repr, out))


def claimed():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0, {"text": F.translate("text", merkle.UPPER, merkle.LOWER)}


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, tree int, pos int, hash string, n int, pack int, claim int"


def got(spark, rows, **how):
    docs = spark.createDataFrame([(*r, "x", 1, 2, "y", 3, 4, 5) for r in rows], SCHEMA).repartition(3)
    done = merkle.manifest(docs, claimed(), **how)
    proof = F.sha2(F.concat_ws("", "proof"), 256)
    return sorted(map(repr, map(tuple, done.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", "verified").collect())))


@pytest.mark.parametrize("how", [{}, {"levels": 1}, {"fan": 2, "levels": 2}])
def test_against_plain_lists(spark, how):
    rows = [(i, None if i % 5 == 0 else "hot" if i % 3 else f"s{i % 40}", "en", i, f"Text {i} Ä") for i in range(700)]
    assert got(spark, rows, **how) == brute(rows, how.get("fan", 16))


def test_more_sources_than_one_superblock(spark):
    rows = [(i, f"source {i:04}", None, None, "") for i in range(300)] + [(i, "source 0007", "de", 3, "aBc") for i in range(40)]
    assert got(spark, rows, levels=1) == brute(rows)


def test_nulls_repeats_and_lone_leaves(spark):
    big = 2**53 + 1  # beyond what a double holds
    rows = [(1, "a", "en", 3, "ABC"), (1, "a", "en", 3, "ABC"), (None, "a", None, None, None), (None, "a", None, None, "x"),
            (big, None, None, 0, ""), (big + 1, "", "-", 1, "-"), (5, "é" * 9, "en", 200_000, "Long Text " * 20_000), (1, "a", "en", 3, "ABD")]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:1]) == brute(rows[:1])
    assert got(spark, [(k, "one", "en", 1, "X") for k in range(17)]) == brute([(k, "one", "en", 1, "X") for k in range(17)])


def test_no_rows(spark):
    assert got(spark, []) == []


def test_a_proof_can_be_checked_on_its_own(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "en", 1, "t") for i in range(100)], SCHEMA.split(", leaf")[0])
    for r in merkle.manifest(docs, levels=1).collect():
        assert merkle.fold(r["leaf"], r["proof"], r["places"]) == r["root"] and r["verified"]
        assert merkle.fold(merkle.digest("other"), r["proof"], r["places"]) != r["root"]
