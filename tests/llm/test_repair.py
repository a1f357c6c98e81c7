import hashlib
import re
import zlib

import pytest
from pyspark.sql import functions as F

from wirelake.llm import repair as R

SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if lot == 0:
            continue
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        out += [(conv, turn, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    return out


def cheapest(symbols):
    """The best (cost, audit, output) by trying every edit at every row; output has (initial, row) or (initial, None)."""
    legal = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserts(best):
        """States reached by more and more insertions."""
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                after = "a" if state == "u" else "u"
                option = (cost + 5, audit + "I", out + [(after, None)])
                if after not in best or option[:2] < best[after][:2]:
                    best[after] = option
        return best

    best = {"": (0, "", [])}
    for i, (initial, fault) in enumerate(symbols):
        found = {}
        extra = 5 if fault == "truncated" else 0
        for state, (cost, audit, out) in inserts(dict(best)).items():
            options = [(state, (cost + 2, audit + "D", out))]
            if fault not in ("blank", "duplicate"):
                if initial and initial in legal[state]:
                    options.append((initial, (cost + extra, audit + "K", out + [(initial, i)])))
                for other in "ua":
                    if other in legal[state]:
                        options.append((other, (cost + 1 + extra, audit + "R", out + [(other, i)])))
            for after, option in options:
                if after not in found or option[:2] < found[after][:2]:
                    found[after] = option
        best = found
    best = inserts(dict(best))
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def brute(rows, spoil=True):
    convs = {}
    for row in damage(rows) if spoil else rows:
        convs.setdefault(row[0], []).append(row)
    out = []
    for conv in {r[0] for r in rows}:
        mine = sorted(convs.get(conv, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2].encode())}:{r[2]}{r[3]}".encode()).digest()))
        seen, symbols, faults = set(), [], []
        for _, _, role, text in mine:
            fault = None
            if not text.strip(SPACE):
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif text.rstrip(SPACE)[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            faults.append(fault)
            symbols.append((role[:1], fault))
        cost, audit, kept = cheapest(symbols)
        names = {"u": "user", "a": "assistant"}
        lines = []
        for initial, i in kept:
            role, text = (names[initial], "") if i is None else (mine[i][2] if mine[i][2][:1] == initial else names[initial], mine[i][3])
            lines.append(f"{role}:{text}")
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [s[0] for s in symbols]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, *[faults.count(f) for f in R.FAULTS], illegal, cost, audit, digest))
    return sorted(map(repr, out))


SCHEMA = "conv_id bigint, turn bigint, role string, text string, row string, pos int, start int, fault string, copy int, lot int, same int, n int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", 1, 2, "f", 3, 4, 5, 6) for r in rows], SCHEMA).repartition(4)


def got(df):
    names = ("conv_id", "gaps", *R.FAULTS, "illegal", "cost", "audit", "repaired_sha256")
    return sorted(map(repr, map(tuple, df.select(*names).collect())))


def rows_of(seed, convs, length, roles=("system", "user", "assistant", "tool", "")):
    import random

    rng = random.Random(seed)
    texts = ["Yes.", "No!", "So it is", "", " \t", "Why? ", "é.", "x" * 50 + "."]
    return [
        (c, t, rng.choice(roles), f"{rng.choice(texts)}" if rng.random() < 0.5 else f"Line {rng.random()}.")
        for c in range(convs) for t in range(rng.randrange(1, length))
    ]


def test_op12_against_brute_force(spark, folder):
    rows = rows_of(1, 120, 14) + [(500, t, "user", "Hm.") for t in range(60)] + [(501, t, ["user", "assistant"][t % 2], f"{t}.") for t in range(90)]
    path = folder(conversations=table(spark, rows))
    assert got(R.op12(spark, path)) == brute(rows)


def test_nulls_ties_and_dropped_conversations(spark, folder):
    rows = rows_of(2, 4, 6) + [
        (None, None, None, None), (None, 3, "user", "a."), (None, 3, "user", "a."), (None, 3, "assistant", "b."),
        (60, None, "user", "q."), (60, None, "assistant", None), (60, -4, None, "z."), (60, 7, "user", "Long " * 100_000 + "."),
    ]
    lone = next(c for c in range(1000, 9000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    rows.append((lone, 1, "user", "Gone."))
    path = folder(conversations=table(spark, rows))
    assert got(R.op12(spark, path)) == brute(rows)


def test_no_rows(spark, folder):
    assert got(R.op12(spark, folder(conversations=table(spark, [])))) == []


def test_a_conversation_of_many_blocks(spark):
    rows = [(7, t, ["user", "user", "assistant", "tool"][t * t % 4], "Same." if t % 5 == 0 else f"{t}" + "." * (t % 3)) for t in range(400)]
    rows += [(8, t, "assistant", f"Only {t}.") for t in range(100)] + [(9, 0, "system", "Be brief."), (9, 1, "user", "x.")]
    df = table(spark, rows)
    done = R.summaries(R.repair(df, block_rows=16)).withColumn("conv_id", F.col("conv").cast("bigint"))
    assert got(done) == brute(rows, spoil=False)


@pytest.mark.parametrize("seed", range(6))
def test_tables_of_runs_equal_single_steps(seed):
    import random

    rng = random.Random(seed)
    symbols = []
    for _ in range(rng.randrange(1, 12)):
        symbols += [(rng.choice(["s", "u", "a", "t", ""]), rng.choice(["", "", "truncated", "blank", "duplicate"]))] * rng.choice([1, 1, 2, 3, 7, 20])
    edits, last = R.block_edits(symbols, R.START, None)
    cost, audit, _ = cheapest(symbols)
    assert "".join(edits) + "I" * R._FINISH[last] == audit
    table = R.block_table(R.segments(symbols))
    assert min(c + R.FINISH[s] for s, (c, _, _) in table[R.START].items()) == cost
    assert len(R.segments([("u", "")] * 1_000_000)) <= 20


def test_the_rows_show_what_was_done(spark):
    df = table(spark, [(1, 0, "assistant", "Hi."), (1, 1, "user", "Q?"), (1, 2, "user", ""), (2, 0, "user", "Q?"), (3, 0, "user", "Q"), (3, 1, "user", "A.")])
    rows = {(r["conv_id"], r["turn"]): (r["fault"], r["edits"], r["before"], r["becomes"], r["after"]) for r in R.repair(df).collect()}
    assert rows == {
        (1, 0): (None, "R", "", "u", ""), (1, 1): (None, "R", "", "a", ""), (1, 2): ("blank", "D", "", None, ""),
        (2, 0): (None, "D", "", None, ""), (3, 0): ("truncated", "D", "", None, ""), (3, 1): (None, "D", "", None, ""),
    }
    long = [(4, t, ["user", "assistant"][t > 3], f"{t}.") for t in range(8)]
    after = [r["edits"] for r in R.repair(table(spark, long)).orderBy("turn").collect()]
    assert "".join(after) == cheapest([(r[2][0], None) for r in long])[1]
