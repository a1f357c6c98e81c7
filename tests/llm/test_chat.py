import hashlib
import random

from wirelake.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, node string"
SAYS = "</s>[INST] ok [/INST]"


def expected(rows):
    by = {}
    for conv, turn, role, text, *_ in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in by.items():
        turns = [(t[3], t[5]) for t in sorted(turns)]
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        learnt = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


def test_query_on_odd_conversations(spark, folder):
    rng = random.Random(3)
    odd = ["", None, "\\", "\\n", "a\\", "<|end|>", "<|end|><|turn|>x", "<</SYS>>\\<s>", "é漢🙂</s>", "[INST][/INST]", "<|<|text|>|>", "x" * 50_000]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "", "a\nb", "<|text|>"]), rng.choice(odd), "n") for c in range(40) for t in range(rng.randint(1, 12))]
    rows += [(50, None, "user", "no turn", "n"), (50, 1, "assistant", "x", "n"), (51, 1, "user", "tie", "n"), (51, 1, "user", "tie", "n"), (51, 1, "assistant", "tie", "n")]
    rows += [(None, t, "assistant", "nobody's", "n") for t in range(3)]
    rows += [(99, t, "user" if t % 2 else "assistant", f"turn {t}", "n") for t in range(300)]
    got = chat.op1(spark, folder(conversations=spark.createDataFrame(rows, SCHEMA)))
    found = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in got.collect()}
    assert found == expected(rows + [(-1, 0, "user", SAYS), (-1, 1, "assistant", SAYS)])


def test_query_on_an_empty_table(spark, folder):
    got = chat.op1(spark, folder(conversations=spark.createDataFrame([], SCHEMA))).collect()
    assert [(r["conv_id"], r["n_turns"], r["loss_chars"]) for r in got] == [(-1, 2, len(SAYS))]


def test_trees_rank_their_branches(spark):
    rows = [
        ("a", None, 1.0, "user", "root"), ("b", "a", 1.0, "assistant", "left"), ("c", "a", 5.0, "assistant", "right"),
        ("d", "b", 9.0, "user", "left left"), ("e", "c", None, "user", "right right"), ("f", "gone", 2.0, "user", "orphan"),
        ("x", "y", 1.0, "user", "cycle"), ("y", "x", 1.0, "user", "cycle"),
    ]
    messages = spark.createDataFrame(rows, "node string, parent string, score double, role string, text string")
    best = {r["leaf"]: r["formatted"] for r in chat.chat_trees(messages, branches=1).collect()}
    assert sorted(best) == ["d", "f"]
    assert best["d"] == "".join(f"<|turn|>{r}<|text|>{t}<|end|>" for r, t in (("user", "root"), ("assistant", "left"), ("user", "left left")))
    assert {r["leaf"] for r in chat.chat_trees(messages).collect()} == {"d", "e", "f"}
    assert chat.chat_trees(messages.limit(0)).count() == 0


def test_no_control_string_survives(spark):
    text = "".join(chat.CONTROL) + "\\" + "".join(chat.CONTROL)
    messages = spark.createDataFrame([("a", None, 0.0, "user", text)], "node string, parent string, score double, role string, text string")
    row = chat.chat_trees(messages).first()
    assert all(row["formatted"].count(c) == (c in (chat.TURN, chat.TEXT, chat.END)) for c in chat.CONTROL)
