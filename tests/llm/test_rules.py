import re

from pyspark.sql import functions as F

from wirelake.llm import rules

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = {}
    for i in range(len(w) - 7):
        windows.setdefault(tuple(w[i : i + 8]), []).append(i)
    inside = {p for at in windows.values() if len(at) > 1 for i in at for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside)


ROWS = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one two three four five six seven eight"), (5, "a " * 9), (6, "a b c d e f g h " * 2),
    (7, "x\nx\n \n \nx\ny|#\n"), (8, "é\xa0ü 漢 🙂 # $ %&|<>*"), (9, "w " * 50_000), (10, "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 0 2 3 4 5 6 7 8 9"), (None, "a b"),
    (4, "one two three four five six seven eight"), (11, "\x1c\x85   x"), (12, "a\rb\nc\r\n" * 5),
]


def test_statistics(make):
    got = rules.statistics(make(ROWS)).select("text", "_stats.*").collect()
    assert len(got) == len(ROWS)
    for r in got:
        assert tuple(r[n] for n in rules.BASE) == brute(r["text"]), repr(r["text"])[:80]


def test_judging_keeps_columns_and_applies_rules(make):
    docs = make(ROWS)
    rule = (rules.Condition("symbols_per_word", True, 0.5), rules.Condition("n_words", True, 3.0))
    got = rules.judged(docs, [rule]).collect()
    assert len(got) == len(ROWS)
    for r in got:
        words, _, symbols, _, repeated = brute(r["text"])
        failed = words < 20 or 100 * repeated > 30 * words
        assert (r["_base_failed"], r["_kept"]) == (failed, not failed and not (symbols > 0.5 * words and words > 3))
    assert rules.judged(make([]), []).count() == 0


def test_no_python_runs_on_rows(make):
    plan = rules.judged(make(ROWS), [(rules.Condition("n_words", True, 3.0),)])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_learning_finds_thresholds():
    base = dict.fromkeys(rules.FEATURES, 0.0)
    rows = [base | {"symbols_per_word": i / 100, "word_length": (i * 37 % 100) / 10, "bad": i > 70 or (i * 37 % 100) > 90} for i in range(100)] * 5
    found = rules.learn(rows)
    right = sum(any(rules.covers(r, x) for r in found) == x["bad"] for x in rows)
    assert found and right >= 0.95 * len(rows)
    assert rules.learn([base | {"bad": False}] * 50) == [] and rules.learn([]) == []


def test_verdict_in_spark_equals_the_learner(spark):
    rule = (rules.Condition("repeat_share", True, 0.25), rules.Condition("word_length", False, 4.0))
    names = sorted(set(re.findall(r"n_\w+|word_chars", " ".join(rules.FEATURES.values()))))
    rows = [tuple((i * k) % 17 for k in range(3, 3 + len(names))) for i in range(50)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} bigint" for n in names))
    values = [F.expr(e).cast("double").alias(n) for n, e in rules.FEATURES.items()]
    for r in df.select(*values, rules.verdict([rule]).alias("keep")).collect():
        assert r["keep"] != rules.covers(rule, r.asDict())


def test_no_labels(spark, make):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert rules.quality_rules(make(ROWS), labels).filter("_kept = _base_failed").count() == 0


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = rules.op9(spark, sf_dir).collect()
    assert {r["doc_id"]: tuple(r[n] for n in rules.BASE) for r in got} == {i: brute(t) for i, t in texts.items()}
    judged = [(quality[r["doc_id"]], r["kept"]) for r in got if quality.get(r["doc_id"]) is not None and not r["base_failed"]]
    assert sum(q == k for q, k in judged) >= 0.97 * len(judged)
