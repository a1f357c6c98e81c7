"""Quality rules as a learned decision list over text statistics.

Sequential covering: a rule is grown, one threshold condition after another, on two thirds of the
labelled rows and pruned on the rest; the bad rows it covers are taken out and the next rule is
grown. The list becomes one ordered Spark conditional expression.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wirelake.llm import common

#: Labelled rows that the list is learned from, at most; the least hashes of their doc_id.
LABELLED_ROWS = 6_000
#: Fewest bad rows a rule must cover, and the share of bad rows it must reach where it is pruned.
LEAST_COVER, LEAST_PRECISION = 8, 0.97
MOST_RULES, MOST_CONDITIONS, THRESHOLDS = 12, 3, 24

WINDOW_WORDS = 8
WORD = rf"[^{common.SPACE}]+"
SYMBOLS = "#*$%&|<>"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Ratios the rules may test; each is a number for every row.
FEATURES = {
    "n_words": "CAST(n_words AS DOUBLE)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_line": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "same_as_before": "n_same_as_before / greatest(n_words, 1)",
    "exclaims_per_word": "n_exclaims / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def _both(a: Column, b: Column) -> Column:
    return F.xxhash64(a, b)


def _paired(by: int) -> Callable[[Column], Column]:
    """Each element with the one ``by`` places on; the last ones meet null."""
    return lambda x: F.zip_with(x, F.slice(x, by + 1, F.size(x)), _both)


def repeat_words(hashes: Column) -> Column:
    """Words inside windows of eight words that occur twice or more; from the hash of each word.

    Windows are compared by a 64-bit hash of their words' hashes. Equal hashes meet by sorting; only
    texts with a repeated window pay for that.
    """

    def with_windows(h: Column) -> Column:
        wide, width = h, 1
        while width < WINDOW_WORDS:  # hashes of 2, 4 and 8 words, each from two of the half
            wide = common.once(wide, _paired(width))
            width *= 2
        return common.once(F.slice(wide, 1, F.greatest(F.size(h) - (WINDOW_WORDS - 1), F.lit(0))), covered)

    def covered(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            common.once(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), repeated)
        )

    def repeated(s: Column) -> Column:
        def seen(p: Column, k: Column) -> Column:
            return F.when(
                (F.get(s, k - 1)["h"] == p["h"]) | (F.get(s, k + 1)["h"] == p["h"]), p["i"]
            )

        at = F.sort_array(F.filter(F.transform(s, seen), lambda i: i.isNotNull()))
        return common.once(
            at,
            lambda a: F.aggregate(
                F.zip_with(a, F.slice(a, 2, F.size(a)), lambda i, j: F.least(F.lit(WINDOW_WORDS), F.coalesce(j - i, F.lit(WINDOW_WORDS)))),
                F.lit(0),
                lambda x, y: x + y,
            ),
        )

    return with_windows(hashes)


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the struct ``_stats``; a null text counts as empty."""
    text = F.coalesce("text", F.lit(""))

    def of_text(t: Column) -> Column:
        return common.once(
            F.struct(F.regexp_extract_all(t, F.lit(WORD), 0).alias("w"), F.split(t, "\n", -1).alias("l"), t.alias("t")),
            of_parts,
        )

    def of_parts(p: Column) -> Column:
        lines = F.filter(p["l"], lambda line: F.btrim(line, F.lit(common.SPACE_CHARS)) != "")
        hashes = F.transform(p["w"], lambda x: F.xxhash64(x))
        return common.once(F.struct(lines.alias("l"), hashes.alias("h")), lambda q: of_all(p, q["l"], q["h"]))

    def of_all(p: Column, lines: Column, hashes: Column) -> Column:
        words, t = p["w"], p["t"]
        same = F.filter(F.zip_with(hashes, F.slice(hashes, 2, F.size(hashes)), lambda a, b: a.eqNullSafe(b)), lambda x: x)
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.array_join(words, "")).cast("bigint").alias("word_chars"),
            (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            repeat_words(hashes).cast("bigint").alias("n_repeat_words"),
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.length(t) - F.length(F.replace(t, F.lit("!"), F.lit("")))).cast("bigint").alias("n_exclaims"),
            F.size(same).cast("bigint").alias("n_same_as_before"),
        )

    return docs.withColumn("_stats", common.once(text, of_text))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    bound: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.bound if self.above else row[self.feature] <= self.bound

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.bound!r}D"


Rule = tuple[Condition, ...]


def covers(rule: Rule, row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _candidates(rows: Sequence[dict]) -> list[Condition]:
    """Both sides of up to ``THRESHOLDS`` quantile midpoints of each feature."""
    out = []
    for name in FEATURES:
        values = sorted({r[name] for r in rows})
        step = max(1, len(values) // THRESHOLDS)
        for a, b in zip(values[step - 1 :: step], values[step::step]):
            out += [Condition(name, above, (a + b) / 2) for above in (True, False)]
    return out


def _grown(rows: list[dict]) -> Rule:
    """Conditions added by FOIL gain until only bad rows are covered."""
    rule: list[Condition] = []
    while len(rule) < MOST_CONDITIONS and any(not r["bad"] for r in rows):
        bad = sum(r["bad"] for r in rows)
        best, gain, left = None, 0.0, []
        before = math.log2(bad / len(rows)) if bad else 0.0
        for c in _candidates(rows):
            inside = [r for r in rows if c.holds(r)]
            hit = sum(r["bad"] for r in inside)
            if hit and (g := hit * (math.log2(hit / len(inside)) - before)) > gain:
                best, gain, left = c, g, inside
        if best is None:
            break
        rule.append(best)
        rows = left
    return tuple(rule)


def _worth(rule: Rule, rows: list[dict]) -> float:
    inside = [r for r in rows if covers(rule, r)]
    bad = sum(r["bad"] for r in inside)
    return (2 * bad - len(inside)) / max(len(inside), 1)


def learn(rows: list[dict]) -> list[Rule]:
    """The decision list: conjunctions whose rows are rejected, in order.

    ``rows`` hold the features and ``bad``. Every third row prunes: conditions at the end of a
    rule go while that raises the share of bad rows it covers there. Learning ends at the first
    rule that covers too few bad rows or too many others.
    """
    rules: list[Rule] = []
    left = rows
    while len(rules) < MOST_RULES:
        grow, prune = [r for i, r in enumerate(left) if i % 3], left[::3]
        if not any(r["bad"] for r in grow):
            break
        rule = _grown(grow)
        rule = max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (_worth(r, prune), -len(r)), default=())
        inside = [r for r in left if rule and covers(rule, r)]
        bad = sum(r["bad"] for r in inside)
        if bad < LEAST_COVER or bad < LEAST_PRECISION * len(inside):
            break
        rules.append(rule)
        left = [r for r in left if not covers(rule, r)]
    return rules


def verdict(rules: Sequence[Rule]) -> Column:
    """The first rule whose conditions hold rejects the row; no rule: it is kept."""
    if not rules:
        return F.lit(True)
    cases = " ".join(f"WHEN {' AND '.join(c.sql() for c in rule)} THEN {n}" for n, rule in enumerate(rules, 1))
    return F.expr(f"CASE {cases} ELSE 0 END = 0")


def labelled(docs: DataFrame, labels: DataFrame, most: int = LABELLED_ROWS) -> list[dict]:
    """Features of up to ``most`` labelled rows, for the learner; null labels do not count."""
    chosen = (
        labels.filter("quality IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").alias("_quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most `most` rows
    values = statistics(rows).select("doc_id", "_quality", "_stats.*").select(
        "doc_id", (F.col("_quality") == 0).alias("bad"), *[F.expr(e).cast("double").alias(f"f_{n}") for n, e in FEATURES.items()]
    )
    found = values.orderBy(F.xxhash64("doc_id"), *[f"f_{n}" for n in FEATURES]).limit(most).collect()
    return [{"bad": r["bad"]} | {n: r[f"f_{n}"] for n in FEATURES} for r in found]


def judged(docs: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``docs`` with ``_stats``, ``_base_failed`` and ``_kept``.

    Empty and null texts have no words and fail the base rule; repeated rows are judged alike; an
    empty table gives no rows. Columns named n_words and the like may be among the documents'.
    """
    base = (F.col("_s.n_words") < 20) | (100 * F.col("_s.n_repeat_words") > 30 * F.col("_s.n_words"))
    inner = statistics(docs).select(F.struct(*docs.columns).alias("_doc"), F.col("_stats").alias("_s"))
    tested = inner.select("_doc", "_s", "_s.*").select("_doc", "_s", base.alias("_failed"), verdict(rules).alias("_pass"))
    return tested.select(
        "_doc.*",
        F.col("_s").alias("_stats"),
        F.col("_failed").alias("_base_failed"),
        (~F.col("_failed") & F.col("_pass")).alias("_kept"),
    )


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn the list from ``labels`` and judge every document with it."""
    return judged(docs, learn(labelled(docs, labels)))


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    done = quality_rules(docs, common.table(spark, sf_dir, "labels"))
    return done.select("doc_id", *[F.col(f"_stats.{n}").alias(n) for n in BASE], F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))
