"""Chat formatting: reply trees to root-to-leaf paths, each path one formatted conversation.

Messages know their parent. Self-joins that double the length of every message's link towards
its root find depth, root and summed score of all messages in a logarithm of the longest path;
the same links, taken from the longest to the shortest, spread each chosen leaf over its
ancestors. Only identifiers and numbers take part; texts join once, at the end.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from wirelake.llm import common

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Strings that steer a chat model; none of them survives unescaped inside a text.
CONTROL = (TURN, TEXT, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
#: Longest link is 2 ** ROUNDS messages; messages further from a root are in a cycle.
ROUNDS = 40


def escaped(text: Column) -> Column:
    """A backslash after the first character of each control string; backslashes are doubled."""
    inside = "(?s)(?=" + "|".join(re.escape(c) for c in CONTROL) + ")(.)"
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), inside, r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def linked(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Messages with ``root``, ``depth`` and summed ``score``, and the links of each round.

    ``messages`` has node (unique), parent and score. A parent that is null or absent makes its
    message a root. Messages of a cycle have no root and are left out.
    """
    spark = messages.sparkSession
    known = messages.select(F.col("node").alias("_known"))
    state = common.written(
        messages.join(known, F.col("parent") == F.col("_known"), "left").select(
            "node",
            F.col("_known").alias("jump"),
            F.col("node").alias("root"),
            F.lit(1).cast("bigint").alias("depth"),
            F.coalesce("score", F.lit(0.0)).cast("double").alias("score"),
        ),
        "links",
    )
    finished, levels = [state.filter("jump IS NULL")], []
    active = state.filter("jump IS NOT NULL")
    while len(levels) < ROUNDS and active.limit(1).count():
        levels.append(active.select("node", "jump"))
        up = reduce(DataFrame.unionByName, finished, active)
        up = up.select(*[F.col(c).alias(f"_{c}") for c in up.columns])
        moved = common.written(
            active.join(up, F.col("jump") == F.col("_node")).select(
                "node",
                F.col("_jump").alias("jump"),
                F.col("_root").alias("root"),
                (F.col("depth") + F.col("_depth")).alias("depth"),
                (F.col("score") + F.col("_score")).alias("score"),
            ),
            "links",
        )
        finished.append(moved.filter("jump IS NULL"))
        active = moved.filter("jump IS NOT NULL")
    return reduce(DataFrame.unionByName, finished).drop("jump"), levels


def paths(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """(leaf, root, node, depth) for every message on the path of a chosen leaf.

    The leaves of a tree are ranked by the summed score of their path, then the longer path, then
    the leaf; ``branches`` keeps the best of each tree, None keeps all.
    """
    reached, levels = linked(messages)
    parents = messages.select(F.col("parent").alias("node")).filter("node IS NOT NULL").distinct()
    leaves = reached.join(parents, "node", "left_anti")
    if branches is not None:
        best = W.partitionBy("root").orderBy(F.desc("score"), F.desc("depth"), "node")
        leaves = leaves.withColumn("_rank", F.row_number().over(best)).filter(F.col("_rank") <= branches)
    on_path = leaves.select(F.col("node").alias("leaf"), "node")
    for level in reversed(levels):
        up = on_path.join(level, "node").select("leaf", F.col("jump").alias("node"))
        on_path = common.written(on_path.unionByName(up), "path")  # else the plan doubles each time
    return on_path.join(reached.select("node", "root", "depth"), "node")


def formatted(on_path: DataFrame, texts: DataFrame) -> DataFrame:
    """One row per leaf: ``formatted`` text and ``mask``, the byte spans of assistant texts in it.

    ``texts`` has node, role and text; a null role or text counts as empty. Spans are in UTF-8
    bytes, so that cutting one out does not walk over the text before it.
    """
    piece = F.concat(F.lit(TURN), "_role", F.lit(TEXT), "_text", F.lit(END))
    turns = on_path.join(texts, "node").select(
        "leaf",
        "depth",
        (F.col("role") == "assistant").alias("_learn"),
        escaped(F.coalesce("role", F.lit(""))).alias("_role"),
        escaped(F.coalesce("text", F.lit(""))).alias("_text"),
    )
    turns = turns.withColumn("_piece", piece)
    before = W.partitionBy("leaf").orderBy("depth").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.octet_length("_piece").cast("bigint")).over(before), F.lit(0))
    lead = F.octet_length("_role") + len((TURN + TEXT).encode())
    turns = turns.withColumn("_start", start).select(
        "leaf",
        F.struct(
            "depth",
            "_piece",
            F.when(
                F.col("_learn"),
                F.struct((F.col("_start") + lead).alias("start"), F.octet_length("_text").cast("bigint").alias("bytes")),
            ).alias("span"),
        ).alias("_turn"),
    )
    rows = turns.groupBy("leaf").agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
    return rows.select(
        "leaf",
        F.array_join(F.transform("_turns", lambda t: t["_piece"]), "").alias("formatted"),
        F.filter(F.transform("_turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("mask"),
    )


def turns_of(text: Column) -> Column:
    """The (role, text) turns read back from a formatted conversation."""
    pieces = F.split(text, re.escape(END))

    def parse(piece: Column) -> Column:
        parts = F.split(piece, re.escape(TEXT), 2)
        role = F.replace(parts[0], F.lit(TURN), F.lit(""))
        return F.struct(unescaped(role).alias("role"), unescaped(parts[1]).alias("text"))

    return F.transform(F.filter(pieces, lambda p: p != ""), parse)


def learnt_text(text: Column, mask: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""

    def cut(raw: Column) -> Column:
        return F.transform(
            mask, lambda s: unescaped(F.decode(F.substring(raw, (s["start"] + 1).cast("int"), s["bytes"].cast("int")), "UTF-8"))
        )

    return F.array_join(common.once(F.encode(text, "UTF-8"), cut), "")


def chat_trees(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """Format the chosen paths of reply trees: leaf, formatted, mask.

    ``messages`` has node, parent, score, role and text, one row per node; further columns are
    ignored. An empty table gives no rows, a lone message a conversation of one turn.
    """
    return formatted(paths(messages.select("node", "parent", "score"), branches), messages.select("node", "role", "text"))


def replies(conversations: DataFrame) -> DataFrame:
    """Linear conversations as reply trees: each row answers the one before it.

    Rows go by turn, then role and text, nulls first; repeated rows are turns of their own. Rows
    without a conv_id form one conversation.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("_n", F.row_number().over(order))
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("-"))
    return common.written(
        rows.select(
            "conv_id",
            F.concat(key, F.lit(":"), "_n").alias("node"),
            F.when(F.col("_n") > 1, F.concat(key, F.lit(":"), F.col("_n") - 1)).alias("parent"),
            F.lit(0.0).alias("score"),
            "role",
            "text",
        ),
        "replies",
    )


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = common.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame(
        [(-1, 0, "user", says), (-1, 1, "assistant", says)], "conv_id bigint, turn bigint, role string, text string"
    )
    messages = replies(given.unionByName(probe))
    done = chat_trees(messages).select(
        F.col("leaf"),
        F.substring_index("leaf", ":", 1).alias("_key"),
        "formatted",
        turns_of(F.col("formatted")).alias("turns"),
        learnt_text(F.col("formatted"), F.col("mask")).alias("learnt"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        F.when(F.col("_key") != "-", F.col("_key")).cast("bigint").alias("conv_id"),
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("learnt", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op1_sql() -> str:
    """The digests of all conversations from the rows alone."""
    marks = len(TURN) + len(TEXT) + len(END)

    def grown(column: str) -> str:
        found = " + ".join(
            f"(length({column}) - length(replace({column}, '{c}', ''))) / {len(c)}" for c in (*CONTROL, "\\")
        )
        return f"length({column}) + {found}"

    return f"""
    WITH rows AS (
      SELECT conv_id, turn, role, text FROM conversations
      UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
      UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), clean AS (
      SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n,
             coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM rows
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum({grown('role')} + {grown('text')} + {marks}) AS BIGINT) AS formatted_chars
    FROM clean GROUP BY conv_id"""
