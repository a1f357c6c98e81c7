"""The training-text pipeline: each stage takes the documents that the one before it kept.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and gives the rows
that go on, with the columns of ``documents``. The last gives token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wirelake.llm import bpe, common, decontaminate, jaccard, rules, suffix_dedup
from wirelake.session import run_folder
from wirelake.sources import files


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned decision list keep."""
    done = rules.quality_rules(docs, common.table(spark, sf_dir, "labels"))
    return done.filter("_kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word-shingle sets with a similarity of 0.8 or more.

    A document is a row's doc_id and text (told apart by 64 bits of a hash), so rows that share a
    doc_id but not their text are two. The one with the least doc_id stays, one without an id only
    if no other has one; rows that repeat both are one.
    """
    key = common.unused(docs, "_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    linked = jaccard.jaccard_join(keyed.select(F.col(key).alias("doc_id"), "text"), n=5, percent=80)
    ids = keyed.select(F.col(key).alias("key"), F.col("doc_id").cast("bigint").alias("id")).distinct()
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key")
    first = (
        linked.select(F.col("doc_id").alias("key"), "component_id").distinct().join(ids, "key")
        .groupBy("component_id").agg(F.min(order).alias("first")).select(F.col("first.key").alias(key))
    )
    kept = keyed.join(first.hint("merge"), key, "left_semi").dropDuplicates([key, "doc_id"])
    return kept.select(*docs.columns)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 50-byte strings that an earlier document has; no row goes."""
    return suffix_dedup.without_repeats(docs).withColumn("n_chars", F.length("text").cast("bigint"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten-word window of the benchmark."""
    return decontaminate.clean_documents(docs, common.table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, digests and ids of what is left."""
    import public_tokenizers

    return bpe.encode_column(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("suffix-array dedup", repeated_spans),
    ("benchmark decontamination", decontaminated),
    ("byte-level BPE", token_ids),
]

#: No stage but the join and the decontamination has a form in SQL; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; of the others' only those that the next stage reads are kept meanwhile."""
    docs, read = common.table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = run_folder(spark, "stage")
        docs = common.written(stage(spark, docs, sf_dir), "stage", path)
        if read is not None:
            files.remove_folder(spark, read)
        read = path
    return docs
