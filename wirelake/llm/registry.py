"""The registered queries of this package and their SQL form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from wirelake.llm import bpe, chat, decontaminate, html, jaccard, merkle, repair, rules, shards, suffix_dedup, tokens, topk, toxicity
from wirelake.session import use_utc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_chat_trees": chat.op1,
        "op2_rank_queue_bpe": bpe.op2,
        "op3_hilbert_shards": shards.op3,
        "op4_jaccard_join": jaccard.op4,
        "op5_token_files": tokens.op5,
        "op6_compression_toxicity": toxicity.op6,
        "op10_block_tree_html": html.op10,
        "pipeline": corpus_pipeline.run,
        "op7_suffix_decontamination": decontaminate.op7,
        "op8_suffix_dedup": suffix_dedup.op8,
        "op9_decision_list": rules.op9,
        "op11_merkle_manifest": merkle.op11,
        "op12_run_length_repair": repair.op12,
        "op13_norm_topk": topk.op13,
    }
    return {name: lambda spark, sf_dir, run=run: run(use_utc(spark), sf_dir) for name, run in found.items()}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_trees": chat.op1_sql(),
        "op4_jaccard_join": jaccard.op4_sql(),
        "op7_suffix_decontamination": decontaminate.op7_sql(),
        "op8_suffix_dedup": suffix_dedup.op8_sql(),
        "op11_merkle_manifest": merkle.op11_sql(),
        "op12_run_length_repair": repair.op12_sql(),
        "op13_norm_topk": topk.op13_sql(),
    }
