"""The corpus operators' queries, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lectern.llm import dedup, divergence, language, lines, mixing, packing, quality, shards, simhash, tokens, topk, warc, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": mixing.op1,
    "op2_token_counts": tokens.op2,
    "op3_sharding": shards.op3,
    "op4_quality_rules": quality.op4,
    "op5_best_fit_packing": packing.op5,
    "op6_warc": warc.op6,
    "op7_line_dedup": lines.op7,
    "op8_language_id": language.op8,
    "op9_exact_top_k": topk.op9,
    "op10_simhash_near_dedup": simhash.op10,
    "op11_embedding_whitening": whitening.op11,
    "op12_source_divergence": divergence.op12,
    "op13_exact_dedup": dedup.op13,
}
ORACLE_SQL: dict[str, str] = {
    "op1_mixing": mixing.ORACLE,
    "op6_warc": warc.ORACLE,
    "op9_exact_top_k": topk.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
    "op13_exact_dedup": dedup.ORACLE,
}
