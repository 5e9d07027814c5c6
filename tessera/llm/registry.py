"""Queries of the training-data operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import conversation_repair, decontaminate, exact_topk, ngram_jaccard, packing, periodic_runs, quality, secret_scan, sharding, suffix_dedup, token_counts, toxicity, warc

QueryFn = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, QueryFn]:
    found = (
        sharding.op1_feistel_sharding,
        ngram_jaccard.op2_adaptive_jaccard,
        toxicity.op3_subword_toxicity,
        suffix_dedup.op4_suffix_dedup,
        packing.op5_grouping_genetic_packing,
        exact_topk.op6_maxscore_topk,
        warc.op7_legacy_archive_converter,
        secret_scan.op8_random_forest_secrets,
        quality.op9_boosted_quality,
        decontaminate.op10_blockmax_wand_decontamination,
        token_counts.op11_transducer_token_counts,
        periodic_runs.op12_suffix_tree_runs,
        conversation_repair.op13_ida_star_repair,
    )
    return {f.__name__: f for f in found}


def oracles() -> dict[str, str]:
    return {
        "op2_adaptive_jaccard": ngram_jaccard.ORACLE,
        "op4_suffix_dedup": suffix_dedup.ORACLE,
        "op6_maxscore_topk": exact_topk.ORACLE,
        "op7_legacy_archive_converter": warc.ORACLE,
        "op13_ida_star_repair": conversation_repair.ORACLE,
    }
