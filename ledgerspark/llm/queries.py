"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerspark.llm import (
    alignment,
    conversations,
    decontaminate,
    jaccard,
    language,
    licenses,
    lines,
    mixing,
    pages,
    quality,
    substrings,
    token_files,
    topk,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_main_text": pages.op1_main_text,
        "op2_embedding_top_k": topk.op2_embedding_top_k,
        "op3_mix_sources": mixing.op3_mix_sources,
        "op4_remove_repeats": substrings.op4_remove_repeats,
        "op5_near_duplicates": jaccard.op5_near_duplicates,
        "op6_license_notices": licenses.op6_license_notices,
        "op7_language": language.op7_language,
        "op8_repeated_lines": lines.op8_repeated_lines,
        "op9_benchmark": decontaminate.op9_benchmark,
        "op10_token_files": token_files.op10_token_files,
        "op11_token_alignment": alignment.op11_token_alignment,
        "op12_host_quality": quality.op12_host_quality,
        "op13_conversation_trie": conversations.op13_conversation_trie,
    }


def oracle_sql() -> dict[str, str]:
    """Language models, tokenizers, alignment, knapsacks and components have none; their tests are by brute force."""
    return {
        "op2_embedding_top_k": topk.OP2_SQL,
        "op4_remove_repeats": substrings.OP4_SQL,
        "op8_repeated_lines": lines.OP8_SQL,
        "op12_host_quality": quality.OP12_SQL,
        "op13_conversation_trie": conversations.OP13_SQL,
    }
