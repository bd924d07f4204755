"""Registered queries of the folder: each maps a session and a table folder to a frame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestrata.llm import (
    chat_format, decision_list, decontamination, jaccard_join, language_id, packing, prefix_trie, separators, simple8b,
    spelling, suffix_dedup, toxicity, warc,
)
from lodestrata.llm.common import read_table
from lodestrata.llm.tokens import word_vocabulary


def _on_documents(operator, *more):
    """A query that gives an operator the whole table of documents."""
    return lambda spark, sf_dir: operator(
        spark, read_table(spark, sf_dir, "documents"), *(x() for x in more)
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": lambda spark, sf_dir: decontamination.op1_decontamination(
            spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
        ),
        "op2_packing": _on_documents(packing.op2_packing, word_vocabulary),
        "op3_suffix_dedup": _on_documents(suffix_dedup.op3_suffix_dedup),
        "op4_quality_rules": lambda spark, sf_dir: decision_list.op4_quality(
            spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
        ),
        "op5_warc": lambda spark, sf_dir: warc.op5_warc(spark, read_table(spark, sf_dir, "pages")),
        "op6_jaccard_join": _on_documents(jaccard_join.op6_jaccard_join),
        "op7_simple8b": _on_documents(simple8b.op7_token_output, word_vocabulary),
        "op8_toxicity": lambda spark, sf_dir: toxicity.op8_toxicity(
            spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
        ),
        "op9_token_counts": _on_documents(separators.op9_token_counts, word_vocabulary),
        "op10_language_id": _on_documents(language_id.op10_language_id),
        "op11_chat_format": lambda spark, sf_dir: chat_format.op11_chat_format(
            spark, read_table(spark, sf_dir, "conversations")
        ),
        "op12_spelling": _on_documents(spelling.op12_spelling),
        "op13_prefix_trie": lambda spark, sf_dir: prefix_trie.op13_prefix_trie(
            spark, read_table(spark, sf_dir, "conversations")
        ),
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op3_suffix_dedup": suffix_dedup.OP3_SQL,
        "op5_warc": warc.OP5_SQL,
        "op6_jaccard_join": jaccard_join.OP6_SQL,
        "op11_chat_format": chat_format.OP11_SQL,
        "op12_spelling": spelling.OP12_SQL,
        "op13_prefix_trie": prefix_trie.OP13_SQL,
    }
