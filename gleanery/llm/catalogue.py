"""The corpus operators' queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanery.llm import decontam, html_text, licenses, mixing, near_dup, prefix_trie, repair, secrets_scan, sharding, syncmers, token_counts, toxicity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_closed_syncmers": syncmers.op1,
    "op2_extendible_shards": sharding.op2,
    "op3_dart_near_duplicates": near_dup.op3,
    "op4_warc_archive": warc.op4,
    "op5_zstd_toxicity": toxicity.op5,
    "op6_capped_mix": mixing.op6,
    "op7_mincut_main_text": html_text.op7,
    "op8_prefix_token_counts": token_counts.op8,
    "op9_trigram_secrets": secrets_scan.op9,
    "op10_wand_decontamination": decontam.op10,
    "op11_license_rules": licenses.op11,
    "op12_preorder_trie": prefix_trie.op12,
    "op13_earley_repair": repair.op13,
}

SQL: dict[str, str] = {
    "op2_extendible_shards": sharding.op2_sql(),
    "op6_capped_mix": mixing.OP6_SQL,
    "op9_trigram_secrets": secrets_scan.OP9_SQL,
    "op12_preorder_trie": prefix_trie.OP12_SQL,
    "op13_earley_repair": repair.OP13_SQL,
}
