"""The queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shiftscore.llm import (
    alignment,
    embedding_dedup,
    fingerprints,
    language,
    license_scan,
    mixing,
    packing,
    secrets,
    simhash_dedup,
    substrings,
    suffix_tree,
    token_counts,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_fingerprints": fingerprints.op2_fingerprints,
    "op3_simhash_dedup": simhash_dedup.op3_simhash_dedup,
    "op4_mixing": mixing.op4_mixing,
    "op5_suffix_tree": suffix_tree.op5_suffix_tree,
    "op6_packing": packing.op6_packing,
    "op7_secrets": secrets.op7_secrets,
    "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
    "op9_substrings": substrings.op9_substrings,
    "op10_language": language.op10_language,
    "op11_whitening": whitening.op11_whitening,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_alignment": alignment.op13_alignment,
}

ORACLES: dict[str, str] = {
    "op4_mixing": mixing.ORACLE,
    "op7_secrets": secrets.ORACLE,
    "op8_embedding_dedup": embedding_dedup.ORACLE,
    "op9_substrings": substrings.ORACLE,
    "op12_license_scan": license_scan.ORACLE,
}
