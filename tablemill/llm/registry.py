"""The queries of this subpackage and, where SQL can express one, its DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from tablemill.llm import (
    decontaminate,
    language_id,
    licenses,
    merkle,
    minhash_dedup,
    multi_index,
    pii,
    quality,
    sentencepiece_codec,
    sharding,
    spelling,
    substring_dedup,
    token_counts,
)
from tablemill.llm.oracles import OP1_SQL, OP6_SQL, OP11_SQL, OP12_SQL, OP13_SQL, op3_sql

QUERIES: dict[str, Callable] = {
    "op1_minhash_near_dedup": minhash_dedup.op1_minhash_near_dedup,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_inverted_multi_index": multi_index.op4_inverted_multi_index,
    "op5_sentencepiece_codec": sentencepiece_codec.op5_sentencepiece_codec,
    "op6_benchmark_decontamination": decontaminate.op6_benchmark_decontamination,
    "op7_virtual_slot_sharding": sharding.op7_virtual_slot_sharding,
    "op8_pii_bootstrapped": pii.op8_pii_bootstrapped,
    "op9_language_id": language_id.op9_language_id,
    "op10_quality_classifier": quality.op10_quality_classifier,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_substring_dedup": substring_dedup.op12_substring_dedup,
    "op13_merkle_manifest": merkle.op13_merkle_manifest,
}

ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": OP1_SQL,
    "op6_benchmark_decontamination": OP6_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_substring_dedup": OP12_SQL,
    "op13_merkle_manifest": OP13_SQL,
    "op3_license_scan": op3_sql(licenses.known_templates(), licenses.DICE, licenses.slack),
}
