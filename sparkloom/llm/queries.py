"""The registered queries of this subpackage, and their SQL."""

from __future__ import annotations

from importlib import import_module

NAMES = {
    "op1_exact_dedup": "exact_dedup",
    "op2_ngram_join": "ngram_join",
    "op3_license_scan": "license_scan",
    "op4_mixing": "mixing",
    "op5_language_id": "language_id",
    "op6_bpe_codec": "bpe_codec",
    "op7_token_files": "token_files",
    "op8_fingerprints": "fingerprints",
    "op9_url_filter": "url_filter",
    "op10_pii": "pii",
    "op11_token_alignment": "alignment",
    "op12_simhash": "simhash",
    "op13_merkle_manifest": "merkle",
}


def queries() -> dict:
    return {name: getattr(import_module(f"sparkloom.llm.{module}"), name) for name, module in NAMES.items()}


def oracle_sql() -> dict:
    found: dict = {}
    for module in dict.fromkeys(NAMES.values()):
        found |= getattr(import_module(f"sparkloom.llm.{module}"), "ORACLE", {})
    return found
