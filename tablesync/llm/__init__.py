"""Operators of a training-data pipeline; nothing else in the library imports this."""

from __future__ import annotations

from importlib import import_module

#: Query name -> module of this package that holds it.
_QUERIES = {
    "op1_pii_sanitise": "pii",
    "op2_html_text": "html_text",
    "op3_quality_crf": "quality",
    "op4_mix_sources": "mixing",
    "op5_suffix_dedup": "suffix_dedup",
    "op6_decontaminate": "decontam",
    "op7_line_dedup": "line_dedup",
    "op8_kdtree_topk": "topk",
    "op9_language_id": "language",
    "op10_minhash_neardup": "neardup",
    "op11_prefix_trie": "conv_trie",
    "op12_phrase_dedup": "phrase_dedup",
    "op13_merkle_manifest": "merkle",
}


def queries() -> dict:
    return {name: getattr(import_module(f"tablesync.llm.{module}"), name) for name, module in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    """SQL of the queries that have a ``OPn_SQL`` beside them."""
    out = {}
    for name, module in _QUERIES.items():
        sql = getattr(import_module(f"tablesync.llm.{module}"), name.split("_")[0].upper() + "_SQL", None)
        if sql:
            out[name] = sql
    return out
