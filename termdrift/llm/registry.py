"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from importlib import import_module

#: Query name -> module; each module has the query as a function of that name, and ORACLE_SQL if SQL can express it.
QUERIES = {
    "op1_chat": "chat",
    "op2_pseudonyms": "pseudonyms",
    "op3_line_quality": "line_quality",
    "op4_toxicity": "toxicity",
    "op5_mixing": "mixing",
    "op6_simhash": "simhash",
    "op7_byte_bpe": "byte_bpe",
    "op8_secrets": "secrets",
    "op9_topk": "topk",
    "op10_warc": "warc",
}


def queries() -> dict:
    return {name: getattr(import_module(f"{__package__}.{module}"), name) for name, module in QUERIES.items()}


def oracle_sql() -> dict:
    found = {name: getattr(import_module(f"{__package__}.{module}"), "ORACLE_SQL", None) for name, module in QUERIES.items()}
    return {name: sql for name, sql in found.items() if sql}
