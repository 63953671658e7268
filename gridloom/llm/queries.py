"""Registry of the training-data queries and of their SQL."""

from __future__ import annotations

import importlib

#: Query name -> module of this subpackage with query() and, where SQL can
#: express the operator, sql().
MODULES = {
    "op1_mixing": "mixing",
    "op2_ann": "ann",
    "op3_quality_model": "quality_model",
    "op4_pii": "pii",
    "op5_ngram_join": "ngram_join",
    "op6_sharding": "sharding",
    "op7_quality_rules": "quality_rules",
    "op8_secrets": "secrets",
    "op9_sentencepiece": "sentencepiece",
    "op10_licenses": "licenses",
}


def _module(name: str):
    return importlib.import_module(f"gridloom.llm.{name}")


def queries() -> dict:
    return {name: _module(m).query for name, m in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: _module(m).sql() for name, m in MODULES.items() if hasattr(_module(m), "sql")}
