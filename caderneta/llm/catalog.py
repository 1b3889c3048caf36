"""Queries and check SQL of the operators in this folder."""

from __future__ import annotations

from importlib import import_module

MODULES = ("sharding", "mixing", "quality_rules", "personal_data", "near_duplicates", "bpe", "line_dedup", "fingerprints", "masked_lm",
           "licences", "variants", "chat", "collocations")

QUERIES: dict = {}
ORACLES: dict = {}
for _name in MODULES:
    _module = import_module(f"caderneta.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLES.update(_module.ORACLES)
