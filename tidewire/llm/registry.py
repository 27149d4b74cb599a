"""The queries of this subpackage and their SQL twins, where SQL can express them."""

from __future__ import annotations

import importlib

MODULES = ("toxicity", "rules", "decontaminate", "quality", "language", "mixing", "pii", "tokens", "sharding", "simhash", "bpe", "runs", "alignment")


def _all(kind: str) -> dict:
    return {k: v for m in MODULES for k, v in getattr(importlib.import_module(f"tidewire.llm.{m}"), kind).items()}


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLES")
