"""Registered queries over the driver's tables and their SQL twins."""

from __future__ import annotations

import importlib

MODULES = ("urls", "text", "classify", "index", "dedup", "crumbs", "crawl", "flow", "sources", "jobs", "state")


def _all(kind: str) -> dict:
    return {k: v for m in MODULES for k, v in getattr(importlib.import_module(f"tidewire.queries.{m}"), kind).items()}


def queries() -> dict:
    return _all("QUERIES")


def oracle_sql() -> dict:
    return _all("ORACLES")


def flagship(spark, sf_dir):
    return queries()["j1_flagship"](spark, sf_dir)
