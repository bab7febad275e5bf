"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

MODULES = ("fingerprints", "piece_bpe", "prefix_counts", "quality_rules", "quality_trees", "license_scan", "page_text", "near_dedup", "mixing", "ngram_trie")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for m in MODULES for name, f in import_module(f"{__package__}.{m}").QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: q for m in MODULES for name, q in import_module(f"{__package__}.{m}").ORACLES.items()}
