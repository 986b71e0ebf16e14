"""The queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corvina.llm import decontaminate, filter_audit, license_scan, line_dedup, manifest, mixing, near_dedup, neighbours, quality, sharding, token_counts, token_store, toxicity

_PARTS = (decontaminate, near_dedup, neighbours, sharding, mixing, line_dedup, token_store, toxicity, license_scan, quality, filter_audit, manifest, token_counts)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: f for part in _PARTS for name, f in part.QUERIES.items()}
ORACLES: dict[str, str] = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
