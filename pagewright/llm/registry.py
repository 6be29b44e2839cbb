"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagewright.llm import q_corpus, q_dedup, q_manifest, q_models, q_native, q_vectors

_MODULES = (q_native, q_models, q_vectors, q_corpus, q_dedup, q_manifest)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: q for m in _MODULES for k, q in m.QUERIES.items()}
ORACLE: dict[str, str] = {k: s for m in _MODULES for k, s in m.ORACLE.items()}
