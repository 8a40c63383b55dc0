"""The queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from importlib import import_module

MODULES = ("exact_dedup", "histogram_shards", "packing", "token_counts", "language_id", "decontamination", "minhash_join", "lm_scoring", "chat_windows", "substring_dedup")


def _gather(name: str) -> dict:
    return {k: v for m in MODULES for k, v in getattr(import_module(f"concord.llm.{m}"), name, {}).items()}


def queries() -> dict:
    return _gather("QUERIES")


def oracle_sql() -> dict[str, str]:
    return _gather("ORACLE")
