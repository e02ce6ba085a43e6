"""Deterministic keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hash_key(*parts: Column) -> Column:
    """md5 of the parts' text, one after the other; null when any part is null."""
    return F.md5(F.concat(*[p.cast("string") for p in parts]))
