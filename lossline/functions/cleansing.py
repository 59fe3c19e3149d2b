"""Text cleansing expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def title(col: str | Column) -> Column:
    """``initcap(trim(x))`` as the reference spells lob and region (UK -> Uk)."""
    return F.initcap(F.trim(_c(col)))


def match_key(col: str | Column) -> Column:
    """Case- and space-insensitive join key for dimension lookups."""
    return F.lower(F.trim(_c(col)))
