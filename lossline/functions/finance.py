"""Loss-ratio arithmetic, kept in exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def loss_ratio(incurred: Column, premium: Column, scale: int = 4) -> Column:
    """``round(incurred / premium, scale)``; a zero or NULL premium gives NULL
    instead of raising under ANSI mode."""
    return F.round(F.try_divide(incurred, premium), scale)


def vs_target(observed: Column, target: Column) -> Column:
    """OVER when observed > target; equal or NULL ratios read UNDER."""
    return F.when(observed > target, F.lit("OVER")).otherwise(F.lit("UNDER"))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: sum(value * weight) / sum(weight)."""
    return F.try_divide(F.sum(value * weight), F.sum(weight))
