"""Deterministic pseudo-random draws from hashes of row keys.

``rand()`` changes with partitioning and reruns; a hash of (key, seed, salt)
gives the same value for a row on any cluster layout.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_RESOLUTION = 1_000_000_007


def uniform(key: Column, seed: int, salt: str) -> Column:
    """A double in [0, 1) from xxhash64(key, seed, salt)."""
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(salt)), F.lit(_RESOLUTION)) / F.lit(float(_RESOLUTION))


def int_between(key: Column, seed: int, salt: str, lo: int, hi: int) -> Column:
    """An integer in [lo, hi] (inclusive)."""
    return (F.lit(lo) + F.floor(uniform(key, seed, salt) * F.lit(hi - lo + 1))).cast("int")


def choice(values: Sequence[str], key: Column, seed: int, salt: str) -> Column:
    """One element of a fixed list, uniformly."""
    idx = int_between(key, seed, salt, 1, len(values))
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx)


def choice_from_array(arr: Column, key: Column, seed: int, salt: str) -> Column:
    """One element of an array column, uniformly."""
    idx = (F.lit(1) + F.floor(uniform(key, seed, salt) * F.size(arr))).cast("int")
    return F.element_at(arr, idx)
