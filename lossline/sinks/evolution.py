"""Schemas of a table whose batches were written with different columns and types.

Columns are united by name. Types form a lattice of lossless widenings; two batches'
types meet in the least type that holds both:

    byte < short < int < long < decimal(20,0) < wider decimals
    decimal(p,s), decimal(q,t) -> the integer digits and the scale of either
    byte, short, int, float -> double;   date -> timestamp

Anything else (a long with a double, a string with a number) has no lossless common
type and raises. Structs and arrays widen inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = (3, 5, 10, 20)            # decimal digits that hold every value of the type
MAX_PRECISION = 38


def _rank(t: T.DataType) -> int | None:
    return next((i for i, kind in enumerate(_INTEGRAL) if isinstance(t, kind)), None)


def _decimal(t: T.DataType) -> tuple[int, int] | None:
    """(integer digits, scale) of a decimal or integral type."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return None if _rank(t) is None else (_DIGITS[_rank(t)], 0)


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds every value of both without loss; TypeError if none."""
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    ra, rb = _rank(a), _rank(b)
    if ra is not None and rb is not None:
        return a if ra > rb else b
    da, db = _decimal(a), _decimal(b)
    if da and db:
        whole, scale = max(da[0], db[0]), max(da[1], db[1])
        if whole + scale <= MAX_PRECISION:
            return T.DecimalType(whole + scale, scale)
    for x, y in ((a, b), (b, a)):
        small = isinstance(x, T.FloatType) or (_rank(x) is not None and _rank(x) < 3)
        if isinstance(y, T.DoubleType) and small:
            return y
        if isinstance(y, T.FloatType) and _rank(x) is not None:
            return T.DoubleType() if _rank(x) == 2 else y if _rank(x) < 2 else _none(a, b)
        if isinstance(x, T.DateType) and isinstance(y, (T.TimestampType, T.TimestampNTZType)):
            return y
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType), True)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return union_schema([a, b])
    return _none(a, b)


def _none(a: T.DataType, b: T.DataType) -> T.DataType:
    raise TypeError(f"no lossless common type of {a.simpleString()} and {b.simpleString()}")


def union_schema(schemas: list[T.StructType]) -> T.StructType:
    """Fields by name in order of first appearance, each of the least type that holds
    all its batches' (NULL fills absent columns)."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            seen = fields.get(f.name)
            try:
                kind = f.dataType if seen is None else wider(seen.dataType, f.dataType)
            except TypeError as e:
                raise TypeError(f"column {f.name!r} changed type: {e}") from None
            fields[f.name] = T.StructField(f.name, kind, True)
    return T.StructType(list(fields.values()))


def same_types(schema: T.StructType, target: T.StructType) -> bool:
    """Whether the fields that both have are of one type (so that files written with
    ``schema`` can be read as ``target``)."""
    own = {f.name: f.dataType for f in schema.fields}
    return all(own.get(f.name, f.dataType) == f.dataType for f in target.fields)


def widened(df: DataFrame, target: T.StructType) -> DataFrame:
    """``df`` with the columns and types of ``target``."""
    def column(f: T.StructField) -> Column:
        return (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
    return df.select(*[column(f) for f in target.fields])
