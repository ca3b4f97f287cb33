"""Least common types of columns whose type differs between waves (before J1, J2, E2).

Each year's export chooses its own types: an id is ``int`` one year, ``double`` the next and
text after that, and a column without values comes as boolean or without a type.  Every
column of several waves gets the least type that holds all its values exactly, so that equal
values stay equal and different ones different:

* integers widen; an integer of at most 32 bits (24 bits) and a double (float) is a double
  (float); a 64-bit integer and a double is a double whose 64-bit side is checked row by row
  (beyond 2^53 it raises, naming both types and the column);
* decimals widen while they fit 38 digits; one of at most 15 digits and a double is a double;
* a boolean counts as 0 or 1 beside a number; a column without a type takes any other;
* a date is the midnight of a timestamp;
* numbers, dates and timestamps without a zone become text beside text.  A whole number is
  written without a fraction, whatever its type (``5``, ``5.0`` and ``"5"`` are equal), other
  numbers as a double is written; texts are taken as they stand (``"007"`` isn't 7).

Everything else would lose or invent a difference and is refused with both types named:
booleans beside text, zoned timestamps beside text, long decimals beside doubles, floats
and doubles together beside text, numbers beside dates, binary or nested types beside others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
DIGITS = dict(zip(INTEGERS, (3, 5, 10, 19)))
EXACT_DOUBLE_DIGITS = 15  # decimals of so many digits differ as doubles if they differ
EXACT_DOUBLE = 1 << 53


def _loose(t: T.DataType) -> T.DataType:
    """The type with everything inside nullable."""
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_loose(t.elementType), True)
    if isinstance(t, T.MapType):
        return T.MapType(_loose(t.keyType), _loose(t.valueType), True)
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _loose(f.dataType), True) for f in t.fields])
    return T.StringType() if isinstance(t, (T.CharType, T.VarcharType)) else t


def _number(t: T.DataType) -> bool:
    return isinstance(t, (*INTEGERS, T.FloatType, T.DoubleType, T.DecimalType))


def _decimal(t: T.DataType) -> tuple[int, int]:
    return (t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (DIGITS[type(t)], 0)


def _pair(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type for the values of both, or None."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.NullType):
            return y
        if isinstance(x, T.BooleanType) and _number(y):
            return y
        if isinstance(x, T.DateType) and isinstance(y, (T.TimestampType, T.TimestampNTZType)):
            return y
        if isinstance(x, T.StringType) and (_number(y) or isinstance(y, (T.DateType, T.TimestampNTZType))):
            return T.StringType()
    if not (_number(a) and _number(b)):
        return None
    if isinstance(a, INTEGERS) and isinstance(b, INTEGERS):
        return max(a, b, key=lambda t: DIGITS[type(t)])
    floats = [t for t in (a, b) if isinstance(t, (T.FloatType, T.DoubleType))]
    if floats:
        other = [t for t in (a, b) if t not in floats]
        if not other:
            return T.DoubleType()
        if isinstance(other[0], T.DecimalType):
            return T.DoubleType() if other[0].precision <= EXACT_DOUBLE_DIGITS else None
        small = isinstance(other[0], (T.ByteType, T.ShortType))
        return floats[0] if small else T.DoubleType()
    (i1, s1), (i2, s2) = _decimal(a), _decimal(b)
    whole, scale = max(i1, i2), max(s1, s2)
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


def least_common_type(types: Sequence[T.DataType], column: str = "") -> T.DataType:
    """The least type that holds the values of all; a ``TypeError`` names the pair that has none."""
    def refuse(a, b):
        raise TypeError(f"column {column!r} is {a.simpleString()} in one wave and {b.simpleString()} in another, "
                        "which no type holds without loss; cast one of them first")

    types = [_loose(t) for t in types]
    for i, a in enumerate(types):
        for b in types[:i]:
            if _pair(a, b) is None:
                refuse(b, a)
    out = types[0]
    for t in types[1:]:
        both = _pair(out, t)
        if both is None:
            refuse(out, t)
        out = both
    if isinstance(out, T.StringType):
        for a, b in ((T.FloatType, T.DoubleType), (T.BooleanType, T.StringType)):
            one, two = ([t for t in types if isinstance(t, k)] for k in (a, b))
            if one and two:
                refuse(one[0], two[0])
        long = [t for t in types if isinstance(t, T.DecimalType) and t.precision > EXACT_DOUBLE_DIGITS]
        if long and any(isinstance(t, (T.FloatType, T.DoubleType)) for t in types):
            refuse(long[0], next(t for t in types if isinstance(t, (T.FloatType, T.DoubleType))))
    return out


def _as_text(value: Column, kind: T.DataType) -> Column:
    """One text for each value: whole numbers without a fraction."""
    if isinstance(kind, T.DecimalType) and kind.precision > EXACT_DOUBLE_DIGITS:
        text = value.cast("string")
        return F.when(text.contains("."), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", "")).otherwise(text) if kind.scale else text
    if isinstance(kind, T.DecimalType):
        value, kind = value.cast("double"), T.DoubleType()
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        whole = (value == F.floor(value)) & (F.abs(value) < float(1 << 63))
        return F.when(whole, value.try_cast("long").cast("string")).otherwise(value.cast("string"))
    return value.cast("string")


def convert(value: Column, kind: T.DataType, to: T.DataType, column: str = "") -> Column:
    """``value`` of one wave in the common type."""
    if isinstance(to, T.StringType) and not isinstance(kind, T.NullType):
        return _as_text(value, _loose(kind))
    if isinstance(kind, T.LongType) and isinstance(to, T.DoubleType):
        text = F.concat(F.lit(f"column {column!r} is bigint in one wave and double in another; as a double it would lose "), value.cast("string"))
        exact = value.isNull() | value.between(-EXACT_DOUBLE, EXACT_DOUBLE)
        return F.when(exact, value.cast("double")).otherwise(F.raise_error(text).cast("double"))
    return value.cast(to)


def common_types(waves: Sequence[DataFrame]) -> dict[str, T.DataType]:
    """The least common type of each column that differs between the waves that have it."""
    found: dict[str, list[T.DataType]] = {}
    for w in waves:
        for f in w.schema.fields:
            found.setdefault(f.name, []).append(f.dataType)
    return {name: least_common_type(types, name) for name, types in found.items() if any(t != types[0] for t in types)}


def align_types(waves: Sequence[DataFrame]) -> list[DataFrame]:
    """The waves with each shared column in its least common type; no scan, no shuffle.

    Columns that agree, and waves none of whose columns change, are left as they are."""
    common = common_types(waves)
    out = []
    for w in waves:
        change = {f.name: F.col(f"`{f.name}`") for f in w.schema.fields if f.name in common and f.dataType != common[f.name]}
        if change:
            kinds = {f.name: f for f in w.schema.fields}
            w = w.select([convert(c, kinds[n].dataType, common[n], n).alias(n, metadata=kinds[n].metadata) if (c := change.get(n)) is not None else F.col(f"`{n}`")
                          for n in w.columns])
        out.append(w)
    return out
