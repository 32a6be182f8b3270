"""Casts that never raise, and the knowledge of which of them can lose a value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
_NUMBERS = (*_INTEGRAL, *_FLOATING, T.DecimalType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
#: Digits before and behind the point of whole numbers.
_DIGITS = {T.ByteType: (3, 0), T.ShortType: (5, 0), T.IntegerType: (10, 0), T.LongType: (19, 0)}
_LAST_SECOND = 253402300799  # the end of the year 9999


def castable(source: T.DataType, target: T.DataType) -> bool:
    """Whether :func:`convert` has a way from one type to the other."""
    if source == target or isinstance(source, T.NullType):
        return True
    if isinstance(target, T.StringType):
        return True
    if isinstance(source, T.StringType):
        return isinstance(target, (*_NUMBERS, *_TIMES, T.BooleanType, T.BinaryType))
    if isinstance(source, (*_NUMBERS, T.BooleanType)):
        from_number = (*_NUMBERS, T.BooleanType)
        epochs = (T.TimestampType, T.TimestampNTZType) if isinstance(source, _NUMBERS) else ()
        return isinstance(target, (*from_number, *epochs))
    if isinstance(source, T.TimestampType) and isinstance(target, _NUMBERS):
        return True
    return isinstance(source, _TIMES) and isinstance(target, _TIMES)


def common_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """The narrowest type that values of both go into.

    Whole numbers widen, and become floating with floating ones (beyond 2⁵³ rounded); dates become
    times, zoned times wall-clock times with those without a zone; everything else meets as text,
    nested values as JSON.
    """
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    kinds = (one, other)
    if all(isinstance(t, _INTEGRAL) for t in kinds):
        return max(kinds, key=lambda t: _INTEGRAL.index(type(t)))
    if all(isinstance(t, (*_INTEGRAL, T.DecimalType)) for t in kinds):
        digits = [_DIGITS.get(type(t)) or (t.precision - t.scale, t.scale) for t in kinds]
        whole, part = (max(d[i] for d in digits) for i in (0, 1))
        return T.DecimalType(whole + part, part) if whole + part <= 38 else T.DoubleType()
    if all(isinstance(t, _NUMBERS) for t in kinds):
        return T.DoubleType()
    if all(isinstance(t, _TIMES) for t in kinds):
        zoned = any(isinstance(t, T.TimestampType) for t in kinds)
        wall = any(isinstance(t, T.TimestampNTZType) for t in kinds)
        return T.TimestampType() if zoned and not wall else T.TimestampNTZType()
    return T.StringType()


def as_common(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """``column`` in a type that :func:`common_type` gave."""
    if source == target:
        return column
    if isinstance(source, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(column)
    return column.cast(target)


def convert(column: Column, source: T.DataType, target: T.DataType) -> Column:
    """``column`` as ``target``; a value that does not fit becomes NULL.

    A number becomes the time so many seconds after 1970, as wall-clock time of the session zone
    where the target has no zone.
    """
    if source == target:
        return column
    if isinstance(source, _NUMBERS) and isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        within = F.abs(column.cast("double")) <= _LAST_SECOND
        return F.when(within, F.timestamp_seconds(column)).cast(target)
    return column.try_cast(target)


def may_lose(source: T.DataType, target: T.DataType) -> bool:
    """Whether :func:`convert` can turn a non-NULL value into NULL."""
    if source == target or isinstance(source, T.NullType) or isinstance(target, T.StringType):
        return False
    if isinstance(source, _INTEGRAL) and isinstance(target, _INTEGRAL):
        return _INTEGRAL.index(type(source)) > _INTEGRAL.index(type(target))
    if isinstance(source, (*_INTEGRAL, *_FLOATING, T.DecimalType)) and isinstance(target, _FLOATING):
        return False
    if isinstance(source, T.BooleanType) and isinstance(target, (*_INTEGRAL, *_FLOATING)):
        return False
    return not (isinstance(source, _TIMES) and isinstance(target, _TIMES))
