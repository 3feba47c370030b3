"""Catalogue type names and the Spark types they stand for."""

from __future__ import annotations

from pyspark.sql import types as T

# The catalogue's type names.
_SIMPLE_TYPES = {
    "string": T.StringType(),
    "nvarchar": T.StringType(),
    "varchar": T.StringType(),
    "char": T.StringType(),
    "bit": T.BooleanType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "datetimeoffset": T.TimestampType(),
    "datetime2": T.TimestampType(),
    "timestamp": T.TimestampType(),
    "long": T.LongType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "double": T.DoubleType(),
    "float": T.FloatType(),
    "smallint": T.ShortType(),
    "tinyint": T.ByteType(),
}
_DECIMAL_NAMES = ("decimal", "numeric")
_DEFAULT_DECIMAL = (18, 6)


def resolve_type(name: str, precision=None, scale=None) -> T.DataType:
    """The Spark type of a catalogue type name; unknown names mean string.

    A decimal whose precision or scale is missing or unusable becomes
    ``decimal(18,6)``; a scale of 0 is a valid scale.
    """
    key = str(name).strip().lower()
    if key not in _DECIMAL_NAMES:
        return _SIMPLE_TYPES.get(key, T.StringType())
    try:
        digits, places = int(precision), int(scale)
    except (TypeError, ValueError):
        return T.DecimalType(*_DEFAULT_DECIMAL)
    if not 0 < digits <= 38 or not 0 <= places <= digits:
        return T.DecimalType(*_DEFAULT_DECIMAL)
    return T.DecimalType(digits, places)


def same_type(left: T.DataType, right: T.DataType) -> bool:
    """Whole-type equality; decimals of different precision differ."""
    if isinstance(left, T.StringType) and isinstance(right, T.StringType):
        return True
    return left == right
