"""Lenient casts: turn loose text into a typed column, null when hopeless."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartouche.constants import TRUE_WORDS
from cartouche.functions.dates import iso_date
from cartouche.functions.text import none_if_empty, text

_TEXTUAL = (T.StringType, T.VarcharType, T.CharType)
_STAMPS = (T.TimestampType, T.TimestampNTZType)


def lenient_cast(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast ``c`` of type ``source`` to ``target``.

    '' and empty arrays are null. From text: booleans know a few true-words, whole
    numbers take the first digit run (a minus sign is lost), doubles the first
    number, dates and timestamps must be ISO.
    """
    if isinstance(source, T.ArrayType):
        value = F.when(F.size(c) > 0, c)
        return value if isinstance(target, T.ArrayType) else F.to_json(value)
    if isinstance(target, T.StringType):
        return F.to_json(c) if isinstance(source, (T.StructType, T.MapType)) else none_if_empty(c)
    if not isinstance(source, _TEXTUAL):
        return _from_typed(c, source, target)
    s = none_if_empty(c)
    if isinstance(target, T.BooleanType):
        return F.when(s.isNotNull(), F.lower(s).isin(*TRUE_WORDS))
    if isinstance(target, (T.IntegralType,)):
        return none_if_empty(F.regexp_extract(s, r"[0-9]+", 0)).try_cast(target)
    if isinstance(target, (T.FloatType, T.DoubleType, T.DecimalType)):
        return none_if_empty(F.regexp_extract(s, r"[0-9]+\.?[0-9]*", 0)).try_cast(target)
    if isinstance(target, T.DateType):
        return iso_date(s)
    if isinstance(target, _STAMPS):
        return F.when(iso_date(s).isNotNull(), s.try_cast(target))
    return s.try_cast(target)


def _from_typed(c: Column, source: T.DataType, target: T.DataType) -> Column:
    numeric = isinstance(source, T.NumericType)
    if isinstance(target, T.BooleanType):
        return c != 0 if numeric else (c if isinstance(source, T.BooleanType) else c.isNotNull())
    if isinstance(target, T.NumericType):
        return c.try_cast(target) if numeric or isinstance(source, T.BooleanType) else F.lit(None).cast(target)
    if isinstance(target, T.DateType) or isinstance(target, _STAMPS):
        dated = isinstance(source, (T.DateType, *_STAMPS))
        return c.cast(target) if dated else F.lit(None).cast(target)
    return c.try_cast(target)


def is_type_error(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """A value is there but does not convert ('' counts: it converts to null)."""
    return c.isNotNull() & lenient_cast(c, source, target).isNull()


def non_empty(c: Column, dtype: T.DataType) -> Column:
    """Null, '' and empty arrays are empty; everything else counts."""
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.coalesce(F.size(c) > 0, F.lit(False))
    if isinstance(dtype, _TEXTUAL):
        return F.coalesce(text(c) != "", F.lit(False))
    return c.isNotNull()
