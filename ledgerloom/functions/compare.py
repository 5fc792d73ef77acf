"""Equality used by the update operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\r\x0b\x0c"


def exact(column: Column, _: T.DataType) -> Column:
    return column


def null_as_false(column: Column, kind: T.DataType) -> Column:
    """A missing boolean counts as False, other types compare as they are."""
    return F.coalesce(column, F.lit(False)) if isinstance(kind, T.BooleanType) else column


def tolerant(column: Column, kind: T.DataType) -> Column:
    """M5: cents for numbers, case and outer blanks ignored for text, whole seconds for time."""
    if isinstance(kind, (T.DecimalType, T.FractionalType)):
        return F.bround(column, 2)
    if isinstance(kind, T.StringType):
        return F.lower(F.trim(F.coalesce(column, F.lit("")), F.lit(BLANKS)))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("second", column)
    return column


def differs(pairs: list[tuple[Column, Column]]) -> Column:
    """True when any pair differs; NULL equals NULL, so the answer is never NULL."""
    return reduce(lambda a, b: a | b, [~old.eqNullSafe(new) for old, new in pairs])
