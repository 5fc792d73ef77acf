"""JSON fields of the record dumps (X16, X21, P2-P3 shapes)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def amount(text: Column, to: str = "decimal(20,2)") -> Column:
    """Number or text field as a decimal; absent and blank are NULL, zero stays zero (Q9)."""
    return F.nullif(text, F.lit("")).cast(to)


def whole_number(text: Column) -> Column:
    """Strict integer field; blank is NULL."""
    return F.nullif(text, F.lit("")).cast("bigint")


def number_after_prefix(code: Column, length: int = 2) -> Column:
    """`CP123` to 123 by dropping a prefix of fixed length; a bad id fails the job."""
    return F.substring(code, length + 1, 2**31 - 1 - length).cast("bigint")


def number_without(code: Column, marker: str) -> Column:
    """Upper-case the code, remove every `marker`, read the rest as a number."""
    return F.replace(F.upper(code), F.lit(marker)).cast("bigint")


def reference_id(field: Column) -> Column:
    """A reference kept either as bare text or as an object with `_id`."""
    return F.nullif(
        F.coalesce(F.when(field.startswith("{"), F.get_json_object(field, "$._id")), field), F.lit("")
    )
