"""Money and crypto amounts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(19,2)"
CRYPTO = "decimal(38,9)"
BTC_WIDTH = 18


def clean_money(amount: Column, to: str = MONEY) -> Column:
    """`$1,234.50` to a decimal; blank text is NULL, any other non-number is an error.

    Used where text comes in; jobs behind that boundary work on decimals and use `money`.
    """
    text = F.regexp_replace(amount.cast("string"), "[$,]", "")
    return F.nullif(text, F.lit("")).cast(to)


def clean_money_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The source boundary: the named text columns of a table as decimals."""
    return df.withColumns({c: clean_money(F.col(c)) for c in columns})


def money(amount: Column) -> Column:
    """A money column as the decimal all sums use; free when it is one already."""
    return amount.cast(MONEY)


def money_sum(amount: Column) -> Column:
    """Sum of money kept in decimals, so the result does not depend on row order."""
    return F.sum(money(amount))


def money_or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0).cast(MONEY))


def btc_text(amount: Column) -> Column:
    """Crypto amount with thousands separators and nine decimals, right-aligned to the width
    of the `999,999.999999999` picture and its sign.  Below one there is no leading zero.  A number
    too large for the picture is shown in full instead of as `#` marks.
    """
    shown = F.format_number(amount, 9)
    shown = F.when(F.abs(amount) < 1, F.regexp_replace(shown, "^(-?)0", "$1")).otherwise(shown)
    return F.when(F.length(shown) < BTC_WIDTH, F.lpad(shown, BTC_WIDTH, " ")).otherwise(shown)


def btc_text_or_zero(amount: Column) -> Column:
    """As `btc_text`, a plain `0` when nothing was paid in crypto."""
    return F.when(amount == 0, F.lit("0")).otherwise(btc_text(amount))


def percent(part: Column, whole: Column) -> Column:
    """`100 * part / whole` of two counts, two half-up decimals; NULL when the whole is zero.

    The widths leave sixteen digits behind the point before the rounding.
    """
    hundred, count = "decimal(3,0)", "decimal(15,0)"
    whole = F.nullif(whole.cast(count), F.lit(0).cast(count))
    return F.round(F.lit(100).cast(hundred) * part.cast(count) / whole, 2)
