"""Monthly results of leaders against their goals."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import dates
from ledgerloom.functions.money import money_sum

LEADER = ("id_platinum", "nombre_platinum", "region")


def goals_by_month(goals: DataFrame, year: int) -> DataFrame:
    """Twelve month columns to one row per leader and month."""
    named = goals.select(
        "id_socio_platinum",
        *[
            F.col(name).cast("decimal(19,2)").alias(f"{year}-{number:02d}-01")
            for number, name in enumerate(fixed.GOAL_MONTHS, start=1)
        ],
    )
    return named.unpivot("id_socio_platinum", None, "fecha", "total_objetivo").select(
        F.col("id_socio_platinum").alias("id_platinum"),
        F.col("fecha").cast("date").alias("fecha"),
        "total_objetivo",
    )


def _in_year(moment: Column, year: int, whole_last_day: bool) -> Column:
    """The year as the source query bounds it: on timestamps the last day counts at midnight only
    (Q19), unless `whole_last_day`."""
    first, last = dt.date(year, 1, 1), dt.date(year, 12, 31)
    bounds = dates.in_days if whole_last_day else dates.between_midnights
    return bounds(moment, first, last)


def _against_goals(totals: DataFrame, goals: DataFrame, year: int) -> DataFrame:
    """Totals are one row per leader and month, so this join is small on both sides."""
    return totals.join(goals_by_month(goals, year), ["id_platinum", "fecha"], "left").select(
        "fecha", *LEADER, "total_real", "total_objetivo"
    )


def member_goals(
    dim_primerplatinum: DataFrame,
    dim_socios: DataFrame,
    goals: DataFrame,
    year: int,
    whole_last_day: bool = False,
) -> DataFrame:
    """New partners per leader and month of the year."""
    joined = dim_socios.where(_in_year(F.col("fecha_ingreso"), year, whole_last_day)).select(
        "id_socio", dates.month(F.col("fecha_ingreso")).alias("fecha")
    )
    totals = (
        dim_primerplatinum.join(joined, "id_socio")
        .groupBy("fecha", *LEADER)
        .agg(F.count("id_socio").alias("total_real"))
    )
    return _against_goals(totals, goals, year)


def sales_goals(
    dim_primerplatinum: DataFrame,
    fact_ventas: DataFrame,
    goals: DataFrame,
    year: int,
    whole_last_day: bool = False,
) -> DataFrame:
    """Amount sold per leader and month of the year.

    Sales are summed per partner and month first, so a partner with very many sales reaches the
    join as twelve rows at most.
    """
    sales = (
        fact_ventas.where(_in_year(F.col("fecha_compra"), year, whole_last_day))
        .groupBy("id_socio", dates.month(F.col("fecha_compra")).alias("fecha"))
        .agg(money_sum(F.col("precio")).alias("vendido"))
    )
    totals = (
        dim_primerplatinum.join(sales, "id_socio")
        .groupBy("fecha", *LEADER)
        .agg(F.sum("vendido").alias("total_real"))
    )
    return _against_goals(totals, goals, year)
