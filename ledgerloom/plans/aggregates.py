"""Monthly and daily aggregates."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import dates
from ledgerloom.functions.labels import bucket_of
from ledgerloom.functions.money import money, money_sum
from ledgerloom.operators import maintenance as m
from ledgerloom.plans.payments import payment_types

BUCKET_KEY = ("nombre", "fecha")


def monthly_paid(fact: DataFrame, since: dt.date, as_of: dt.date) -> DataFrame:
    """Paid rows of a purchase fact per month; loaded by `upsert` on `mes`."""
    return (
        fact.where(
            (F.col("estatus") == fixed.PAID_LABEL) & dates.in_days(F.col("fecha_pago"), since, as_of)
        )
        .groupBy(dates.month(F.col("fecha_pago")).alias("mes"))
        .agg(
            F.count("*").alias("total_pagos"),
            money_sum(F.col("precio")).alias("total_ingresos"),
        )
    )


def sales_partials(fact_ventas: DataFrame) -> DataFrame:
    """Sales summed per product and day; sums over parts of the fact add up to those over all of it."""
    return fact_ventas.groupBy("id_producto", dates.day(F.col("fecha_compra")).alias("fecha")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money(F.col("precio"))).alias("valor")
    )


def buckets_of_partials(
    sales: DataFrame,
    catalogue: DataFrame,
    patterns: tuple = fixed.PLAN_BUCKETS,
    other: str = fixed.PLAN_BUCKET_OTHER,
) -> DataFrame:
    """Sales per name bucket and day, from sums per product and day.

    Patterns are matched once per product, not per sale, and the join sees one row per product and day,
    however often a product sells.
    """
    buckets = catalogue.select(
        "id_producto", bucket_of(F.col("nombre"), patterns, other).alias("cubo")
    )
    return (
        sales.join(buckets, "id_producto", "left")
        .groupBy(F.coalesce("cubo", F.lit(other)).alias("nombre"), "fecha")
        .agg(F.sum("n").alias("cantidad"), F.sum("valor").alias("valor_total"))
        .select("nombre", "cantidad", "valor_total", "fecha")
    )


def plan_buckets(fact_ventas: DataFrame, catalogue: DataFrame, *rules, **named) -> DataFrame:
    """Sales per name bucket and day; patterns and the other bucket as in `buckets_of_partials`."""
    return buckets_of_partials(sales_partials(fact_ventas), catalogue, *rules, **named)


def plan_bucket_daily(fact_ventas: DataFrame, catalogue: DataFrame, agg_planes: DataFrame, **rules) -> DataFrame:
    """The bucket days to add; days already loaded are never refreshed (Q15).

    The source has one row per key, so M1 already leaves nothing for M3 to ignore.
    """
    return m.new_rows(agg_planes, plan_buckets(fact_ventas, catalogue, **rules), BUCKET_KEY)


def payment_types_daily(pagos: DataFrame, enum: DataFrame) -> DataFrame:
    """Paid payments of known types per name and day, summed per type before the lookup."""
    paid = (
        pagos.where(F.col("estatus") == fixed.PAID_PAYMENT)
        .groupBy("tipo", dates.day(F.col("fecha_pagado")).alias("fecha"))
        .agg(F.count("*").alias("n"), money_sum(F.col("monto")).alias("valor"))
    )
    return (
        paid.join(payment_types(enum), "tipo")
        .groupBy("nombre", "fecha")
        .agg(F.sum("n").alias("cantidad"), F.sum("valor").alias("valor_total"))
        .select("nombre", "cantidad", "valor_total", "fecha")
    )


def payment_type_daily(pagos: DataFrame, enum: DataFrame, agg_bonos: DataFrame) -> DataFrame:
    """The type days to add (Q15)."""
    return m.new_rows(agg_bonos, payment_types_daily(pagos, enum), BUCKET_KEY)


def refresh_daily(agg: DataFrame, source: DataFrame) -> DataFrame:
    """The refreshing alternative to G3 and G4 that Q15 asks for: late rows of a day count."""
    return m.upsert(agg, source, BUCKET_KEY)
