"""Purchase facts: annuities, memberships and plan sales."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import compare
from ledgerloom.functions.labels import payment_method, purchase_status
from ledgerloom.operators import maintenance as m

PURCHASE_WATCH = (
    "pago_insuficiente", "pago_excedido", "complemento",
    "id_complemento", "monto_complementario", "estatus",
)
PURCHASE_UPDATE = m.Update(("id_compra",), PURCHASE_WATCH, comparable=compare.null_as_false)


def _fact_rows(
    compras: DataFrame,
    productos: DataFrame,
    promociones: DataFrame,
    item_type: int,
    method: Column,
    product: Column,
) -> DataFrame:
    """Columns shared by both facts.

    The product is looked up by item type (Q24), which the filter fixes to one code.  Grouped by
    that code the lookup is one row at most, safe to broadcast, and purchases are not shuffled
    on a constant.
    """
    plan = (
        productos.where(F.col("producto") == item_type)
        .groupBy(F.col("producto").alias("tipo_item"))
        .agg(F.max("nombre").alias("plan"))
    )
    offers = promociones.select("promocion", F.col("nombre").alias("oferta"))
    return (
        compras.join(offers, "promocion", "left")
        .join(F.broadcast(plan), "tipo_item", "left")
        .select(
            F.col("compra").alias("id_compra"),
            F.col("socio").alias("id_socio"),
            F.col("prospecto").alias("id_prospecto"),
            "fecha_pago",
            method.alias("forma_pago"),
            purchase_status(F.col("estatus")).alias("estatus"),
            F.col("oferta").alias("promocion"),
            F.col("plan").alias("tipo_plan"),
            F.col("plan").alias("tipo_smartpack"),
            product.alias("tipo_producto"),
            "precio",
            "moneda",
            "precio_btc",
            "cotiza_btc",
            "cotiza_btc2",
            "monto_pagado",
            "monto_pagado_btc",
            F.col("fue_insuficiente").alias("pago_insuficiente"),
            F.col("es_excedido").alias("pago_excedido"),
            "avance_pago",
            F.col("es_complementario").alias("complemento"),
            F.col("complemento_de").alias("id_complemento"),
            "monto_complementario",
        )
    )


def _settled(compras: DataFrame, item_type: int) -> DataFrame:
    """Paid purchases of the item type that do not complete another purchase."""
    return compras.where(
        (F.col("tipo_item") == item_type)
        & (F.col("estatus") == fixed.PAID_PURCHASE)
        & F.col("es_complementario").isNull()
    )


def _membership_product() -> Column:
    return F.when(F.col("socio").isNotNull(), fixed.MEMBERSHIP_OF_PARTNER).when(
        F.col("prospecto").isNotNull(), fixed.MEMBERSHIP_OF_PROSPECT
    )


def annuities(
    compras: DataFrame, productos: DataFrame, promociones: DataFrame, house_account: str
) -> DataFrame:
    """the whole content of the fact (M7)."""
    return _fact_rows(
        _settled(compras, fixed.ANNUITY_ITEM),
        productos,
        promociones,
        fixed.ANNUITY_ITEM,
        payment_method(fixed.ANNUITY_METHODS, house_account, fixed.UNKNOWN_METHOD),
        F.lit(fixed.ANNUITY_PRODUCT),
    )


def memberships(
    compras: DataFrame, productos: DataFrame, promociones: DataFrame, house_account: str = ""
) -> DataFrame:
    """F8: the whole content of the fact (M7)."""
    return _fact_rows(
        _settled(compras, fixed.MEMBERSHIP_ITEM),
        productos,
        promociones,
        fixed.MEMBERSHIP_ITEM,
        payment_method(fixed.MEMBERSHIP_METHODS, house_account, fixed.UNKNOWN_METHOD),
        _membership_product(),
    )


def purchases_update_source(compras: DataFrame, item_type: int) -> DataFrame:
    """All purchases of the item type are compared, paid or not; missing flags count as False
    and are written as False.  The columns the update does not look at are never read."""
    return compras.where(F.col("tipo_item") == item_type).select(
        F.col("compra").alias("id_compra"),
        F.coalesce("fue_insuficiente", F.lit(False)).alias("pago_insuficiente"),
        F.coalesce("es_excedido", F.lit(False)).alias("pago_excedido"),
        F.coalesce("es_complementario", F.lit(False)).alias("complemento"),
        F.col("complemento_de").alias("id_complemento"),
        "monto_complementario",
        purchase_status(F.col("estatus")).alias("estatus"),
    )


def annuities_changed(compras: DataFrame, fact_anualidades: DataFrame) -> DataFrame:
    """F7."""
    source = purchases_update_source(compras, fixed.ANNUITY_ITEM)
    return PURCHASE_UPDATE.state(fact_anualidades, source)


def memberships_changed(compras: DataFrame, fact_membresias: DataFrame) -> DataFrame:
    """F9."""
    source = purchases_update_source(compras, fixed.MEMBERSHIP_ITEM)
    return PURCHASE_UPDATE.state(fact_membresias, source)


def purchase_labels(
    compras: DataFrame, item_type: int, rules: Iterable[tuple], house_account: str
) -> DataFrame:
    """Labels of every purchase of an item type, in any of the rule variants."""
    return compras.where(F.col("tipo_item") == item_type).select(
        F.col("compra").alias("id_compra"),
        payment_method(rules, house_account, fixed.UNKNOWN_METHOD).alias("forma_pago"),
        purchase_status(F.col("estatus")).alias("estatus"),
    )


def sales_source(
    socio_productos: DataFrame,
    compras: DataFrame,
    productos: DataFrame,
    since: dt.date,
    house_account: str,
    excluded_purchases: Sequence[int] = (),
) -> DataFrame:
    """Base plans bought since a day, with price and payment label of their purchase.

    The product name is looked up by the purchase's item (Q24), on the narrow purchase columns.
    """
    owned = socio_productos.where(
        (F.col("fecha_compra") >= F.lit(since)) & F.col("plan_base").isNull()
    )
    if excluded_purchases:
        owned = owned.where(~F.col("compra").isin(*excluded_purchases))
    names = productos.select(F.col("producto").alias("item"), F.col("nombre").alias("nombre_producto"))
    bought = compras.join(names, "item", "left").select(
        "compra",
        "precio",
        "nombre_producto",
        "forma_pago",
        "entidad_pago",
        "referencia",
        "referencia2",
        "referencia3",
    )
    method = payment_method(fixed.SALES_METHODS, house_account, fixed.UNKNOWN_METHOD)
    return owned.join(bought, "compra", "left").select(
        F.col("compra").alias("id_compra"),
        F.col("socio").alias("id_socio"),
        F.col("producto").alias("id_producto"),
        "nombre_producto",
        "activo",
        "cerrado",
        "capital_inicial",
        "moneda",
        "capital",
        "saldo",
        "fecha_compra",
        "fecha_inicio",
        "fecha_cierre",
        "estatus",
        "plazo_forzoso",
        "plan_base",
        "precio",
        method.alias("tipo_pago"),
    )


def sales_year_replace(source: DataFrame, fact_ventas: DataFrame, year: int) -> DataFrame:
    """sales from the first day of the year on are replaced, later years included; earlier ones
    and rows without a day stay (Q8 fixed: what is cleared is what is loaded)."""
    at, start = F.col("fecha_compra"), F.lit(dt.date(year, 1, 1))
    return fact_ventas.where(at.isNull() | (at < start)).unionByName(source.where(at >= start))
