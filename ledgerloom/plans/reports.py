"""Finance reports (R1-R14).  `sources.reports.write_report` stores them.

Orders that a report promises end in a unique column: range partitioning can then cut inside a
day or a partner that holds a large part of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import dates, labels
from ledgerloom.functions.money import CRYPTO, btc_text, btc_text_or_zero, money, money_sum
from ledgerloom.plans import aum
from ledgerloom.plans.payments import payment_types


def _gateway(method: Column) -> Column:
    return F.when(method == fixed.CARD_METHOD, fixed.CARD_GATEWAY).otherwise(fixed.UNKNOWN_LABEL)


def _names(socios: DataFrame, alias: str = "nombre_socio") -> DataFrame:
    return socios.select("socio", labels.full_name().alias(alias))


def _paid_alone(compras: DataFrame, item_type: int) -> DataFrame:
    return compras.where(
        (F.col("tipo_item") == item_type)
        & (F.col("estatus") == fixed.PAID_PURCHASE)
        & F.col("es_complementario").isNull()
    )


def active_partners(socios: DataFrame, excluded: Sequence[int] = ()) -> DataFrame:
    """R1, ordered by join date."""
    rows = socios.where(F.col("estatus").isin(*fixed.ACTIVE_PARTNERS))
    if excluded:
        rows = rows.where(~F.col("socio").isin(*excluded))
    return rows.select("socio", dates.day(F.col("fecha_ingreso")).alias("fecha_ingreso")).orderBy(
        F.col("fecha_ingreso").asc_nulls_last(), "socio"
    )


def maintenance_gateway(compras: DataFrame, socios: DataFrame) -> DataFrame:
    """R2: annuities through the card gateway, newest first."""
    rows = _paid_alone(compras, fixed.ANNUITY_ITEM).where(F.col("forma_pago") == fixed.CARD_METHOD)
    return (
        rows.join(_names(socios), "socio", "left")
        .select(
            "socio",
            "nombre_socio",
            F.lit(fixed.COMPLETED).alias("estatus_compra"),
            F.lit(fixed.MAINTENANCE_PRODUCT).alias("tipo_de_producto"),
            F.lit(fixed.CARD_GATEWAY).alias("plataforma_cobro"),
            "precio",
            "moneda",
            F.col("referencia").alias("id_transaccion"),
            dates.day(F.col("fecha_insert")).alias("fecha_de_pago"),
            "observaciones",
        )
        .orderBy(F.col("fecha_de_pago").desc_nulls_first(), "id_transaccion")
    )


def courses(
    purchases: DataFrame, catalogue: DataFrame, socios: DataFrame, statuses: Sequence[int] = (4, 6)
) -> DataFrame:
    """Course purchases with a price; times are UTC under the UTC session."""
    rows = purchases.where(
        F.col("estatus").isin(*statuses) & (money(F.col("precio")) != 0)
    )
    titles = catalogue.select(
        F.col("id_curso").alias("item"), F.col("nombre").alias("nombre_curso"), "ponentes"
    )
    return (
        rows.join(titles, "item", "left")
        .join(_names(socios), "socio", "left")
        .select(
            "socio",
            "nombre_socio",
            "nombre_curso",
            F.when(F.col("estatus").isin(4, 6), fixed.COMPLETED)
            .when(F.col("estatus") == -1, fixed.RETURNED)
            .otherwise(fixed.UNKNOWN_LABEL)
            .alias("estatus_compra"),
            _gateway(F.col("forma_pago")).alias("plataforma_cobro"),
            "precio",
            "moneda",
            F.col("referencia").alias("id_transaccion"),
            "ponentes",
            F.coalesce("fecha_pago", "fecha_pagado").alias("fecha_de_pago"),
            "observaciones",
        )
    )


def memberships_gateway(
    compras: DataFrame,
    prospectos: DataFrame,
    socios: DataFrame,
    prices: Mapping = fixed.MEMBERSHIP_PRICES,
) -> DataFrame:
    """prospects' memberships through the card gateway, class by exact price.

    The source query also joins the product table and uses nothing of it; on its primary key that
    changes no row, so the join is left out.
    """
    rows = _paid_alone(compras, fixed.MEMBERSHIP_ITEM).where(
        (F.col("forma_pago") == fixed.CARD_METHOD) & F.col("socio").isNull()
    )
    partners = _names(socios, "nombre").withColumnRenamed("socio", "nuevo_socio")
    became = prospectos.select("prospecto", "nuevo_socio")
    return (
        rows.drop("socio")
        .join(became, "prospecto", "left")
        .join(partners.withColumn("socio", F.col("nuevo_socio")), "nuevo_socio", "left")
        .select(
            "socio",
            "nombre",
            F.lit(fixed.COMPLETED).alias("estatus_compra"),
            labels.label_of(
                money(F.col("precio")), prices, fixed.UNKNOWN_LABEL
            ).alias("tipo_de_producto"),
            F.lit(fixed.CARD_GATEWAY).alias("plataforma_cobro"),
            "moneda",
            "monto_pagado",
            F.col("hash").alias("id_transaccion"),
            dates.day(F.col("fecha_insert")).alias("fecha_insert"),
            F.col("fecha_pago").alias("fecha_de_pago"),
            "observaciones",
        )
    )


def _gateway_columns() -> list[Column | str]:
    return [
        "socio",
        F.col("referencia").alias("id_transaccion"),
        labels.label_of(
            F.col("forma_pago"), fixed.GATEWAY_METHODS, fixed.GATEWAY_UNKNOWN
        ).alias("plataforma"),
        "forma_pago",
        "monto_pagado",
        btc_text_or_zero(F.col("monto_pagado_btc")).alias("btc"),
        "monto_pagado_btc",
        dates.day(F.col("fecha_insert")).alias("fecha_pago"),
    ]


def maintenance_all(compras: DataFrame) -> DataFrame:
    """Annuities through every gateway."""
    return _paid_alone(compras, fixed.ANNUITY_ITEM).select(*_gateway_columns())


def memberships_all(compras: DataFrame, prospectos: DataFrame, socios: DataFrame) -> DataFrame:
    """Memberships of prospects who became partners, through every gateway."""
    became = prospectos.select("prospecto", F.col("nuevo_socio").alias("socio"))
    return (
        _paid_alone(compras, fixed.MEMBERSHIP_ITEM)
        .drop("socio")
        .join(became, "prospecto")
        .join(socios.select("socio"), "socio")
        .select(*_gateway_columns())
    )


def bonus_daily(
    pagos: DataFrame, enum: DataFrame, types: Sequence[int] = fixed.REPORTED_BONUS_TYPES
) -> DataFrame:
    """Paid payments by type and day, summed before the names are joined."""
    sums = (
        pagos.where((F.col("estatus") == fixed.PAID_PAYMENT) & F.col("tipo").isin(*types))
        .groupBy("tipo", dates.day(F.col("fecha_pagado")).alias("fecha_pagado"))
        .agg(F.count("*").alias("numero"), money_sum(F.col("monto")).alias("total"))
    )
    return sums.join(payment_types(enum), "tipo").select(
        "numero", "nombre", "tipo", "total", "fecha_pagado"
    )


def bonus_tiers(
    pagos: DataFrame, enum: DataFrame, tiers: Mapping = fixed.MASTER_BONUS_TIERS
) -> DataFrame:
    """Paid master bonuses by amount and day, tier by exact amount."""
    amount = money(F.col("monto"))
    sums = (
        pagos.where(
            (F.col("estatus") == fixed.PAID_PAYMENT)
            & (F.col("tipo") == fixed.MASTER_BONUS_TYPE)
            & (amount != 0)
        )
        .groupBy("tipo", amount.alias("monto"), dates.day(F.col("fecha_pagado")).alias("fecha_pagado"))
        .agg(F.count("*").alias("numero"), F.sum(amount).alias("total"))
    )
    tier = labels.label_of(F.col("monto"), tiers, fixed.MASTER_BONUS_OTHER)
    return sums.join(payment_types(enum), "tipo").select(
        "numero", tier.alias("nivel"), "monto", "nombre", "tipo", "total", "fecha_pagado"
    )


def _transfers_daily(pagos_transacciones: DataFrame, text: str) -> DataFrame:
    sums = (
        pagos_transacciones.where(F.col("estatus").isin(*fixed.REPORTED_TRANSFER_STATUS))
        .groupBy(dates.day(F.col("fecha_pagado")).alias("fecha_pagado"))
        .agg(
            money_sum(F.col("monto")).alias("usd"),
            F.sum(F.col("monto_pagado_btc").cast(CRYPTO)).alias("cripto"),
        )
    )
    shown = btc_text if text == "always" else btc_text_or_zero
    return sums.select("usd", shown(F.col("cripto")).alias("btc"), "fecha_pagado")


def inflows(pagos_transacciones: DataFrame) -> DataFrame:
    """Sums per day (Q17, Q18)."""
    return _transfers_daily(pagos_transacciones, "always")


def outflows(pagos_transacciones: DataFrame) -> DataFrame:
    """The same rows (Q18), a plain `0` on days without crypto."""
    return _transfers_daily(pagos_transacciones, "zero")


def aum_products(socio_productos: DataFrame, socios: DataFrame) -> DataFrame:
    """U1 under the report's column names."""
    return aum.open_products(socio_productos, socios).withColumnsRenamed(
        {"fecha_ultimo_plan": "max"}
    )


def aum_pending(pagos: DataFrame) -> DataFrame:
    """U2 under the report's column names."""
    return aum.pending_total(pagos).withColumnsRenamed(
        {"fecha_ultimo_bono": "max", "bonos_a_pagar": "sum"}
    )


def aum_contracts(socio_productos: DataFrame, socios: DataFrame) -> DataFrame:
    """R13."""
    return aum.contracts_as_shown(socio_productos, socios)


def aum_contract_bonuses(pagos: DataFrame, socio_productos: DataFrame) -> DataFrame:
    """U4 with the type, and without the zero default."""
    return aum.select_bonus_sums(pagos, socio_productos).select(
        F.col("tipo_bono").alias("nombre_bono"), "tipo", F.col("total").alias("sum")
    )
