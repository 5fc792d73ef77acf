"""Assets under management (U1-U4) and the contract fact built like U3.

Every partner filter is a semi join after a sum per partner, so neither side of it can have a
hot key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import dates
from ledgerloom.functions.labels import label_of
from ledgerloom.functions.money import clean_money, money_or_zero, money_sum
from ledgerloom.plans.kpis import active_partners


def open_products(
    socio_productos: DataFrame,
    socios: DataFrame,
    excluded_products: Sequence[int] = fixed.PASS_EXCLUDED_PRODUCTS,
) -> DataFrame:
    """Last purchase, balance and capital of open products of active partners (Q22)."""
    per_partner = (
        socio_productos.where("cerrado IS FALSE")
        .where(~F.col("producto").isin(*excluded_products))
        .groupBy("socio")
        .agg(
            F.max(dates.day(F.col("fecha_compra"))).alias("ultimo"),
            money_sum(F.col("saldo")).alias("saldo"),
            money_sum(F.col("capital")).alias("capital"),
        )
    )
    return per_partner.join(active_partners(socios), "socio", "left_semi").agg(
        F.max("ultimo").alias("fecha_ultimo_plan"),
        F.sum("saldo").alias("saldo_total_productos"),
        F.sum("capital").alias("capital_inicial_total_productos"),
    )


def pending_total(
    pagos: DataFrame, excluded_types: Sequence[int] = fixed.PENDING_BONUS_EXCLUDED
) -> DataFrame:
    """Last planned day and sum of pending payments."""
    return (
        pagos.where(F.col("estatus") == fixed.PENDING_PAYMENT)
        .where(~F.col("tipo").isin(*excluded_types))
        .agg(
            F.max(dates.day(F.col("fecha_pago"))).alias("fecha_ultimo_bono"),
            money_sum(F.col("monto")).alias("bonos_a_pagar"),
        )
    )


def _contracts(socio_productos: DataFrame, socios: DataFrame, contracts: Sequence[tuple]) -> DataFrame:
    """Open contracts per product: last purchase, name, shown value, years and count."""
    product = F.col("producto")
    per_partner = (
        socio_productos.where("cerrado IS FALSE")
        .where(product.isin(*[c[0] for c in contracts]))
        .groupBy("socio", "producto")
        .agg(F.max(dates.day(F.col("fecha_compra"))).alias("ultima"), F.count("*").alias("n"))
    )
    names = {code: name for code, name, _, _ in contracts}
    values = {code: value for code, _, value, _ in contracts}
    years = {code: span for code, _, _, span in contracts}
    return (
        per_partner.join(active_partners(socios), "socio", "left_semi")
        .groupBy(
            label_of(product, names).alias("nombre"),
            label_of(product, values).alias("valor"),
            label_of(product, years).alias("plazo"),
        )
        .agg(F.max("ultima").alias("ultima"), F.sum("n").alias("cantidad_de_select"))
    )


def select_contracts(
    socio_productos: DataFrame, socios: DataFrame, contracts: Sequence[tuple] = fixed.SELECT_CONTRACTS
) -> DataFrame:
    """due day, name, numeric value, count and total value of open contracts."""
    value = clean_money(F.col("valor"), "decimal(18,2)")
    return _contracts(socio_productos, socios, contracts).select(
        dates.plus_years(F.col("ultima"), F.col("plazo")).alias("fecha_compra"),
        "nombre",
        value.alias("valor_contrato"),
        "cantidad_de_select",
        (value * F.col("cantidad_de_select")).alias("valor_total"),
    )


def select_contracts_text(
    socio_productos: DataFrame, socios: DataFrame, contracts: Sequence[tuple] = fixed.SELECT_CONTRACTS
) -> DataFrame:
    """As F17 under the AUM table's column names."""
    return select_contracts(socio_productos, socios, contracts).withColumnsRenamed(
        {"fecha_compra": "fecha_ultimo_pago", "nombre": "tipo_select"}
    )


def contracts_as_shown(
    socio_productos: DataFrame, socios: DataFrame, contracts: Sequence[tuple] = fixed.SELECT_CONTRACTS
) -> DataFrame:
    """R13's form: the contract value stays the text people see."""
    value = clean_money(F.col("valor"), "decimal(18,2)")
    return _contracts(socio_productos, socios, contracts).select(
        dates.plus_years(F.col("ultima"), F.col("plazo")).alias("fecha_compra"),
        "nombre",
        F.col("valor").alias("valor_contrato"),
        "cantidad_de_select",
        (value * F.col("cantidad_de_select")).alias("valor_total"),
    )


def select_bonus_sums(
    pagos: DataFrame,
    socio_productos: DataFrame,
    bonuses: Mapping[int, str] = fixed.SELECT_BONUSES,
    products: Sequence[int] = tuple(c[0] for c in fixed.SELECT_CONTRACTS),
) -> DataFrame:
    """Paid bonuses per type, of partners who hold or held a contract product."""
    per_partner = (
        pagos.where(F.col("tipo").isin(*bonuses) & (F.col("estatus") == fixed.PAID_PAYMENT))
        .groupBy("socio", "tipo")
        .agg(money_sum(F.col("monto")).alias("pagado"))
    )
    holders = socio_productos.where(F.col("producto").isin(*products)).select("socio").distinct()
    return (
        per_partner.join(holders, "socio", "left_semi")
        .groupBy("tipo")
        .agg(F.sum("pagado").alias("total"))
        .select(label_of(F.col("tipo"), bonuses).alias("tipo_bono"), "tipo", "total")
    )


def bonus_paid_by_type(pagos: DataFrame, socio_productos: DataFrame, **parameters) -> DataFrame:
    """U4."""
    sums = select_bonus_sums(pagos, socio_productos, **parameters)
    return sums.select("tipo_bono", money_or_zero(F.col("total")).alias("total"))
