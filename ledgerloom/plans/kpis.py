"""KPI tables: balance, liabilities, payment share, repurchase, retention, reconciliation
(F18-F24).

Shared rule: aggregate first, join afterwards.  A partner or a day that holds a large part of
all rows is then one row per map task by the time anything is shuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import dates, labels
from ledgerloom.functions.money import CRYPTO, MONEY, clean_money, money, money_or_zero, money_sum, percent
from ledgerloom.operators import maintenance as m
from ledgerloom.operators.calendar import day_calendar

BALANCE_IN = ("anualidades", "membresias", "venta_planes")
BALANCE_OUT = ("bonos_y_comisiones", "masterbonos", "retiros")


def active_partners(socios: DataFrame) -> DataFrame:
    return socios.where(F.col("estatus").isin(*fixed.ACTIVE_PARTNERS)).select("socio")


def _amount_where(condition: Column, amount: Column) -> Column:
    return F.when(condition, amount).otherwise(F.lit(0).cast(MONEY))


def daily_balance(
    compras: DataFrame, pagos: DataFrame, start: dt.date, as_of: dt.date
) -> DataFrame:
    """income and expense per calendar day, days without movement included.

    Purchases, payments and the empty calendar are stacked and summed by day, which takes one
    shuffle of at most one row per day and map task, and no join.
    """
    paid, item = money(F.col("monto_pagado")), F.col("tipo_item")
    sent, kind = money(F.col("monto")), F.col("tipo")
    nothing = F.lit(0).cast(MONEY)

    income = compras.where(
        (F.col("estatus") == fixed.PAID_PURCHASE) & dates.in_days(F.col("fecha_pago"), start, as_of)
    ).select(
        dates.day(F.col("fecha_pago")).alias("fecha"),
        _amount_where(item == fixed.ANNUITY_ITEM, paid).alias("anualidades"),
        _amount_where(item == fixed.MEMBERSHIP_ITEM, paid).alias("membresias"),
        _amount_where(
            ~item.isin(fixed.MEMBERSHIP_ITEM, fixed.ANNUITY_ITEM), paid
        ).alias("venta_planes"),
        *[nothing.alias(c) for c in BALANCE_OUT],
    )
    expense = pagos.where(
        (F.col("estatus") == fixed.PAID_PAYMENT) & dates.in_days(F.col("fecha_pagado"), start, as_of)
    ).select(
        dates.day(F.col("fecha_pagado")).alias("fecha"),
        *[nothing.alias(c) for c in BALANCE_IN],
        _amount_where(
            ~kind.isin(fixed.WITHDRAWAL_TYPE, fixed.MASTER_BONUS_TYPE), sent
        ).alias("bonos_y_comisiones"),
        _amount_where(kind == fixed.MASTER_BONUS_TYPE, sent).alias("masterbonos"),
        _amount_where(kind == fixed.WITHDRAWAL_TYPE, sent).alias("retiros"),
    )
    empty = day_calendar(compras.sparkSession, start, as_of).select(
        "fecha", *[nothing.alias(c) for c in (*BALANCE_IN, *BALANCE_OUT)]
    )
    days = (
        income.unionByName(expense)
        .unionByName(empty)
        .groupBy("fecha")
        .agg(*[F.sum(c).alias(c) for c in (*BALANCE_IN, *BALANCE_OUT)])
    )
    total = sum((F.col(c) for c in BALANCE_IN[1:]), F.col(BALANCE_IN[0]))
    for column in BALANCE_OUT:
        total = total - F.col(column)
    return days.withColumn("total", total)


def client_liabilities(
    socio_productos: DataFrame,
    socios: DataFrame,
    pagos: DataFrame,
    excluded_products: Sequence[int] = fixed.PASS_EXCLUDED_PRODUCTS,
) -> DataFrame:
    """open product balance of active partners less their pending withdrawals."""
    owed = (
        socio_productos.where("cerrado IS FALSE")
        .where(~F.col("producto").isin(*excluded_products))
        .groupBy("socio")
        .agg(money_sum(F.col("saldo")).alias("pasivo_productos"))
        .join(active_partners(socios), "socio", "left_semi")
    )
    pending = (
        pagos.where(
            (F.col("estatus") == fixed.PENDING_PAYMENT) & (F.col("tipo") == fixed.WITHDRAWAL_TYPE)
        )
        .groupBy("socio")
        .agg(money_sum(F.col("monto")).alias("pendiente"))
    )
    waiting = money_or_zero(F.col("pendiente"))
    return owed.join(pending, "socio", "left").select(
        F.col("socio").alias("id_socio"),
        "pasivo_productos",
        waiting.alias("pasivo_pagos_pendientes"),
        (F.col("pasivo_productos") - waiting).alias("liabilities"),
    )


def client_paid_share(pagos: DataFrame, excluded_partners: Sequence[int] = ()) -> DataFrame:
    """pending and paid amounts of partners with anything pending, paid in percent of
    pending.  One pass and one shuffle: both sums are conditional sums of the same group."""
    state, amount = F.col("estatus"), money(F.col("monto"))
    rows = pagos.where(
        state.isin(fixed.PENDING_PAYMENT, fixed.PAID_PAYMENT) & F.col("socio").isNotNull()
    )
    if excluded_partners:
        rows = rows.where(~F.col("socio").isin(*excluded_partners))
    sums = rows.groupBy("socio").agg(
        F.count_if(state == fixed.PENDING_PAYMENT).alias("n"),
        money_or_zero(F.sum(F.when(state == fixed.PENDING_PAYMENT, amount))).alias("pendiente"),
        money_or_zero(F.sum(F.when(state == fixed.PAID_PAYMENT, amount))).alias("realizado"),
    )
    # in doubles: a decimal division would cut the digits the percentage needs (7.6)
    share = F.col("realizado").cast("double") * 100 / F.col("pendiente").cast("double")
    return sums.where(F.col("n") > 0).select(
        F.col("socio").alias("id_socio"),
        F.col("pendiente").alias("pasivo_pagos_pendientes"),
        F.col("realizado").alias("pasivo_pagos_realizados"),
        F.when(F.col("pendiente") != 0, share).alias("porcentajes_pago"),
    )


def repurchase_monthly(compras: DataFrame, since: dt.date) -> DataFrame:
    """per month, paid plan purchases, first ones and repeated ones.

    The first purchase is the first since `since` (Q20) and purchases without a partner count as
    one partner, as in a window over the partner.  Numbering every purchase is not needed: each
    partner has exactly one first purchase, in the earliest month.  So the window runs over one row
    per partner and month, and a partner with very many purchases is a few rows in it.
    """
    sales = compras.where(
        (F.col("estatus") == fixed.PAID_PURCHASE)
        & ~F.col("tipo_item").isin(*fixed.NON_PLAN_ITEMS)
        & (F.col("fecha_pago") >= F.lit(since))
    )
    by_partner = sales.groupBy("socio", dates.month(F.col("fecha_pago")).alias("mes")).agg(
        F.count("*").alias("n")
    )
    earliest = F.min("mes").over(Window.partitionBy("socio"))
    months = (
        by_partner.withColumn("primera", (F.col("mes") == earliest).cast("bigint"))
        .groupBy("mes")
        .agg(F.sum("n").alias("total_compras"), F.sum("primera").alias("primeras_compras"))
    )
    again = F.col("total_compras") - F.col("primeras_compras")
    return months.select(
        "mes",
        "total_compras",
        "primeras_compras",
        again.alias("recompras"),
        percent(again, F.col("total_compras")).alias("pct_recompra"),
    )


def retention_monthly(dues: DataFrame, annuities: DataFrame, year: int) -> DataFrame:
    """per due month, partners who paid in time, late, or not at all (Q21).

    `dues` has `(id_socio, pago_anualidad)`.  Partners are reduced to one row per month before
    counting, so the distinct counts need no expansion of the rows.
    """
    paid = (
        annuities.where(
            dates.in_days(F.col("fecha_pago"), dt.date(year, 1, 1), dt.date(year, 12, 31))
        )
        .groupBy("id_socio")
        .agg(F.max(dates.day(F.col("fecha_pago"))).alias("pagado"))
    )
    due, last = F.col("pago_anualidad").cast("date"), F.col("pagado")
    state = F.when(last.isNull(), "abandono").when(last <= due, "retenido").otherwise("recuperado")
    states = ("retenido", "abandono", "recuperado")
    partners = (
        dues.join(paid, "id_socio", "left")
        .groupBy(dates.month(due).alias("mes_venc"), "id_socio")
        .agg(*[F.max((state == s).cast("int")).alias(s) for s in states])
    )
    known = F.col("id_socio").isNotNull()
    months = partners.groupBy("mes_venc").agg(
        *[F.count_if((F.col(s) == 1) & known).alias(s) for s in states],
        F.count("id_socio").alias("total_mes"),
    )
    total = F.col("total_mes")
    return months.select(
        "mes_venc",
        *states,
        "total_mes",
        percent(F.col("retenido"), total).alias("pct_retencion"),
        percent(F.col("abandono"), total).alias("pct_abandono"),
        percent(F.col("recuperado"), total).alias("pct_recuperacion"),
    )


def reconciled_sales_source(compras: DataFrame) -> DataFrame:
    """Paid purchases through on-chain methods, amounts cleaned."""
    return compras.where(
        (F.col("estatus") == fixed.PAID_PURCHASE)
        & F.col("forma_pago").isin(*fixed.ONCHAIN_METHODS)
    ).select(
        "compra",
        "socio",
        "prospecto",
        "tipo_item",
        "item",
        "item2",
        labels.label_of(F.col("forma_pago"), fixed.ONCHAIN_METHODS).alias("forma_pago"),
        "promocion",
        "wallet_destino",
        clean_money(F.col("precio")).alias("precio"),
        "moneda",
        clean_money(F.col("precio_btc"), CRYPTO).alias("precio_btc"),
        clean_money(F.col("cotiza_btc"), CRYPTO).alias("cotiza_btc"),
        clean_money(F.col("monto_pagado")).alias("monto_pagado"),
        clean_money(F.col("monto_pagado_btc"), CRYPTO).alias("monto_pagado_btc"),
        "fue_insuficiente",
        "es_complementario",
        "complemento_de",
        "fecha_pago",
        "fecha_insert",
        "referencia2",
        "referencia3",
        "referencia",
        labels.label_of(
            F.col("tipo_item"), fixed.RECONCILED_PRODUCTS, fixed.RECONCILED_OTHER
        ).alias("nombre_del_producto"),
    )


def reconcile_sales(
    compras: DataFrame, fact_conciliacion_ventas: DataFrame, run_ts: Column
) -> DataFrame:
    """F23."""
    source = reconciled_sales_source(compras)
    return m.upsert(fact_conciliacion_ventas, source, ["compra"], "fecha_registro", run_ts)


def reconciled_payments_source(pagos_transacciones: DataFrame, keyword: str) -> DataFrame:
    """Paid transactions whose message has the keyword, amounts cleaned."""
    return pagos_transacciones.where(
        F.col("mensaje").ilike(f"%{keyword}%") & (F.col("estatus") == fixed.PAID_PAYMENT)
    ).select(
        "pago_tx",
        "socio",
        clean_money(F.col("monto")).alias("monto"),
        dates.day(F.col("fecha_pagado")).alias("fecha_pagado"),
        "wallet",
        clean_money(F.col("monto_pagado_btc"), CRYPTO).alias("monto_pagado_btc"),
        clean_money(F.col("cotiza_btc"), CRYPTO).alias("cotiza_btc"),
        "mensaje",
    )


def reconcile_payments(
    pagos_transacciones: DataFrame, fact_conciliacion_pagos: DataFrame, keyword: str, run_ts: Column
) -> DataFrame:
    """F24."""
    source = reconciled_payments_source(pagos_transacciones, keyword)
    return m.upsert(fact_conciliacion_pagos, source, ["pago_tx"], "fecha_registro", run_ts)
