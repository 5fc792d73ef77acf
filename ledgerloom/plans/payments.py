"""Payment facts: withdrawals, master bonuses, bonuses and commissions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions.dates import day
from ledgerloom.functions.labels import coin
from ledgerloom.operators import maintenance as m

WITHDRAWAL_WATCH = ("fecha_pago", "fecha_cancelacion", "fecha_pago_estimada")
# a change of status alone does not trigger (Q3)
WITHDRAWAL_UPDATE = m.Update(
    ("id_retiro",), WITHDRAWAL_WATCH, ("estatus", "fecha_solicitud", *WITHDRAWAL_WATCH)
)

BONUS_DATES = ("fecha_solicitud", "fecha_pago_estimada", "fecha_pagado", "fecha_cancelacion")
BONUS_WATCH = ("estatus", *BONUS_DATES)
BONUS_ASSIGN = (*BONUS_WATCH, *[f"fk_{d}" for d in BONUS_DATES], "defi")
MASTERBONUS_UPDATE = m.Update(("id_masterbonus",), BONUS_WATCH, BONUS_ASSIGN)
BONUS_UPDATE = m.Update(("id_retiro",), BONUS_WATCH, BONUS_ASSIGN)


def withdrawals_source(pagos: DataFrame, excluded_partner: int | None = None) -> DataFrame:
    """Withdrawals; with an excluded partner, rows without a partner drop out too."""
    rows = pagos.where(F.col("tipo") == fixed.WITHDRAWAL_TYPE)
    if excluded_partner is not None:
        rows = rows.where(F.col("socio") != excluded_partner)
    return rows.select(
        F.col("pago").alias("id_retiro"),
        F.col("socio").alias("id_socio"),
        "tipo",
        "monto",
        F.col("monto_pagado_btc").alias("monto_pagado_cripto"),
        F.col("cotiza_btc").alias("cotiza_cripto"),
        "estatus",
        F.col("fecha").alias("fecha_solicitud"),
        F.col("fecha_pago").alias("fecha_pago_estimada"),
        F.col("fecha_pagado").alias("fecha_pago"),
        "fecha_cancelacion",
        "defi",
    )


def withdrawals_new(
    pagos: DataFrame, fact_retiros: DataFrame, excluded_partner: int | None = None
) -> DataFrame:
    """F1."""
    return m.new_rows(fact_retiros, withdrawals_source(pagos, excluded_partner), ["id_retiro"])


def withdrawals_changed(pagos: DataFrame, fact_retiros: DataFrame) -> DataFrame:
    """F2."""
    return WITHDRAWAL_UPDATE.state(fact_retiros, withdrawals_source(pagos))


def _bonus_rows(pagos: DataFrame, id_name: str) -> DataFrame:
    """Shape shared by both bonus facts: dates cut to days, each also as a calendar key."""
    request, planned, paid, cancelled = BONUS_DATES
    days = {request: "fecha", planned: "fecha_pago", paid: "fecha_pagado", cancelled: "fecha_cancelacion"}
    return pagos.select(
        F.col("pago").alias(id_name),
        F.col("socio").alias("id_socio"),
        "monto",
        F.col("monto_pagado_btc").alias("monto_pagado_cripto"),
        F.col("cotiza_btc").alias("cotiza_cripto"),
        "estatus",
        *[
            day(F.col(source)).alias(prefix + name)
            for name, source in days.items()
            for prefix in ("", "fk_")
        ],
        "defi",
        coin(F.col("mtd_dsp")).alias("moneda"),
        F.col("pago_tx").cast("int").alias("pago_tx"),
    )


def with_dates_as_days(target: DataFrame) -> DataFrame:
    """Both sides compare whole days, whether the target keeps dates or timestamps (Q13)."""
    return target.withColumns({d: day(F.col(d)) for d in BONUS_DATES})


def masterbonus_source(pagos: DataFrame) -> DataFrame:
    return _bonus_rows(pagos.where(F.col("tipo") == fixed.MASTER_BONUS_TYPE), "id_masterbonus")


def masterbonus_new(pagos: DataFrame, fact_masterbonus: DataFrame) -> DataFrame:
    """F4."""
    return m.new_rows(fact_masterbonus, masterbonus_source(pagos), ["id_masterbonus"])


def masterbonus_changed(pagos: DataFrame, fact_masterbonus: DataFrame) -> DataFrame:
    """F5."""
    return MASTERBONUS_UPDATE.state(with_dates_as_days(fact_masterbonus), masterbonus_source(pagos))


def payment_types(enum: DataFrame) -> DataFrame:
    """The enumeration's payment types as `(tipo, nombre)`."""
    return enum.where(F.col("categoria") == fixed.PAYMENT_CATEGORY).select(
        F.col("codigo").alias("tipo"), "nombre"
    )


def bonuses_source(pagos: DataFrame, enum: DataFrame) -> DataFrame:
    """Paid payments of a known type; the filter on the enumeration makes the join inner."""
    paid = pagos.where(F.col("estatus") == fixed.PAID_PAYMENT)
    return _bonus_rows(paid.join(payment_types(enum), "tipo"), "id_retiro")


def bonuses_new(pagos: DataFrame, enum: DataFrame, fact_bonos_comisiones: DataFrame) -> DataFrame:
    """F10."""
    return m.new_rows(fact_bonos_comisiones, bonuses_source(pagos, enum), ["id_retiro"])


def bonuses_changed(pagos: DataFrame, enum: DataFrame, fact_bonos_comisiones: DataFrame) -> DataFrame:
    """F11."""
    source = bonuses_source(pagos, enum)
    return BONUS_UPDATE.state(with_dates_as_days(fact_bonos_comisiones), source)
