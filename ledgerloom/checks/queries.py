"""The registered queries: each job and operator, run over whole tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import fixed_values as fixed
from ledgerloom.checks import pages
from ledgerloom.checks import parameters as p
from ledgerloom.checks.standins import Tables
from ledgerloom.operators import audit, hierarchy
from ledgerloom.operators import maintenance as m
from ledgerloom.plans import (
    aggregates,
    aum,
    dimensions,
    goals,
    history,
    kpis,
    payments,
    purchases,
    records,
    reports,
)
from ledgerloom.session import apply_sql_settings

REGISTRY: dict[str, Callable[[Tables], DataFrame]] = {}


def query(job: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    REGISTRY[job.__name__] = job
    return job


def comparable(df: DataFrame) -> DataFrame:
    """Types the checking database returns: decimals as doubles, times without a zone."""
    casts = {}
    for field in df.schema:
        if isinstance(field.dataType, T.DecimalType):
            casts[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            casts[field.name] = F.col(field.name).cast("timestamp_ntz")
    return df.withColumns(casts) if casts else df


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def runner(job: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(job(Tables(apply_sql_settings(spark), sf_dir)))

        return run

    return {name: runner(job) for name, job in REGISTRY.items()}


def _run_ts():
    return F.lit(p.RUN_TS).cast("timestamp_ntz")


# --- aggregates and AUM ---------------------------------------------------------------------


@query
def agg_monthly_paid(t):
    annuities = purchases.annuities(
        t("compras"), t("productos"), t("promociones"), p.HOUSE_ACCOUNT
    )
    return aggregates.monthly_paid(annuities, p.SINCE, p.AS_OF)


@query
def agg_monthly_paid_b(t):
    memberships = purchases.memberships(t("compras"), t("productos"), t("promociones"))
    return aggregates.monthly_paid(memberships, p.SINCE, p.AS_OF)


@query
def plan_bucket_daily(t):
    catalogue = t("productos").withColumnRenamed("producto", "id_producto")
    return aggregates.plan_bucket_daily(
        t("ventas"), catalogue, t("prev_agg"), patterns=p.NAME_PATTERNS
    )


@query
def plan_bucket_names(t):
    return aggregates.plan_buckets(t("ventas"), t("plan_catalogue"))


@query
def plan_bucket_refresh(t):
    catalogue = t("productos").withColumnRenamed("producto", "id_producto")
    source = aggregates.plan_buckets(t("ventas"), catalogue, p.NAME_PATTERNS)
    return aggregates.refresh_daily(t("prev_agg"), source)


@query
def payment_type_daily(t):
    return aggregates.payment_type_daily(t("pagos"), t("enumeracion"), t("prev_agg_bonos"))


@query
def aum_open_products(t):
    return aum.open_products(t("socio_productos"), t("socios"))


@query
def pending_total(t):
    return aum.pending_total(t("pagos"))


@query
def select_contracts_text(t):
    return aum.select_contracts_text(t("socio_productos"), t("socios"))


@query
def bonus_paid_by_type(t):
    return aum.bonus_paid_by_type(t("pagos"), t("socio_productos"))


# --- history -----------------------------------------------------------------------------------


def _dim_socios(t):
    return dimensions.partners_source(
        t("socios"), t("v_socio_rangos_defi"), t("socio_info"), t("paises")
    )


@query
def hist_status(t):
    return history.status_history(_dim_socios(t), t("prev_hist_membresias"), _run_ts())


@query
def hist_rank(t):
    return history.rank_history(_dim_socios(t), t("prev_hist_rangos"), _run_ts())


# --- dimensions -----------------------------------------------------------------------------------


@query
def partners_enriched(t):
    return dimensions.partners_new(
        t("socios"), t("v_socio_rangos_defi"), t("socio_info"), t("paises"), t("prev_dim_socios")
    )


@query
def partners_changed(t):
    return dimensions.partners_changed(
        t("socios"), t("v_socio_rangos_defi"), t("prev_dim_socios")
    )


@query
def prospects_new(t):
    return dimensions.prospects_new(
        t("prospectos"), t("prospecto_info"), t("paises"), t("prev_dim_prospectos")
    )


@query
def prospects_changed(t):
    return dimensions.prospects_changed(
        t("prospectos"), t("prospecto_info"), t("prev_dim_prospectos")
    )


def _leaders(t):
    return dimensions.leaders_source(
        t("socios"), t("v_socio_rangos"), t("rangos"), t("socio_info"), p.LEADER_RANKS, p.REGIONS
    )


@query
def first_leader(t):
    return dimensions.leaders_new(_leaders(t), t("prev_primerplatinum"))


@query
def first_leader_changed(t):
    return dimensions.leaders_changed(_leaders(t), t("prev_primerplatinum"))


@query
def goals_members(t):
    joined = t("socios").withColumnRenamed("socio", "id_socio")
    return goals.member_goals(t("primerplatinum_simple"), joined, t("objetivos"), p.YEAR)


@query
def goals_sales(t):
    return goals.sales_goals(t("primerplatinum_simple"), t("ventas"), t("objetivos"), p.YEAR)


@query
def wallet_class(t):
    return records.wallet_balances(pages.wallets(t), p.BUY_WALLETS, p.PAY_WALLETS)


# --- facts: payments --------------------------------------------------------------------------


@query
def withdrawals_new(t):
    return payments.withdrawals_new(t("pagos"), t("prev_retiros"), p.EXCLUDED_PARTNER)


@query
def withdrawals_changed(t):
    return payments.withdrawals_changed(t("pagos"), t("prev_retiros"))


@query
def masterbonus_new(t):
    return payments.masterbonus_new(t("pagos"), t("prev_masterbonus"))


@query
def masterbonus_changed(t):
    return payments.masterbonus_changed(t("pagos"), t("prev_masterbonus"))


@query
def bonuses_new(t):
    return payments.bonuses_new(t("pagos"), t("enumeracion"), t("prev_bonos"))


@query
def bonuses_changed(t):
    return payments.bonuses_changed(t("pagos"), t("enumeracion"), t("prev_bonos"))


# --- facts: purchases -------------------------------------------------------------------------


@query
def sales_year_replace(t):
    source = purchases.sales_source(
        t("socio_productos"), t("compras"), t("productos"), p.YEAR_START, p.HOUSE_ACCOUNT,
        p.EXCLUDED_PURCHASES,
    )
    return purchases.sales_year_replace(source, t("prev_ventas"), p.YEAR)


@query
def annuities(t):
    return purchases.annuities(t("compras"), t("productos"), t("promociones"), p.HOUSE_ACCOUNT)


@query
def annuities_changed(t):
    return purchases.annuities_changed(t("compras"), t("prev_compras"))


@query
def memberships(t):
    return purchases.memberships(t("compras"), t("productos"), t("promociones"))


@query
def memberships_changed(t):
    return purchases.memberships_changed(t("compras"), t("prev_compras"))


@query
def membership_labels_open(t):
    return purchases.purchase_labels(
        t("compras"), fixed.MEMBERSHIP_ITEM, fixed.MEMBERSHIP_METHODS_OPEN, p.HOUSE_ACCOUNT
    )


@query
def annuity_labels_open(t):
    return purchases.purchase_labels(
        t("compras"), fixed.ANNUITY_ITEM, fixed.ANNUITY_METHODS_OPEN, p.HOUSE_ACCOUNT
    )


# --- facts: records -------------------------------------------------------------------------------


@query
def internal_transfers_new(t):
    return records.internal_transfers_new(pages.transfers(t), t("prev_transacciones"))


@query
def json_purchases(t):
    return records.json_purchases_new(pages.purchases(t), t("prev_compras_planes"))


@query
def json_purchases_changed(t):
    return records.json_purchases_changed(pages.purchases(t), t("prev_compras_planes"))


@query
def records_created_between(t):
    span = [dt.datetime.combine(d, dt.time()) for d in (p.SINCE, p.YEAR_END)]
    return records.typed_purchases(pages.purchases(t), tuple(span)).select("id_compra", "fecha_pago")


@query
def json_payouts(t):
    return records.json_payouts_new(pages.payouts(t), t("prev_pagos_planes"))


@query
def json_payouts_changed(t):
    return records.json_payouts_changed(pages.payouts(t), t("prev_pagos_planes"))


# --- facts: KPIs -------------------------------------------------------------------------------------


@query
def select_contracts(t):
    return aum.select_contracts(t("socio_productos"), t("socios"))


@query
def client_liabilities(t):
    return kpis.client_liabilities(t("socio_productos"), t("socios"), t("pagos"))


@query
def client_paid_pct(t):
    return kpis.client_paid_share(t("pagos"), p.EXCLUDED_PARTNERS)


@query
def repurchase_monthly(t):
    return kpis.repurchase_monthly(t("compras"), p.YEAR_START)


@query
def retention_monthly(t):
    return kpis.retention_monthly(t("vencimientos"), t("fact_anualidades"), p.YEAR)


@query
def daily_balance(t):
    return kpis.daily_balance(t("compras"), _payments_of_the_nineties(t), p.YEAR_START, p.YEAR_END)


def _payments_of_the_nineties(t):
    """Payments dated like the purchases, so that income and expense meet on the same days."""
    return t("socio_productos").select(
        F.col("fecha_compra").alias("fecha_pagado"),
        F.when(F.col("cerrado"), 0).when(~F.col("cerrado"), 4).alias("tipo"),
        F.col("saldo").alias("monto"),
        F.when(F.col("activo"), 1).otherwise(0).alias("estatus"),
    )


@query
def reconcile_sales(t):
    return kpis.reconcile_sales(t("compras_texto"), t("prev_conciliacion_ventas"), _run_ts())


@query
def reconcile_payments(t):
    return kpis.reconcile_payments(
        t("pagos_transacciones_texto"), t("prev_conciliacion_pagos"), p.KEYWORD, _run_ts()
    )


# --- table maintenance --------------------------------------------------------------------------


@query
def insert_new(t):
    return m.insert_new(t("prev_orders"), t("cur_orders"), ["socio", "dia"])


@query
def insert_new_first(t):
    lines = t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    loaded = lines.where(F.col("l_extendedprice") > 90000)
    order = [F.col(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]
    return m.insert_new_first(loaded, lines, ["l_orderkey", "l_linenumber"], order)


@query
def insert_or_ignore(t):
    return m.insert_or_ignore(
        t("prev_orders"), t("cur_orders"), ["socio", "dia"], [F.col("compra")]
    )


@query
def diff_update(t):
    return m.diff_update(
        t("prev_customer"), t("cur_customer"), ["c_custkey"], ["c_acctbal"],
        ["c_acctbal", "c_mktsegment"],
    )


@query
def diff_update_tolerant(t):
    return m.diff_update_tolerant(
        t("prev_part_noise"), t("cur_part_noise"), ["producto"], ["nombre", "nota", "precio"]
    )


@query
def upsert(t):
    return m.upsert(t("prev_part"), t("cur_part"), ["producto"], "fecha_registro", _run_ts())


@query
def replace_all(t):
    return m.replace_all(t("prev_customer"), t("cur_customer"))


@query
def replace_keep_old(t):
    nothing = t("cur_customer").where(F.col("c_nationkey") > 1000)
    return m.replace_keep_old(t("prev_customer"), nothing)


@query
def replace_when_filled(t):
    return m.replace_keep_old(t("prev_customer"), t("cur_customer"), "c_acctbal")


@query
def replace_range(t):
    start, end = F.lit(p.YEAR_START), F.lit(p.YEAR_END)
    return m.replace_range(t("prev_orders"), t("cur_orders"), "dia", start, end)


@query
def append_change_history(t):
    current = t("socios").select(
        F.col("socio").alias("id_socio"), "estatus", "fecha_ingreso", "fecha_vigencia_membresia"
    )
    return m.append_change_history(
        current, t("prev_hist_membresias"), "id_socio", ["estatus", "fecha_vigencia_membresia"],
        _run_ts(),
    )


@query
def append_snapshot(t):
    return m.append_snapshot(t("prev_transacciones"), records.transfers_source(pages.transfers(t)))


@query
def nearest_ancestor(t):
    allowed = dimensions.qualified_partners(
        t("v_socio_rangos"), t("rangos"), t("socio_info"), p.LEADER_RANKS
    )
    return hierarchy.nearest_ancestor(t("socios"), allowed, "socio", "padre")


# --- reports ---------------------------------------------------------------------------------------


@query
def report_active_partners(t):
    return reports.active_partners(t("socios"), [p.EXCLUDED_PARTNER])


@query
def report_maintenance_gateway(t):
    return reports.maintenance_gateway(t("compras"), t("socios"))


@query
def report_courses(t):
    return reports.courses(t("learning_compras"), t("learning_curso"), t("socios"))


@query
def report_memberships(t):
    return reports.memberships_gateway(t("compras"), t("prospectos"), t("socios"))


@query
def report_maintenance_all(t):
    return reports.maintenance_all(t("compras"))


@query
def report_memberships_all(t):
    return reports.memberships_all(t("compras"), t("prospectos"), t("socios"))


@query
def report_bonus_daily(t):
    return reports.bonus_daily(t("pagos"), t("enumeracion"))


@query
def report_bonus_tiers(t):
    return reports.bonus_tiers(t("pagos"), t("enumeracion"))


@query
def report_inflows(t):
    return reports.inflows(t("pagos_transacciones"))


@query
def report_outflows(t):
    return reports.outflows(t("pagos_transacciones"))


@query
def report_aum_products(t):
    return reports.aum_products(t("socio_productos"), t("socios"))


@query
def report_aum_pending(t):
    return reports.aum_pending(t("pagos"))


@query
def report_aum_contracts(t):
    return reports.aum_contracts(t("socio_productos"), t("socios"))


@query
def report_aum_contract_bonuses(t):
    return reports.aum_contract_bonuses(t("pagos"), t("socio_productos"))


# --- run log -------------------------------------------------------------------------------------


@query
def run_log(t):
    steps = [
        ("fact_retiros", "insertar_retiros", withdrawals_new),
        ("fact_masterbonus", "insertar_masterbonus", masterbonus_new),
        ("fact_anualidades", "insertar_anualidades", annuities),
    ]
    logs = [audit.log_of(job(t), table, process) for table, process, job in steps]
    return logs[0].unionByName(logs[1]).unionByName(logs[2])
