"""The warehouse refresh: every job in order, each into its table, each with a row in the run log.

`refresh` is one pass over the steps below.  It needs the operational tables as DataFrames, the
landed JSON pages, the tables people maintain by hand, and the values of `Settings`.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom import schemas
from ledgerloom.operators import audit
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
)
from ledgerloom.session import materialise
from ledgerloom.sources import landing, tables

LOG = "migration_logs"
REJECTED = "rejected_pages"
LOOKUPS = ("enum", "paises", "productos", "promociones", "rangos", "dim_cat_productos")


@dataclass(frozen=True)
class Settings:
    """Everything a run depends on beside its tables."""

    year: int
    as_of: dt.date
    run_ts: dt.datetime
    monthly_since: dt.date
    house_account: str
    payment_keyword: str
    leader_ranks: Sequence[tuple[int, int]]
    regions: Mapping[str, Sequence[int]] = field(default_factory=dict)
    withdrawal_excluded_partner: int | None = None
    share_excluded_partners: Sequence[int] = ()
    excluded_purchases: Sequence[int] = ()
    buy_wallets: Sequence[str] = ()
    pay_wallets: Sequence[str] = ()
    # Only purchases and payouts created after the first moment and before the second
    record_span: tuple[dt.datetime, dt.datetime] | None = None
    # pages that are not understood fail their step, or are listed in `rejected_pages`
    allow_unread_pages: bool = False
    # Sources stored once per run.  Name every table that is read through JDBC: several jobs read
    # it, and all of them should see it at one moment.
    stored: Sequence[str] = LOOKUPS


class Refresh:
    """One run: its sources, its settings, and the ways a step loads its table."""

    def __init__(
        self, spark: SparkSession, sources: Mapping[str, DataFrame], base: str, settings: Settings
    ) -> None:
        self.spark = spark
        self.source = {**sources, **self._stored(sources, settings.stored)}
        self.base = base
        self.on = settings
        self.version = settings.run_ts.strftime("%Y%m%d%H%M%S")
        self._leaders: DataFrame | None = None
        self._records: dict[str, DataFrame] = {}

    @staticmethod
    def _stored(sources: Mapping[str, DataFrame], names: Sequence[str]) -> dict[str, DataFrame]:
        """Sources as tables of the run, by default the lookups.

        A table behind JDBC has no known size, so Spark would shuffle the facts to meet it.  Of a
        stored one it knows the size, and broadcasts it if, and only if, that is small.
        """
        return {n: materialise(sources[n], n)[0] for n in names if n in sources}

    def now(self, table: str) -> DataFrame:
        return tables.current(self.spark, table)

    @property
    def run_ts(self) -> Column:
        return F.lit(self.on.run_ts)

    @property
    def leaders(self) -> DataFrame:
        """Found once per run, for inserting and for updating."""
        if self._leaders is None:
            s = self.source
            found = dimensions.leaders_source(
                s["socios"], s["v_socio_rangos"], s["rangos"], s["socio_info"],
                self.on.leader_ranks, self.on.regions,
            )
            self._leaders, _ = materialise(found, "leaders")
        return self._leaders

    def records(self, pages: str, parse: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The records of landed pages, each page parsed once per run.

        Where a table keeps the last versions of the records, they are brought into it, and it is what
        the steps read: also a run that is given new pages only knows the records as they are now.
        """
        if pages not in self._records:
            source = self.source[pages]
            if "landed" not in source.columns:
                source = source.withColumn("landed", landing.landing_order(self.run_ts))
            found, _ = materialise(parse(source), pages)
            if self.on.allow_unread_pages:
                unread = landing.unread(found).select(
                    F.lit(pages).alias("origen"), "payload", self.run_ts.alias("fecha_registro")
                )
                tables.append(unread, REJECTED)
            rows = landing.read_records(found, self.on.allow_unread_pages)
            if pages in schemas.RECORD_STATES:
                rows = self._kept(rows, *schemas.RECORD_STATES[pages])
            self._records[pages] = rows
        return self._records[pages]

    def _kept(self, rows: DataFrame, table: str, key: str) -> DataFrame:
        number = F.regexp_extract(key, r"(\d+)$", 1).try_cast("bigint")
        block = F.coalesce(F.floor(number / schemas.BLOCK_SIZE), F.lit(-1))
        # records without an id are versions of themselves only
        alone = F.when(F.coalesce(key, F.lit("")) == "", F.xxhash64(*[c for c in rows.columns if c != "_landed"]))
        rows = rows.withColumn("sin_id", alone).withColumn(schemas.BLOCK, block)
        tables.merge_latest(table, rows, [schemas.BLOCK, key, "sin_id"], [F.desc("_landed")])
        return self.now(table)

    # --- the ways to load -------------------------------------------------------------------

    def append(self, table: str, rows: DataFrame, counter: Observation) -> None:
        tables.append(audit.counted(rows, counter), table)

    def insert_new(self, table: str, rows: DataFrame) -> int:
        """Rows whose id a table of id blocks lacks."""
        key = schemas.BLOCKED[table]
        rows = rows.withColumn(schemas.BLOCK, F.expr(f"{key} DIV {schemas.BLOCK_SIZE}"))
        return tables.insert_new(table, rows, [key])

    def log_changes(
        self, log: str, changes_of: Callable[[DataFrame, DataFrame, Column], DataFrame], watch: Sequence[str]
    ) -> int:
        """Partners changed since their last record in a history log."""
        return tables.append_history(
            self.spark, log, schemas.HISTORY_STATES[log],
            lambda last: changes_of(self.now("dim_socios"), last, self.run_ts),
            history.KEY, watch, self.version, schemas.BLOCK_SIZE, history.AT,
        )

    def replace(self, table: str, rows: DataFrame, counter: Observation) -> None:
        state = audit.counted(tables.conform(rows, table), counter)
        tables.publish(state, table, self.base, self.version)

    def replace_guarded(
        self, table: str, rows: DataFrame, counter: Observation, guard: str | None = None
    ) -> int | None:
        state = audit.counted(tables.conform(rows, table), counter)
        filled = tables.publish_if_filled(state, table, self.base, self.version, guard)
        return None if filled else 0

    def update(self, table: str, rule: m.Update, source: DataFrame) -> int:
        return tables.update(table, rule, source, self.base, self.version)

    def upsert(
        self, table: str, source: DataFrame, keys: Sequence[str], touch: str | None = None
    ) -> int:
        seen = Observation()
        counted = source.observe(seen, F.count(F.lit(1)).alias("rows"))
        state = m.upsert(self.now(table), counted, keys, touch, self.run_ts, on_insert=self.run_ts)
        tables.publish(state, table, self.base, self.version)
        return seen.get["rows"]

    def overwrite_from_year(self, table: str, rows: DataFrame, counter: Observation) -> None:
        tables.overwrite_from(audit.counted(rows, counter), table, "anio", self.on.year)


Work = Callable[[Refresh, Observation], int | None]
STEPS: dict[str, tuple[str, Work]] = {}


def step(table: str) -> Callable[[Work], Work]:
    """Register a function as the process of its name; steps run in the order they stand here."""

    def register(work: Work) -> Work:
        STEPS[work.__name__] = (table, work)
        return work

    return register


# --- dimensions -----------------------------------------------------------------------------------


@step("dim_socios")
def insertar_socios(r, counter):
    s = r.source
    new = dimensions.partners_new(
        s["socios"], s["v_socio_rangos_defi"], s["socio_info"], s["paises"], r.now("dim_socios")
    )
    r.append("dim_socios", new, counter)


@step("dim_socios")
def actualizar_socios(r, counter):
    source = dimensions.partners_update_source(r.source["socios"], r.source["v_socio_rangos_defi"])
    return r.update("dim_socios", dimensions.PARTNER_UPDATE, source)


@step("dim_prospectos")
def insertar_prospectos(r, counter):
    s = r.source
    new = dimensions.prospects_new(
        s["prospectos"], s["prospecto_info"], s["paises"], r.now("dim_prospectos")
    )
    r.append("dim_prospectos", new, counter)


@step("dim_prospectos")
def actualizar_prospectos(r, counter):
    source = dimensions.prospects_update_source(r.source["prospectos"], r.source["prospecto_info"])
    return r.update("dim_prospectos", dimensions.PROSPECT_UPDATE, source)


@step("dim_primerplatinum")
def insertar_primerplatinum(r, counter):
    new = dimensions.leaders_new(r.leaders, r.now("dim_primerplatinum"))
    r.append("dim_primerplatinum", new, counter)


@step("dim_primerplatinum")
def actualizar_primerplatinum(r, counter):
    return r.update("dim_primerplatinum", dimensions.LEADER_UPDATE, r.leaders)


# --- payments --------------------------------------------------------------------------------------


@step("fact_retiros")
def insertar_retiros(r, counter):
    rows = payments.withdrawals_source(r.source["pagos"], r.on.withdrawal_excluded_partner)
    return r.insert_new("fact_retiros", rows)


@step("fact_retiros")
def actualizar_retiros(r, counter):
    source = payments.withdrawals_source(r.source["pagos"])
    return r.update("fact_retiros", payments.WITHDRAWAL_UPDATE, source)


@step("fact_masterbonus")
def insertar_masterbonus(r, counter):
    return r.insert_new("fact_masterbonus", payments.masterbonus_source(r.source["pagos"]))


@step("fact_masterbonus")
def actualizar_masterbonus(r, counter):
    source = payments.masterbonus_source(r.source["pagos"])
    return r.update("fact_masterbonus", payments.MASTERBONUS_UPDATE, source)


@step("fact_bonos_comisiones")
def insertar_fact_bonos_comisiones(r, counter):
    rows = payments.bonuses_source(r.source["pagos"], r.source["enum"])
    return r.insert_new("fact_bonos_comisiones", rows)


@step("fact_bonos_comisiones")
def actualizar_fact_bonos_comisiones(r, counter):
    source = payments.bonuses_source(r.source["pagos"], r.source["enum"])
    return r.update("fact_bonos_comisiones", payments.BONUS_UPDATE, source)


# --- purchases -------------------------------------------------------------------------------------


@step("fact_ventas")
def insertar_planes(r, counter):
    s = r.source
    rows = purchases.sales_source(
        s["socio_productos"], s["compras"], s["productos"], dt.date(r.on.year, 1, 1),
        r.on.house_account, r.on.excluded_purchases,
    )
    r.overwrite_from_year("fact_ventas", rows.withColumn("anio", F.year("fecha_compra")), counter)


@step("fact_anualidades")
def insertar_anualidades(r, counter):
    s = r.source
    rows = purchases.annuities(s["compras"], s["productos"], s["promociones"], r.on.house_account)
    r.replace("fact_anualidades", rows, counter)


@step("fact_membresias")
def insertar_membresias(r, counter):
    s = r.source
    rows = purchases.memberships(s["compras"], s["productos"], s["promociones"], r.on.house_account)
    r.replace("fact_membresias", rows, counter)


# --- record dumps ----------------------------------------------------------------------------------


def _purchases(pages):
    return landing.parsed(pages, landing.PURCHASE_RECORD)


def _payouts(pages):
    return landing.parsed(pages, landing.PAYOUT_RECORD)


@step("fact_wallets")
def insertar_wallets(r, counter):
    found = r.records("wallet_pages", landing.parsed_wallets)
    r.append("fact_wallets", records.wallet_balances(found, r.on.buy_wallets, r.on.pay_wallets), counter)


@step("fact_transacciones_internas")
def insertar_transacciones_internas(r, counter):
    rows = r.records("transfer_pages", lambda p: landing.parsed(p, landing.TRANSFER_RECORD))
    new = records.internal_transfers_new(rows, r.now("fact_transacciones_internas"))
    r.append("fact_transacciones_internas", new, counter)


@step("fact_kft_compras_planes")
def insertar_kft_compras_planes(r, counter):
    rows = r.records("purchase_pages", _purchases)
    return r.insert_new("fact_kft_compras_planes", records.purchases_source(rows, span=r.on.record_span))


@step("fact_kft_compras_planes")
def actualizar1_kft_compras_planes(r, counter):
    rows = r.records("purchase_pages", _purchases)
    source = records.purchases_source(rows, span=r.on.record_span)
    return r.update("fact_kft_compras_planes", records.RECORD_UPDATE, source)


@step("fact_kft_pagos_planes")
def insertar_kft_pagos_planes(r, counter):
    rows = r.records("payout_pages", _payouts)
    return r.insert_new("fact_kft_pagos_planes", records.payouts_source(rows, r.on.record_span))


@step("fact_kft_pagos_planes")
def actualizar_kft_pagos_planes(r, counter):
    rows = r.records("payout_pages", _payouts)
    source = records.payouts_update_source(rows, r.on.record_span)
    return r.update("fact_kft_pagos_planes", records.PAYOUT_UPDATE, source)


# --- tables that read the ones above -----------------------------------------------------------------


@step("dim_metas_socios")
def insertar_metas_socios(r, counter):
    rows = goals.member_goals(
        r.now("dim_primerplatinum"), r.now("dim_socios"), r.source["dim_cat_objetivos_socios"], r.on.year
    )
    r.replace("dim_metas_socios", rows, counter)


@step("dim_metas_planes")
def insertar_metas_planes(r, counter):
    rows = goals.sales_goals(
        r.now("dim_primerplatinum"), r.now("fact_ventas"), r.source["dim_cat_objetivos_planes"], r.on.year
    )
    r.replace("dim_metas_planes", rows, counter)


@step("hist_membresias")
def insertar_hist_membresias(r, counter):
    return r.log_changes("hist_membresias", history.status_changes, history.STATUS_WATCH)


@step("hist_rangos")
def insertar_hist_rangos(r, counter):
    return r.log_changes("hist_rangos", history.rank_changes, history.RANK_WATCH)


@step("agg_fact_anualidades")
def actualizar_agg_fact_anualidades(r, counter):
    rows = aggregates.monthly_paid(r.now("fact_anualidades"), r.on.monthly_since, r.on.as_of)
    return r.upsert("agg_fact_anualidades", rows, ["mes"])


@step("agg_fact_membresias")
def actualizar_agg_fact_membresias(r, counter):
    rows = aggregates.monthly_paid(r.now("fact_membresias"), r.on.monthly_since, r.on.as_of)
    return r.upsert("agg_fact_membresias", rows, ["mes"])


@step("agg_planes")
def insertar_agg_planes(r, counter):
    # sales of the years before the refreshed one do not change, nor do their sums
    tables.refresh_partials(r.spark, "parciales_planes", "fact_ventas", r.on.year, aggregates.sales_partials)
    rows = aggregates.buckets_of_partials(r.now("parciales_planes"), r.source["dim_cat_productos"])
    r.append("agg_planes", m.new_rows(r.now("agg_planes"), rows, aggregates.BUCKET_KEY), counter)


@step("agg_bonos")
def insertar_agg_bonos_comisiones(r, counter):
    new = aggregates.payment_type_daily(r.source["pagos"], r.source["enum"], r.now("agg_bonos"))
    r.append("agg_bonos", new, counter)


@step("fact_planes_adicionales_selected")
def insertar_planes_adicionales(r, counter):
    rows = aum.select_contracts(r.source["socio_productos"], r.source["socios"])
    r.replace("fact_planes_adicionales_selected", rows, counter)


@step("fact_cliente_liabilities")
def insertar_cliente_liabilities(r, counter):
    s = r.source
    rows = kpis.client_liabilities(s["socio_productos"], s["socios"], s["pagos"])
    return r.upsert("fact_cliente_liabilities", rows, ["id_socio"], "fecha_insert")


@step("fact_cliente_porcentajes_pago")
def upsert_cliente_porcentajes_pago(r, counter):
    rows = kpis.client_paid_share(r.source["pagos"], r.on.share_excluded_partners)
    return r.upsert("fact_cliente_porcentajes_pago", rows, ["id_socio"], "fecha_insert")


@step("fact_recompra_planes")
def insertar_recompra_planes(r, counter):
    rows = kpis.repurchase_monthly(r.source["compras"], dt.date(r.on.year, 1, 1))
    return r.upsert("fact_recompra_planes", rows, ["mes"], "fecha_insert")


@step("fact_porcentajes_anualidades")
def insertar_porcentajes_anualidades(r, counter):
    rows = kpis.retention_monthly(r.source["dim_membresias"], r.now("fact_anualidades"), r.on.year)
    return r.upsert("fact_porcentajes_anualidades", rows, ["mes_venc"], "fecha_insert")


@step("fact_balance")
def insertar_fact_balance(r, counter):
    rows = kpis.daily_balance(
        r.source["compras"], r.source["pagos"], dt.date(r.on.year, 1, 1), r.on.as_of
    )
    return r.upsert("fact_balance", rows, ["fecha"], "fecha_insert")


@step("fact_conciliacion_ventas")
def insertar_fact_conciliacion_ventas(r, counter):
    rows = kpis.reconciled_sales_source(r.source["compras"])
    return r.upsert("fact_conciliacion_ventas", rows, ["compra"], "fecha_registro")


@step("fact_conciliacion_pagos")
def insertar_fact_conciliacion_pagos(r, counter):
    rows = kpis.reconciled_payments_source(r.source["pagos_transacciones"], r.on.payment_keyword)
    return r.upsert("fact_conciliacion_pagos", rows, ["pago_tx"], "fecha_registro")


@step("aum_pass")
def insertar_aum_pass(r, counter):
    rows = aum.open_products(r.source["socio_productos"], r.source["socios"])
    return r.replace_guarded("aum_pass", rows, counter, "fecha_ultimo_plan")


@step("aum_bonos")
def insertar_aum_bonos(r, counter):
    rows = aum.pending_total(r.source["pagos"])
    return r.replace_guarded("aum_bonos", rows, counter, "fecha_ultimo_bono")


@step("aum_bonos_select")
def insertar_aum_bonos_select(r, counter):
    rows = aum.select_contracts_text(r.source["socio_productos"], r.source["socios"])
    return r.replace_guarded("aum_bonos_select", rows, counter)


@step("aum_bonos_select_actual")
def insertar_aum_bonos_select_actual(r, counter):
    rows = aum.bonus_paid_by_type(r.source["pagos"], r.source["socio_productos"])
    return r.replace_guarded("aum_bonos_select_actual", rows, counter)


# These two were never part of the regular run: the tables they update are rebuilt each time.
OPTIONAL: dict[str, tuple[str, Work]] = {}


def _optional(table: str, item_type: int) -> Work:
    def work(r: Refresh, counter: Observation) -> int:
        source = purchases.purchases_update_source(r.source["compras"], item_type)
        return r.update(table, purchases.PURCHASE_UPDATE, source)

    return work


OPTIONAL["actualizar_anualidades"] = (
    "fact_anualidades", _optional("fact_anualidades", fixed.ANNUITY_ITEM),
)
OPTIONAL["actualizar_membresias"] = (
    "fact_membresias", _optional("fact_membresias", fixed.MEMBERSHIP_ITEM),
)


def refresh(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    base: str,
    settings: Settings,
    only: Sequence[str] | None = None,
) -> None:
    """Run the steps (or the named ones) in order; the outcome of each is a row of the run log.

    `base` is a shared folder for table versions.  A failed step does not stop the others; they
    read the last good state of its table.
    """
    tables.create_missing(spark, schemas.WAREHOUSE, schemas.PARTITIONED)
    run = Refresh(spark, sources, base, settings)
    known = {**STEPS, **OPTIONAL}
    for process in STEPS if only is None else only:
        table, work = known[process]
        log = audit.run_step(
            spark, table, process, lambda counter, work=work: work(run, counter), settings.run_ts
        )
        tables.append(log, LOG)
