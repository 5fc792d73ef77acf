"""The whole refresh on the test tables: fills every table, and again changes nothing."""

from __future__ import annotations

import dataclasses
import datetime as dt
import json

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.checks import pages
from ledgerloom.checks import parameters as p
from ledgerloom.checks.standins import Tables
from ledgerloom.refresh import OPTIONAL, REJECTED, STEPS, Settings, refresh

SETTINGS = Settings(
    year=p.YEAR, as_of=p.YEAR_END, run_ts=dt.datetime(2030, 1, 1), monthly_since=p.SINCE,
    house_account=p.HOUSE_ACCOUNT, payment_keyword=p.KEYWORD, leader_ranks=p.LEADER_RANKS, regions=p.REGIONS,
)


@pytest.fixture(scope="module")
def warehouse(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("base"))
    spark.sql("CREATE DATABASE refresh_test")
    spark.catalog.setCurrentDatabase("refresh_test")
    t = Tables(spark, SF_SMALL)
    names = (
        "socios v_socio_rangos_defi v_socio_rangos rangos socio_info paises prospectos prospecto_info compras "
        "productos promociones socio_productos pagos pagos_transacciones"
    ).split()
    sources = {name: t(name) for name in names}
    sources |= {
        "enum": t("enumeracion"),
        "dim_cat_objetivos_socios": t("objetivos"),
        "dim_cat_objetivos_planes": t("objetivos"),
        "dim_cat_productos": t("productos").withColumnRenamed("producto", "id_producto"),
        "dim_membresias": t("vencimientos"),
        "wallet_pages": pages.wallets(t),
        "transfer_pages": pages.transfers(t),
        "purchase_pages": pages.purchases(t),
        "payout_pages": pages.payouts(t),
    }
    yield spark, sources, base
    spark.catalog.setCurrentDatabase("default")
    spark.sql("DROP DATABASE refresh_test CASCADE")


def log(spark, when):
    rows = spark.table("migration_logs").where(F.col("fecha_registro") == F.lit(when)).collect()
    return {r.proceso: (r.estatus, r.registros_insertados, r.error_text) for r in rows}


def test_two_runs(warehouse):
    spark, sources, base = warehouse
    refresh(spark, sources, base, SETTINGS)
    first = log(spark, SETTINGS.run_ts)
    assert list(first) and set(first) == set(STEPS)
    assert {name: entry for name, entry in first.items() if entry[0] != "success"} == {}
    filled = {t for t in schemas.WAREHOUSE if not spark.table(t).isEmpty()}
    # contract products do not occur in the smallest test tables
    assert set(schemas.WAREHOUSE) - filled <= {
        "fact_planes_adicionales_selected", "aum_bonos_select", "aum_bonos_select_actual",
        REJECTED,
    }
    counts = {t: spark.table(t).count() for t in schemas.WAREHOUSE}
    assert first["insertar_socios"][1] == counts["dim_socios"]
    assert counts["fact_balance"] == first["insertar_fact_balance"][1] == 365
    for name in ("insertar_fact_conciliacion_ventas", "insertar_cliente_liabilities", "insertar_planes"):
        assert first[name][1] == counts[STEPS[name][0]], name

    later = dataclasses.replace(SETTINGS, run_ts=dt.datetime(2030, 1, 2))
    refresh(spark, sources, base, later)
    second = log(spark, later.run_ts)
    assert {name: e for name, e in second.items() if e[0] != "success"} == {}
    appended_always = {"insertar_wallets"}
    for name, (_, rows, _) in second.items():
        if name.startswith(("actualizar_", "actualizar1_")) and "agg" not in name:
            assert rows == 0, name
        if name.startswith("insertar_") and STEPS[name][0] in (
            "dim_socios", "dim_prospectos", "dim_primerplatinum", "fact_retiros", "fact_masterbonus",
            "fact_bonos_comisiones", "fact_transacciones_internas", "fact_kft_compras_planes",
            "fact_kft_pagos_planes", "hist_membresias", "hist_rangos", "agg_planes", "agg_bonos",
        ):
            assert rows == 0, name
    again = {t: spark.table(t).count() for t in schemas.WAREHOUSE}
    # partners without a due date form a month NULL, and a NULL key never conflicts in an upsert
    growing = {"migration_logs", "fact_porcentajes_anualidades"}
    growing |= {STEPS[n][0] for n in appended_always}
    assert {t for t in again if again[t] != counts[t]} == growing
    stamps = spark.table("fact_balance").select("fecha_insert").distinct().collect()
    assert [r[0] for r in stamps] == [later.run_ts]


def test_changes_reach_the_tables(warehouse):
    spark, sources, base = warehouse
    on = dataclasses.replace(SETTINGS, run_ts=dt.datetime(2030, 1, 3))
    changed = dict(sources)
    changed["socios"] = sources["socios"].withColumn(
        "fecha_vigencia_membresia",
        F.when(F.col("estatus") == 1, F.lit(dt.date(2031, 1, 1))).otherwise(F.col("fecha_vigencia_membresia")),
    )
    changed["pagos"] = sources["pagos"].withColumn("monto", F.raise_error(F.lit("source is down")).cast("decimal(19,2)"))
    refresh(spark, changed, base, on, ["actualizar_socios", "insertar_hist_membresias", "insertar_aum_bonos"])
    entries = log(spark, on.run_ts)
    ones = sources["socios"].where("estatus = 1").count()
    assert entries["actualizar_socios"][:2] == ("success", ones)
    assert entries["insertar_hist_membresias"][:2] == ("success", ones)
    assert entries["insertar_aum_bonos"][0] == "failed" and "source is down" in entries["insertar_aum_bonos"][2]
    assert spark.table("aum_bonos").count() == 1  # the old table is still there


def test_a_run_with_new_pages_only_knows_earlier_versions(warehouse):
    spark, sources, base = warehouse
    span = (dt.datetime(1990, 1, 1), dt.datetime(2050, 1, 1))
    fact = spark.table("fact_kft_compras_planes")
    known = fact.where("fecha_pago IS NOT NULL").agg(F.min("id_compra")).first()[0]
    created = "1995-01-01T00:00:00.000Z"

    def page(*found):
        rows = [json.dumps({"response": {"results": list(found)}})]
        return spark.createDataFrame([(r,) for r in rows], "payload string")

    def run(day, *found):
        on = dataclasses.replace(SETTINGS, run_ts=dt.datetime(2030, 2, day), record_span=span)
        steps = ["insertar_kft_compras_planes", "actualizar1_kft_compras_planes"]
        refresh(spark, {**sources, "purchase_pages": page(*found)}, base, on, steps)
        entries = log(spark, on.run_ts)
        assert {e[0] for e in entries.values()} == {"success"}, entries
        return tuple(entries[s][1] for s in steps)

    new = {"_id": "rx", "id_compra": "CP900000001", "Created Date": created}
    # the new record complements one whose page landed in another run
    assert run(1, {**new, "Fecha_pago": "3/5/25", "complemento_de": f"r{known}"})[0] == 1
    row = spark.table("fact_kft_compras_planes").where("id_compra = 900000001").first()
    assert (row.fecha_pago, row.complemento_de) == (dt.datetime(2025, 3, 5), known)
    # a record that has lost its time since is not loaded, nor one whose lost time is all that landed
    lost = {"_id": "ry", "id_compra": "CP900000002", "Created Date": created}
    run(2, {**lost, "Fecha_pago": ""}, {**new, "Fecha_pago": "", "status": "refunded"})
    now = spark.table("fact_kft_compras_planes")
    assert now.where("id_compra = 900000002").isEmpty()
    # filtered out by the endpoint's rule, so the fact keeps what it had
    assert now.where("id_compra = 900000001").first().status is None
    state = spark.table("estado_compras_planes").where("_id IN ('rx', 'ry')")
    assert sorted((r["_id"], r.status, r.Fecha_pago) for r in state.collect()) == [
        ("rx", "refunded", ""), ("ry", None, ""),
    ]


def test_optional_updates(warehouse):
    spark, sources, base = warehouse
    on = dataclasses.replace(SETTINGS, run_ts=dt.datetime(2030, 1, 4))
    changed = {**sources, "compras": sources["compras"].withColumn("es_excedido", F.lit(True))}
    refresh(spark, changed, base, on, list(OPTIONAL))
    entries = log(spark, on.run_ts)
    assert {e[0] for e in entries.values()} == {"success"}
    assert spark.table("fact_membresias").where("NOT pago_excedido OR pago_excedido IS NULL").isEmpty()
