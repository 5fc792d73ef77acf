"""Jobs on the edge rows of FIXTURES.md that the test tables do not contain."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import aggregates, aum, goals, history, kpis, payments, purchases, records, reports

D = Decimal


def at(year, month, day, hour=0):
    return dt.datetime(year, month, day, hour)


# --- KPIs -------------------------------------------------------------------------------------


def test_repurchase(frame, values):
    compras = frame(
        "compra long, socio long, fecha_pago timestamp_ntz, estatus int, tipo_item int",
        (1, 7, at(2024, 12, 1), 6, 2),  # before the start, ignored (Q20)
        (2, 7, at(2025, 1, 5), 6, 2),
        (3, 7, at(2025, 1, 5), 6, 2),  # tie on the time
        (4, 7, at(2025, 2, 1), 6, 4),
        (5, None, at(2025, 2, 1), 6, 2),
        (6, None, at(2025, 2, 2), 6, 2),
        (7, 8, at(2025, 2, 3), 6, 2),
        (8, 8, at(2025, 2, 4), 6, 1),  # not a plan
        (9, 9, at(2025, 2, 4), 4, 2),  # not paid
        (10, 9, at(2025, 2, 4), 6, None),  # unknown item type drops out
    )
    rows = values(kpis.repurchase_monthly(compras, dt.date(2025, 1, 1)))
    assert rows == [
        (dt.date(2025, 1, 1), 2, 1, 1, D("50.00")),
        (dt.date(2025, 2, 1), 4, 2, 2, D("50.00")),
    ]
    assert all(total == first + again for _, total, first, again, _ in rows)


def test_retention(frame, values):
    due = dt.date(2025, 3, 10)
    dues = frame(
        "id_socio long, pago_anualidad date",
        (1, due), (2, due), (3, due), (4, due), (5, due), (6, None), (7, dt.date(2025, 4, 1)), (None, due),
    )
    paid = frame(
        "id_socio long, fecha_pago timestamp_ntz",
        (1, at(2025, 2, 1)),  # early
        (2, at(2025, 3, 10, 23)),  # on the day
        (3, at(2025, 5, 1)),  # late
        (4, at(2025, 2, 1)), (4, at(2025, 6, 1)),  # twice: the last decides (Q21)
        (5, at(2024, 3, 1)),  # another year: never paid
        (6, at(2025, 1, 1)),  # no due date
    )
    rows = values(kpis.retention_monthly(dues, paid, 2025))
    assert rows == [
        (None, 0, 0, 1, 1, D("0.00"), D("0.00"), D("100.00")),
        (dt.date(2025, 3, 1), 2, 1, 2, 5, D("40.00"), D("20.00"), D("40.00")),
        (dt.date(2025, 4, 1), 0, 1, 0, 1, D("0.00"), D("100.00"), D("0.00")),
    ]
    assert all(r[1] + r[2] + r[3] == r[4] for r in rows)


def test_balance(frame, values):
    compras = frame(
        "fecha_pago timestamp_ntz, estatus int, tipo_item int, monto_pagado decimal(19,2)",
        (at(2025, 1, 1), 6, 5, D(10)), (at(2025, 1, 1, 9), 6, 1, D(20)), (at(2025, 1, 1, 9), 6, 2, D(30)),
        (at(2025, 1, 1, 9), 6, None, D(99)),  # no type: in no bucket
        (at(2025, 1, 1, 9), 5, 5, D(99)), (at(2025, 1, 4, 23), 6, 5, D(1)), (at(2025, 1, 5), 6, 5, D(99)),
    )
    pagos = frame(
        "fecha_pagado timestamp_ntz, estatus int, tipo int, monto decimal(19,2)",
        (at(2025, 1, 1), 1, 0, D(1)), (at(2025, 1, 2), 1, 4, D(2)), (at(2025, 1, 2), 1, 9, D(3)),
        (at(2025, 1, 2), 0, 9, D(99)), (at(2024, 12, 31), 1, 9, D(99)),
    )
    balance = kpis.daily_balance(compras, pagos, dt.date(2025, 1, 1), dt.date(2025, 1, 4))
    rows = [(r[0].day, *map(float, r[1:])) for r in values(balance)]
    assert rows == [
        (1, 10, 20, 30, 0, 0, 1, 59),
        (2, 0, 0, 0, 3, 2, 0, -5),
        (3, 0, 0, 0, 0, 0, 0, 0),
        (4, 1, 0, 0, 0, 0, 0, 1),
    ]


def test_paid_share(frame, values):
    pagos = frame(
        "socio long, estatus int, monto decimal(19,2)",
        (1, 0, D(50)), (1, 1, D(25)), (1, 2, D(99)),
        (2, 0, D(0)), (2, 1, D(5)),  # pending 0: no percentage
        (3, 1, D(5)),  # nothing pending: absent
        (4, 0, D(9)), (5, 0, D(9)), (None, 0, D(9)), (6, 0, None),
    )
    assert values(kpis.client_paid_share(pagos, [4])) == [
        (1, D(50), D(25), 50.0), (2, D(0), D(5), None), (5, D(9), D(0), 0.0), (6, D(0), D(0), None),
    ]


def test_liabilities(frame, values):
    owned = frame(
        "socio long, producto long, cerrado boolean, saldo decimal(19,2)",
        (1, 1, False, D(10)), (1, 280, False, D(99)), (1, 1, True, D(99)), (1, 1, None, D(99)),
        (2, 1, False, D(5)), (3, 1, False, D(7)),
    )
    socios = frame("socio long, estatus int", (1, 1), (2, 3), (3, 2))
    pagos = frame("socio long, estatus int, tipo int, monto decimal(19,2)",
                  (1, 0, 0, D(4)), (1, 0, 4, D(99)), (1, 1, 0, D(99)))
    assert values(kpis.client_liabilities(owned, socios, pagos)) == [
        (1, D(10), D(4), D(6)), (3, D(7), D(0), D(7)),
    ]


def test_reconciled_payment_cleans_text(frame, values):
    rows = frame(
        "pago_tx long, socio long, monto string, fecha_pagado timestamp_ntz, wallet string, "
        "monto_pagado_btc string, cotiza_btc string, mensaje string, estatus int",
        (1, 1, "$1,234.50", at(2025, 1, 1, 5), "w", "", "64,000.5", "via KeyWord", 1),
        (2, 1, "", at(2025, 1, 1, 5), "w", "0.1", "", "keyword", 1),
        (3, 1, "$1", at(2025, 1, 1, 5), "w", "0.1", "", "other", 1),
        (4, 1, "$1", at(2025, 1, 1, 5), "w", "0.1", "", None, 1),
        (5, 1, "$1", at(2025, 1, 1, 5), "w", "0.1", "", "keyword", 2),
    )
    source = kpis.reconciled_payments_source(rows, "keyword")
    assert values(source, "pago_tx", "monto", "fecha_pagado", "monto_pagado_btc", "cotiza_btc") == [
        (1, D("1234.50"), dt.date(2025, 1, 1), None, D("64000.5")),
        (2, None, dt.date(2025, 1, 1), D("0.1"), None),
    ]


# --- goals ------------------------------------------------------------------------------------


def _goals(frame):
    months = ", ".join(
        f"{m} int"
        for m in "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()
    )
    return frame(f"id_socio_platinum long, {months}", (9, *range(1, 13)))


def test_member_goals_last_day_and_missing_leader(frame, values):
    leaders = frame(
        "id_socio long, id_platinum long, nombre_platinum string, region string",
        (1, 9, "L", "Sur"), (2, 9, "L", "Sur"), (3, 9, "L", "Sur"), (4, None, None, "Sin Region"),
        (5, 8, "M", "Sur"), (6, 9, "L", "Sur"),
    )
    socios = frame(
        "id_socio long, fecha_ingreso timestamp_ntz",
        (1, at(2025, 12, 31)), (2, at(2025, 12, 31, 15)), (3, at(2025, 2, 1)), (4, at(2025, 2, 1)),
        (5, at(2025, 2, 1)), (6, at(2024, 2, 1)),
    )
    rows = values(goals.member_goals(leaders, socios, _goals(frame), 2025))
    assert [(r[0].month, r[1], r[4], r[5] and int(r[5])) for r in rows] == [
        (2, None, 1, None), (2, 8, 1, None), (2, 9, 1, 2), (12, 9, 1, 12),
    ]
    whole = goals.member_goals(leaders, socios, _goals(frame), 2025, whole_last_day=True)
    assert whole.where("month(fecha) = 12").first().total_real == 2


def test_sales_goals(frame, values):
    leaders = frame("id_socio long, id_platinum long, nombre_platinum string, region string",
                    (1, 9, "L", "Sur"), (2, 9, "L", "Sur"))
    ventas = frame("id_socio long, fecha_compra timestamp_ntz, precio decimal(19,2)",
                   (1, at(2025, 3, 1), D(5)), (1, at(2025, 3, 9), D(6)), (2, at(2025, 3, 2), None),
                   (3, at(2025, 3, 2), D(99)))
    assert values(goals.sales_goals(leaders, ventas, _goals(frame), 2025)) == [
        (dt.date(2025, 3, 1), 9, "L", "Sur", D(11), D(3)),
    ]


# --- aggregates, AUM, history -------------------------------------------------------------------


def test_plan_buckets(frame, values):
    day = at(2025, 1, 1, 3)
    ventas = frame("id_producto long, fecha_compra timestamp_ntz, precio decimal(19,2)",
                   *[(i, day, D(i)) for i in range(1, 8)], (1, day, D(1)), (99, day, D(9)))
    catalogue = frame("id_producto long, nombre string", (1, "Plan Select"), (2, "SELECT24 SELECT36"),
                      (3, "select36"), (4, "Selecto"), (5, "Pa24"), (6, "otra"), (7, None))
    got = aggregates.plan_buckets(ventas, catalogue)
    assert values(got, "nombre", "cantidad", "valor_total") == [
        ("OTROS", 3, D(22)), ("PA / PA24", 1, D(5)), ("PLAN SELECT", 2, D(2)),
        ("SELECT", 1, D(4)), ("SELECT24", 1, D(2)), ("SELECT36", 1, D(3)),
    ]


def test_contract_days_and_values(frame, values):
    owned = frame(
        "socio long, producto long, cerrado boolean, fecha_compra timestamp_ntz",
        (1, 280, False, at(2024, 2, 29)), (2, 280, False, at(2023, 1, 1)), (1, 285, False, at(2024, 2, 29, 5)),
        (3, 280, False, at(2025, 1, 1)), (1, 280, True, at(2025, 1, 1)), (1, 9, False, at(2025, 1, 1)),
    )
    socios = frame("socio long, estatus int", (1, 1), (2, 2), (3, 0))
    assert values(aum.select_contracts(owned, socios)) == [
        (dt.date(2025, 2, 28), "Select 3x", D("60000.00"), 2, D("120000.00")),
        (dt.date(2026, 2, 28), "Select 10x", D("200000.00"), 1, D("200000.00")),
    ]
    shown = values(aum.contracts_as_shown(owned, socios), "valor_contrato")
    assert shown == [("$200,000.00",), ("$60,000.00",)]


def test_global_sums_of_nothing_are_one_null_row(frame, values):
    pagos = frame("estatus int, tipo int, fecha_pago timestamp_ntz, monto decimal(19,2)",
                  (1, 0, at(2025, 1, 1), D(1)))
    assert values(aum.pending_total(pagos)) == [(None, None)]


def test_rank_history_skips_zero_and_null(frame, values):
    dim = frame("id_socio long, id_rango_actual int", (1, 0), (2, None), (3, 5), (4, 6), (5, 7))
    hist = frame("id_socio long, id_rango int, fecha_registro timestamp_ntz",
                 (3, 5, at(2024, 1, 1)), (4, 5, at(2024, 1, 1)), (5, None, at(2024, 1, 1)))
    run = F.lit("2025-01-01 00:00:00").cast("timestamp_ntz")
    assert values(history.rank_history(dim, hist, run), "id_socio", "id_rango") == [(4, 6), (5, 7)]


# --- payments and purchases ---------------------------------------------------------------------


def test_withdrawals_exclusion_drops_missing_partner(frame, values):
    columns = "pago long, socio long, tipo int, monto decimal(19,2), monto_pagado_btc decimal(38,9), " \
              "cotiza_btc decimal(38,9), estatus int, fecha timestamp_ntz, fecha_pago timestamp_ntz, " \
              "fecha_pagado timestamp_ntz, fecha_cancelacion timestamp_ntz, defi boolean"  # fmt: skip
    blank = (D(1), None, None, 0, None, None, None, None, True)
    pagos = frame(columns, (1, 5, 0, *blank), (2, None, 0, *blank), (3, 6, 0, *blank), (4, 5, 4, *blank))
    assert values(payments.withdrawals_source(pagos, 6), "id_retiro") == [(1,)]
    assert values(payments.withdrawals_source(pagos), "id_retiro") == [(1,), (2,), (3,)]


def test_bonus_update_compares_days(frame, values):
    schema = (
        "pago long, socio long, tipo int, monto decimal(19,2), monto_pagado_btc decimal(38,9), "
        "cotiza_btc decimal(38,9), estatus int, fecha timestamp_ntz, fecha_pago timestamp_ntz, "
        "fecha_pagado timestamp_ntz, fecha_cancelacion timestamp_ntz, defi boolean, mtd_dsp int, pago_tx string"
    )
    old = frame(schema, (1, 1, 4, D(1), None, None, 1, at(2025, 1, 1, 1), None, None, None, True, 2, "7"),
                (2, 1, 4, D(1), None, None, 1, at(2025, 1, 1, 1), None, None, None, True, 2, None))
    new = frame(schema, (1, 1, 4, D(9), None, None, 1, at(2025, 1, 1, 22), None, None, None, False, 2, "7"),
                (2, 1, 4, D(9), None, None, 1, at(2025, 1, 2), None, None, None, False, None, "8"))
    target = payments.masterbonus_source(old)
    got = payments.masterbonus_changed(new, target)
    assert values(got, "id_masterbonus", "fecha_solicitud", "fk_fecha_solicitud", "defi", "monto") == [
        (1, dt.date(2025, 1, 1), dt.date(2025, 1, 1), True, D(1)),
        (2, dt.date(2025, 1, 2), dt.date(2025, 1, 2), False, D(1)),
    ]
    assert values(target, "moneda", "pago_tx") == [("CNKT", None), ("CNKT", 7)]


def test_sales_reload_is_repeatable(frame, values):
    owned = frame(
        "compra long, socio long, producto long, activo boolean, cerrado boolean, capital_inicial decimal(19,2), "
        "moneda string, capital decimal(19,2), saldo decimal(19,2), fecha_compra timestamp_ntz, "
        "fecha_inicio timestamp_ntz, fecha_cierre timestamp_ntz, estatus int, plazo_forzoso boolean, plan_base long",
        *[(c, 1, 2, True, False, D(1), "USD", D(1), D(1), when, None, None, 1, False, base)
          for c, when, base in ((1, at(2025, 1, 1), None), (2, at(2025, 12, 31, 23), None),
                                (3, at(2026, 1, 1), None), (4, at(2025, 5, 5), 8), (5, at(2025, 5, 5), None),
                                (6, at(2024, 12, 31, 23), None))],
    )
    bought = frame(
        "compra long, item long, precio decimal(19,2), forma_pago int, entidad_pago int, referencia string, "
        "referencia2 string, referencia3 string", (1, 70, D(5), 1, None, None, None, None))  # fmt: skip
    names = frame("producto long, nombre string", (70, "P"))
    source = purchases.sales_source(owned, bought, names, dt.date(2025, 1, 1), "acc", [5])
    assert values(source, "id_compra") == [(1,), (2,), (3,)]
    empty = source.where("false")
    once = purchases.sales_year_replace(source, empty, 2025)
    assert values(once, "id_compra", "nombre_producto", "precio", "tipo_pago") == [
        (1, "P", D(5), "BTC"), (2, None, None, "x"), (3, None, None, "x"),
    ]
    assert values(purchases.sales_year_replace(source, once, 2025)) == values(once)
    # what the source no longer has goes, also in later years
    assert values(purchases.sales_year_replace(source.where("id_compra = 1"), once, 2025), "id_compra") == [(1,)]


def test_membership_price_class(frame, values):
    compras = frame(
        "compra long, socio long, prospecto long, tipo_item int, forma_pago int, estatus int, "
        "es_complementario boolean, precio decimal(19,2), moneda string, monto_pagado decimal(19,2), "
        "hash string, fecha_insert timestamp_ntz, fecha_pago timestamp_ntz, observaciones string",
        *[(i, None, i, 1, 2, 6, None, price, "USD", price, f"h{i}", at(2025, 1, 1), at(2025, 1, 1), None)
          for i, price in ((1, D("795.00")), (2, D("995.00")), (3, D("995.01")))],
    )
    prospects = frame("prospecto long, nuevo_socio long", (1, 11), (2, 99))
    socios = frame("socio long, nombre string, apellido_pat string, apellido_mat string",
                   (11, "A", "B", "C"))
    got = reports.memberships_gateway(compras, prospects, socios)
    assert values(got, "socio", "nombre", "tipo_de_producto") == [
        (None, None, "MEMBRESIA PREMIUM"), (None, None, "No identificado"), (11, "A B C", "MEMBRESIA BASIC"),
    ]


# --- records ------------------------------------------------------------------------------------


def pages(frame, *documents):
    return frame("payload string", *[(json.dumps(d),) for d in documents])


def envelope(*results):
    return {"response": {"results": list(results), "cursor": 0}}


def test_wallet_body_as_text_and_list(frame, values):
    one = {"Id": "a", "Coin": "BTC", "Saldo": 1.5}
    rows = pages(
        frame, {"body": json.dumps([one, {"Id": "b", "Coin": "X"}])}, {"body": [{"Id": "c", "Saldo": "2"}]}
    )
    got = {r[0]: r[1:] for r in values(records.wallet_balances(rows, ["a"], ["b"]))}
    assert got == {
        "a": ("BTC", D("1.5"), "compra"), "b": ("X", D(0), "pago"), "c": (None, D(2), "otro"),
    }


def test_purchase_complements(frame, values):
    def record(number, **more):
        return {"_id": f"r{number}", "id_compra": f"CP{number}", **more}

    landed = pages(
        frame,
        envelope(
            record(1, cantidad=0, USD="0", Fecha_pago="2025-01-01T00:00:00.000Z"),
            record(2, complemento_de="r1", cantidad="", Fecha_pago="soon"),
            record(3, complemento_de={"_id": "r1", "x": 1}),
        ),
        envelope(record(4, complemento_de="unknown"), record(5, complemento_de="")),
    )
    source = records.purchases_source(landed)
    got = {r.id_compra: (r.complemento_de, r.cantidad, r.usd, r.fecha_pago) for r in source.collect()}
    assert got == {
        1: (None, D(0), D(0), at(2025, 1, 1)), 2: (1, None, None, None), 3: (1, None, None, None),
        4: (None, None, None, None), 5: (None, None, None, None),
    }
    # the complemented purchase is already loaded and its page is not in this batch
    batch = pages(frame, envelope(record(6, complemento_de="r1")))
    assert records.purchases_source(batch).first().complemento_de is None
    assert records.purchases_source(batch, records.record_numbers(landed)).first().complemento_de == 1
    empty = source.where("false")
    assert records.json_purchases_new(landed, source).count() == 0
    assert records.json_purchases_new(landed, empty).count() == 5


def test_payout_ids_and_strict_time(frame):
    good = pages(frame, envelope({"id_pago": "PA12", "amount": 1, "socio": "", "Created Date": ""}))
    row = records.payouts_source(good).first()
    assert (row.pago_tx, row.amount, row.socio, row.created_at) == (12, D(1), None, None)
    bad = pages(frame, envelope({"id_pago": "PA12", "Created Date": "someday"}))
    with pytest.raises(Exception, match="not a timestamp"):
        records.payouts_source(bad).collect()


def test_payout_update_skips_missing_targets(frame, values):
    old = records.payouts_source(pages(frame, envelope({"id_pago": "PA1", "amount": "1.00", "Asset": "x"})))
    new = pages(frame, envelope({"id_pago": "pa1", "amount": "1.001", "Asset": " X "},
                                {"id_pago": "PA2", "amount": 5}))
    assert values(records.json_payouts_changed(new, old), "pago_tx", "asset") == [(1, "x")]
    changed = pages(frame, envelope({"id_pago": "pa1", "amount": "1.01", "Asset": "X"}))
    assert values(records.json_payouts_changed(changed, old), "amount", "asset") == [(D("1.01"), "X")]


def test_plan_buckets_agree_on_both_sides_of_the_size_check(spark, frame, values):
    ventas = frame("id_producto long, fecha_compra timestamp_ntz, precio decimal(19,2)",
                   *[(i % 4, at(2025, 1, 1 + i % 3, 3), D(i)) for i in range(40)], (9, at(2025, 1, 1), None))
    catalogue = frame("id_producto long, nombre string", (0, "select"), (1, "pa"), (2, None))
    small = values(aggregates.plan_buckets(ventas, catalogue))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert values(aggregates.plan_buckets(ventas, catalogue)) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ordered_reports(frame):
    socios = frame(
        "socio long, nombre string, apellido_pat string, apellido_mat string, estatus int, fecha_ingreso timestamp_ntz",
        (1, " A ", "B", "C", 1, at(2025, 1, 2)), (2, "A", "B", None, 2, at(2025, 1, 1)), (3, "A", "B", "C", 1, None),
        (4, "A", "B", "C", 3, at(2025, 1, 1)), (5, "A", "B", "C", 2, at(2025, 1, 1)), (6, "A", "B", "C", None, None),
    )
    assert [r.socio for r in reports.active_partners(socios, [5]).collect()] == [2, 1, 3]
    compras = frame(
        "compra long, socio long, tipo_item int, forma_pago int, estatus int, es_complementario boolean, "
        "precio decimal(19,2), moneda string, referencia string, fecha_insert timestamp_ntz, observaciones string",
        (1, 1, 5, 2, 6, None, D(1), "USD", "r1", at(2025, 1, 1, 5), None),
        (2, 2, 5, 2, 6, None, D(1), "USD", "r2", None, None),
        (3, 9, 5, 2, 6, None, D(1), "USD", "r3", at(2025, 1, 2), None),
        (4, 1, 5, 2, 6, True, D(1), "USD", "r4", at(2025, 1, 2), None),
        (5, 1, 5, 1, 6, None, D(1), "USD", "r5", at(2025, 1, 2), None),
        (6, 1, 5, 2, 5, None, D(1), "USD", "r6", at(2025, 1, 2), None),
        (7, 1, 1, 2, 6, None, D(1), "USD", "r7", at(2025, 1, 2), None),
    )
    rows = reports.maintenance_gateway(compras, socios).collect()
    assert [(r.id_transaccion, r.nombre_socio) for r in rows] == [("r2", None), ("r3", None), ("r1", "A B C")]


def test_course_status_and_price(frame, values):
    bought = frame(
        "socio long, item long, estatus int, forma_pago int, precio decimal(19,2), moneda string, referencia string, "
        "fecha_pago timestamp_ntz, fecha_pagado timestamp_ntz, observaciones string",
        (1, 7, 4, 2, D(5), "USD", "a", None, at(2025, 1, 2), None),
        (1, 8, 6, 1, D(5), "USD", "b", at(2025, 1, 1), at(2025, 1, 2), None),
        (1, 7, 6, 1, D(0), "USD", "c", None, None, None),
        (1, 7, -1, 1, D(5), "USD", "d", None, None, None),
        (1, 7, 6, 1, None, "USD", "e", None, None, None),
    )
    titles = frame("id_curso long, nombre string, ponentes string", (7, "T", "P"))
    socios = frame("socio long, nombre string, apellido_pat string, apellido_mat string", (1, "A", "B", "C"))
    shown = ("id_transaccion", "nombre_curso", "estatus_compra", "plataforma_cobro", "fecha_de_pago")
    assert values(reports.courses(bought, titles, socios), *shown) == [
        ("a", "T", "COMPLETADA", "OPENPAY", at(2025, 1, 2)),
        ("b", None, "COMPLETADA", "No identificado", at(2025, 1, 1)),
    ]
    returned = reports.courses(bought, titles, socios, statuses=[-1])
    assert values(returned, "estatus_compra") == [("DEVOLUCIÓN",)]
