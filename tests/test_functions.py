"""Column builders on their edge values."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import dates, jsonfields, labels, money

ACCOUNT = "000111222333444555"


def one(df, column):
    return [r[0] for r in df.orderBy("i").select(column).collect()]


def texts(frame, *rows):
    return frame("i int, t string", *enumerate(rows))


def test_money_text(frame):
    df = texts(frame, "$1,234.50", "1234.5", "", None, "-$5.00")
    assert one(df, money.clean_money(F.col("t"))) == [
        Decimal("1234.50"), Decimal("1234.50"), None, None, Decimal("-5.00"),
    ]
    cleaned = money.clean_money_columns(df, ["t"])
    assert cleaned.schema["t"].dataType.simpleString() == "decimal(19,2)"


def test_money_refuses_other_text(frame):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        texts(frame, "abc").select(money.clean_money(F.col("t"))).collect()


def test_percent_rounds_half_up_and_guards_zero(frame):
    df = frame("i int, a long, b long", (0, 1, 3), (1, 2, 3), (2, 1, 800), (3, 0, 0), (4, 5, 5))
    got = one(df, money.percent(F.col("a"), F.col("b")).cast("double"))
    assert got == [33.33, 66.67, 0.13, None, 100.0]


def test_crypto_text(frame):
    df = frame(
        "i int, x decimal(38,9)",
        (0, Decimal("6.55")), (1, Decimal("0.26")), (2, Decimal("112946.26")),
        (3, Decimal("1234567.5")), (4, Decimal(0)), (5, None),
    )
    shown = one(df, money.btc_text_or_zero(F.col("x")))
    assert shown == [
        "       6.550000000", "        .260000000", " 112,946.260000000",
        "1,234,567.500000000", "0", None,
    ]


def test_leap_day_plus_years(frame):
    df = frame("i int, d date", (0, dt.date(2024, 2, 29)))
    assert one(df, dates.plus_years(F.col("d"), 1)) == [dt.date(2025, 2, 28)]
    assert one(df, dates.plus_years(F.col("d"), 4)) == [dt.date(2028, 2, 29)]


def test_lenient_and_strict_times(frame):
    df = texts(frame, "2025-03-04T05:06:07.000Z", "2025-03-04 05:06:07", "2025-03-04", None, "")
    noon = dt.datetime(2025, 3, 4, 5, 6, 7)
    want = [noon, noon, dt.datetime(2025, 3, 4), None, None]
    assert one(df, dates.lenient_timestamp(F.col("t"))) == want
    assert one(df, dates.strict_timestamp(F.col("t"))) == want
    five = dt.datetime(2025, 3, 5)
    shapes = {
        "25/03/2025": dt.datetime(2025, 3, 25),
        "03/25/2025 3:04 PM": dt.datetime(2025, 3, 25, 15, 4),
        "3/5/2025": five,
        "2025/03/05": five,
        "20250305": five,
        "20250305T101112": dt.datetime(2025, 3, 5, 10, 11, 12),
        "5 March 2025": five,
        "5th of March, 2025": five,
        "March 5, 2025": five,
        "Mar 5, 2025 3:04 PM": dt.datetime(2025, 3, 5, 15, 4),
        "mar 5, 2025 12:04 am": dt.datetime(2025, 3, 5, 0, 4),
        "2025-03-05 10:00 pm": dt.datetime(2025, 3, 5, 22),
        "Wed, 05 Mar 2025 10:00:00 GMT": dt.datetime(2025, 3, 5, 10),
        "Wednesday, March 5, 2025 at 10:00": dt.datetime(2025, 3, 5, 10),
        "05.03.2025 10:11:12.5": dt.datetime(2025, 5, 3, 10, 11, 12, 500000),
        "2025/03/05 10:00:00 +02:00": dt.datetime(2025, 3, 5, 8),
        "2025/03/05 10:00:00 +0200": dt.datetime(2025, 3, 5, 8),
        "3/5/25": five,
        "05-Mar-25": five,
        "5-mar-75": dt.datetime(1975, 3, 5),
        "2025-Mar-05 1:02:03,25": dt.datetime(2025, 3, 5, 1, 2, 3, 250000),
        "Mar 5 2025 10PM": dt.datetime(2025, 3, 5, 22),
        "5.3.2025 10 a.m.": dt.datetime(2025, 5, 3, 10),
        "2025-03-05 10:00 EST": dt.datetime(2025, 3, 5, 10),
        "20250305101500": dt.datetime(2025, 3, 5, 10, 15),
        "202503051015": dt.datetime(2025, 3, 5, 10, 15),
        "10:30 2025-03-05": dt.datetime(2025, 3, 5, 10, 30),
        "Wed Mar  5 10:00:00 2025": dt.datetime(2025, 3, 5, 10),
        "Wed Mar  5 10:00:00 EST 2025": dt.datetime(2025, 3, 5, 10),
        "99-01-04": dt.datetime(1999, 1, 4),
        "2025-3-5": five,
        "  2025-03-05 ": five,
        "2025-03-05T10:00:00.123456789Z": dt.datetime(2025, 3, 5, 10, 0, 0, 123456),
        "2025-03-05 10:00 est": None,
        "SOON 3/5/25": None,
        "EST 3/5/25": None,
        "10:00 11:00 3/5/25": None,
        "10:00 EST PST 3/5/25": None,
        "1/2/3/2025": None,
        "Mar 2025": None,
        "12:30": None,
        "2025": None,
        "20250230": None,
        "2025030510": None,
        "- / .": None,
        "2025-02-30": None,
        "13/13/2025": None,
        "Foo 5, 2025": None,
        "5 Anf 2025": None,
        "2025/03/05 25:00": None,
        "2025/03/05 13:00 pm": None,
        "2025/03/05 soon": None,
    }
    df = frame("i int, t string", *enumerate(shapes))
    got = {r.t: r.at for r in df.select("t", dates.lenient_timestamp(F.col("t")).alias("at")).collect()}
    assert got == shapes
    odd = texts(frame, "not a time")
    assert one(odd, dates.lenient_timestamp(F.col("t"))) == [None]
    with pytest.raises(Exception, match="not a timestamp"):
        odd.select(dates.strict_timestamp(F.col("t"))).collect()


def test_times_are_read_by_generated_code_in_bounded_time(spark):
    settings = {"spark.sql.codegen.fallback": "false", "spark.sql.codegen.factoryMode": "CODEGEN_ONLY"}
    moments = spark.range(100_000).select(F.timestamp_seconds(F.col("id") * 1000 + 1_600_000_000).alias("at"))
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        for shape in ("yyyy-MM-dd'T'HH:mm:ss'Z'", "MMM d, yyyy h:mm:ss a", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"):
            read = dates.lenient_timestamp(F.date_format("at", shape))
            assert moments.where(~read.eqNullSafe(F.col("at"))).isEmpty()
        plan = moments.select(read.alias("read"))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("regexp_extract_all") == 1
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_day_bounds(frame):
    df = frame(
        "i int, t timestamp_ntz",
        (0, dt.datetime(2025, 12, 31)), (1, dt.datetime(2025, 12, 31, 15)), (2, dt.datetime(2026, 1, 1)),
    )
    first, last = dt.date(2025, 1, 1), dt.date(2025, 12, 31)
    assert one(df, dates.in_days(F.col("t"), first, last)) == [True, True, False]
    assert one(df, dates.between_midnights(F.col("t"), first, last)) == [True, False, False]


def test_prefixed_ids(frame):
    df = texts(frame, "CP123", "PA0009")
    assert one(df, jsonfields.number_after_prefix(F.col("t"))) == [123, 9]
    assert one(texts(frame, "pa77", "PA8"), jsonfields.number_without(F.col("t"), "PA")) == [77, 8]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        texts(frame, "CPx").select(jsonfields.number_after_prefix(F.col("t"))).collect()


def test_json_amounts_keep_zero(frame):
    df = texts(frame, "0", "", None, "1.5")
    got = one(df, jsonfields.amount(F.col("t")))
    assert got == [Decimal("0.00"), None, None, Decimal("1.50")]


def test_reference_is_text_or_object(frame):
    df = texts(frame, "r1", '{"_id":"r2","x":1}', "", None)
    assert one(df, jsonfields.reference_id(F.col("t"))) == ["r1", "r2", None, None]


def test_status_labels_and_unknown_code(frame):
    df = frame("i int, c int", (0, -2), (1, 6), (2, 7), (3, None))
    got = one(df, labels.purchase_status(F.col("c")))
    assert got == ["Estatus manual de cambio", "Pagado", None, None]


def test_coin_defaults(frame):
    df = frame("i int, c int", (0, 2), (1, 1), (2, None))
    assert one(df, labels.coin(F.col("c"))) == ["CNKT", "BTC", "BTC"]


def test_bucket_first_pattern_wins(frame):
    df = texts(frame, "Plan select 9", "select24 select36", "SELECT36", "select", "Papel", "zzz", None)
    got = one(df, labels.bucket_of(F.col("t"), fixed.PLAN_BUCKETS, fixed.PLAN_BUCKET_OTHER))
    assert got == ["PLAN SELECT", "SELECT24", "SELECT36", "SELECT", "PA / PA24", "OTROS", "OTROS"]


def test_full_name_needs_every_part(frame):
    df = frame(
        "i int, nombre string, apellido_pat string, apellido_mat string",
        (0, " Ana ", "Paz", "Gil "), (1, "Ana", None, "Gil"),
    )
    assert one(df, labels.full_name()) == ["Ana Paz Gil", None]


# one row per branch: (method, entity, reference, second, third)
BRANCHES = [
    (1, None, None, None, None),
    (2, 1, None, None, None),
    (2, 2, None, None, None),
    (2, 3, None, None, None),
    (3, None, "trx-9", None, "BTC"),
    (3, None, "x", None, "BTC"),
    (3, None, "x", None, "CNKT_POL"),
    (3, None, None, None, "USDT_TRON"),
    (3, None, None, None, None),
    (0, None, None, None, None),
    (6, 1, None, None, None),
    (6, 1, None, ACCOUNT, None),
    (6, 1, None, "other", None),
    (6, 2, None, "other", None),
    (9, 1, None, "other", None),
    (9, 1, None, None, None),
    (9, None, None, "other", None),
    (4, None, None, None, None),
    (5, None, None, None, None),
    (7, None, None, None, None),
    (8, None, None, None, None),
    (10, None, None, None, None),
    (11, None, None, None, None),
    (12, None, None, None, None),
    (13, None, None, None, None),
    (None, None, None, None, None),
]
SHARED = {
    0: "BTC", 1: "FIAT - OpenPay", 2: "FIAT - Banorte", 3: "x", 5: "FLEXPAY - BTC",
    6: "FLEXPAY - CNKT_POL", 7: "FLEXPAY - USDT_TRON", 8: "x", 9: "Bono único", 15: "x", 16: "x",
    17: "Polygon - CNKT", 18: "Polygon - BTC", 19: "Polygon - USDT", 20: "FIAT - STRIPE",
    24: "x", 25: "x",
}
BANK = {10: "FIAT - TRX - BBVA", 11: "FIAT - TRX - BBVA", 12: "FIAT - TRX - STP", 13: "x"}
WIRE = dict.fromkeys((10, 11, 12, 13), "Transferencia")
VARIANTS = {
    "MEMBERSHIP_METHODS": {
        4: "FLEXPAY - TRX_CNKT_POL", **WIRE, 14: "FIAT - TRX - STP",
        21: "LINK PAGO - OPENPAY", 22: "LINK PAGO - PAYONEER", 23: "Polygon - CNKT+",
    },
    "MEMBERSHIP_METHODS_OPEN": {
        4: "FLEXPAY - TRX_CNKT_POL", **WIRE, 14: "x", 21: "x", 22: "x", 23: "x",
    },
    "ANNUITY_METHODS": {
        4: "FLEXPAY - TRX_CNKT", **BANK, 14: "FIAT - TRX - STP",
        21: "LINK PAGO - OPENPAY", 22: "x", 23: "Polygon - CNKT+",
    },
    "ANNUITY_METHODS_OPEN": {
        4: "FLEXPAY - TRX_CNKT", **BANK, 14: "x", 21: "LINK PAGO - OPENPAY", 22: "x", 23: "x",
    },
    "SALES_METHODS": {
        4: "FLEXPAY - TRX_CNKT", **BANK, 14: "FIAT - TRX - STP", 21: "x", 22: "x",
        23: "Polygon - CNKT+",
    },
}


@pytest.mark.parametrize("variant", sorted(VARIANTS))
def test_payment_method_branches(frame, variant):
    df = frame(
        "i int, forma_pago int, entidad_pago int, referencia string, referencia2 string, referencia3 string",
        *[(i, *row) for i, row in enumerate(BRANCHES)],
    )
    got = one(df, labels.payment_method(getattr(fixed, variant), ACCOUNT))
    assert dict(enumerate(got)) == {**SHARED, **VARIANTS[variant]}


def test_reconciliation_method_has_no_default(frame):
    df = frame("i int, c int", (0, 4), (1, 5), (2, 7), (3, 1))
    got = one(df, labels.label_of(F.col("c"), fixed.ONCHAIN_METHODS))
    assert got == ["Polygon - CNKT", "Polygon - BTC", "Polygon - USDT", None]
