"""Facts from JSON record dumps: wallets, internal transfers, purchases, payouts.

Input is the pages DataFrame of `sources.landing`, so the same jobs serve a batch read, a stream
micro-batch or payload columns of a table; all jobs also take records parsed before (`purchase_records`
and the like, or a table that keeps the last version of each record, see `tables.merge_latest`), so that a
run parses its pages once.  Of a record that landed several times the last version counts, and filters act
on that version only.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fixed
from ledgerloom.functions import compare, dates, jsonfields, labels
from ledgerloom.operators import maintenance as m
from ledgerloom.session import materialise
from ledgerloom.sources import landing

PURCHASE_WATCH = (
    "address", "cantidad", "monto_recibido", "status", "fecha_pago",
    "coin", "complemento_de", "usd", "wallet",
)
PAYOUT_WATCH = (
    "amount", "asset", "coin", "cotizacion", "estatus", "id_tx", "id_wallet", "amount_crypto",
)
#: Records created after one moment and before another.
Span = tuple[dt.datetime, dt.datetime]
RECORD_UPDATE = m.Update(("id_compra",), PURCHASE_WATCH, comparable=compare.tolerant)
NUMBER_UPDATE = m.Update(("_id",), ("numero",))
COMPLEMENT_UPDATE = m.Update(("id_compra",), ("complemento_de",))
PAYOUT_UPDATE = m.Update(("pago_tx",), PAYOUT_WATCH, comparable=compare.tolerant)


def wallet_balances(
    pages: DataFrame, buys: Sequence[str], pays: Sequence[str], allow_unread: bool = False
) -> DataFrame:
    """Rows to append; a missing balance is 0, an id on neither list is 'otro'."""
    classes = {fixed.WALLET_BUYS: buys, fixed.WALLET_PAYS: pays}
    balance = F.coalesce(jsonfields.amount(F.col("Saldo"), "decimal(38,9)"), F.lit(0))
    rows = landing.wallet_records(pages, allow_unread=allow_unread) if "payload" in pages.columns else pages
    return rows.select(
        F.col("Id").alias("wallet_id"),
        F.col("Coin").alias("coin"),
        balance.cast("decimal(38,9)").alias("saldo"),
        labels.class_of(F.col("Id"), classes, fixed.WALLET_OTHER).alias("tipo"),
    )


def transfer_records(pages: DataFrame, allow_unread: bool = False) -> DataFrame:
    """The transfer records of the pages, as text, each with its order of landing."""
    return landing.records(pages, landing.TRANSFER_RECORD, allow_unread=allow_unread)


def transfers_source(pages: DataFrame, allow_unread: bool = False) -> DataFrame:
    rows = _parsed(pages, lambda p: transfer_records(p, allow_unread))
    return landing.latest(rows, "_id").select(
        F.col("walletId").alias("wallet_id"),
        F.col("type").alias("tipo"),
        F.col("coin").alias("moneda"),
        jsonfields.amount(F.col("value"), "decimal(38,9)").alias("monto"),
        F.col("_id").alias("kft_id"),
    )


def internal_transfers_new(
    pages: DataFrame, fact_transacciones_internas: DataFrame, allow_unread: bool = False
) -> DataFrame:
    """F12."""
    return m.new_rows(fact_transacciones_internas, transfers_source(pages, allow_unread), ["kft_id"])


def purchase_records(pages: DataFrame, allow_unread: bool = False) -> DataFrame:
    """The purchase records of the pages, as text, each with its order of landing."""
    return landing.records(pages, landing.PURCHASE_RECORD, allow_unread=allow_unread)


def payout_records(pages: DataFrame, allow_unread: bool = False) -> DataFrame:
    """The payout records of the pages, as text, each with its order of landing."""
    return landing.records(pages, landing.PAYOUT_RECORD, allow_unread=allow_unread)


def _parsed(pages: DataFrame, parse) -> DataFrame:
    return parse(pages) if "payload" in pages.columns else pages


def record_numbers(pages: DataFrame) -> DataFrame:
    """Purchase number by record id; of several records with one id the one that landed last counts."""
    rows = _parsed(pages, purchase_records).select("_id", "id_compra", "_landed")
    return landing.latest(rows.where((F.col("_id") != "") & (F.col("id_compra") != "")), "_id").select(
        "_id", jsonfields.number_after_prefix(F.col("id_compra")).alias("numero")
    )


def typed_purchases(pages: DataFrame, span: Span | None = None) -> DataFrame:
    """The last version of each purchase, with the record id it complements in `referido`.

    With `span` only purchases count whose last version was created in it and has a payment time.
    """
    rows = _parsed(pages, purchase_records)
    rows = rows.withColumn("id_compra", jsonfields.number_after_prefix(F.col("id_compra")))
    rows = landing.latest(rows, "id_compra")
    if span is not None:
        rows = landing.created_between(rows, *span, filled="Fecha_pago")
    return rows.select(
        "id_compra",
        "address",
        jsonfields.amount(F.col("cantidad")).alias("cantidad"),
        jsonfields.amount(F.col("Monto_recibido")).alias("monto_recibido"),
        "status",
        dates.lenient_timestamp(F.col("Fecha_pago")).alias("fecha_pago"),
        "coin",
        jsonfields.reference_id(F.col("complemento_de")).alias("referido"),
        jsonfields.amount(F.col("USD")).alias("usd"),
        "wallet",
    )


def with_complements(typed: DataFrame, numbers: DataFrame) -> DataFrame:
    """Typed purchases, the complemented purchase translated from record id to number."""
    numbers = numbers.select(
        F.col("_id").alias("referido"), F.col("numero").alias("complemento_de")
    )
    return typed.join(numbers, "referido", "left").select("id_compra", *PURCHASE_WATCH)


def purchases_source(
    pages: DataFrame, numbers: DataFrame | None = None, span: Span | None = None
) -> DataFrame:
    """Purchase records, the complemented purchase translated from record id to number.

    The translation needs the numbers of all records, not only of new ones or of those in the span:
    `numbers`, or else those of the same pages.  The records are then parsed once and stored, and so
    are the numbers: stored, the lookup has a measured size and gives the join a plain input, so AQE
    can split a purchase complemented very often, and the many records that complement none.
    """
    if numbers is None:
        if "payload" in pages.columns:
            pages, _ = materialise(purchase_records(pages), "purchase-records")
        numbers, _ = materialise(record_numbers(pages), "record-numbers")
    return with_complements(typed_purchases(pages, span), numbers)


def unread_times(pages: DataFrame) -> DataFrame:
    """Purchase records whose payment time is filled but in no shape that is understood."""
    rows = _parsed(pages, purchase_records)
    text = F.col("Fecha_pago")
    filled = F.coalesce(F.trim(text), F.lit("")) != ""
    return rows.where(filled & dates.lenient_timestamp(text).isNull())


def json_purchases_new(
    pages: DataFrame,
    fact_kft_compras_planes: DataFrame,
    numbers: DataFrame | None = None,
    span: Span | None = None,
) -> DataFrame:
    """F13."""
    return m.new_rows(fact_kft_compras_planes, purchases_source(pages, numbers, span), ["id_compra"])


def json_purchases_changed(
    pages: DataFrame,
    fact_kft_compras_planes: DataFrame,
    numbers: DataFrame | None = None,
    span: Span | None = None,
) -> DataFrame:
    """the tolerant update, numeric ids and translated complements on both sides (Q10)."""
    return RECORD_UPDATE.state(fact_kft_compras_planes, purchases_source(pages, numbers, span))


def _payouts(pages: DataFrame, number, span: Span | None) -> DataFrame:
    """The last version of each payout, by the number its id holds.

    A record without an id is no version of another one, so it may leave before.
    """
    rows = _parsed(pages, payout_records)
    if span is not None:
        rows = rows.where(F.col("id_pago") != "")
    rows = landing.latest(rows.withColumn("pago_tx", number), "pago_tx")
    return rows if span is None else landing.created_between(rows, *span)


def payouts_source(pages: DataFrame, span: Span | None = None) -> DataFrame:
    """Payout records; unreadable ids, partners and times fail the job.

    With `span` only payouts with an id count whose last version was created in it.
    """
    return _payouts(pages, jsonfields.number_after_prefix(F.col("id_pago")), span).select(
        "pago_tx",
        jsonfields.amount(F.col("amount")).alias("amount"),
        F.col("Asset").alias("asset"),
        "coin",
        jsonfields.amount(F.col("cotizacion")).alias("cotizacion"),
        F.col("status").alias("estatus"),
        "id_tx",
        "id_wallet",
        dates.strict_timestamp(F.col("Created Date")).alias("created_at"),
        "address",
        jsonfields.amount(F.col("amount_cripto"), "decimal(38,9)").alias("amount_crypto"),
        "moneda",
        jsonfields.whole_number(F.col("socio")).alias("socio"),
    )


def json_payouts_new(
    pages: DataFrame, fact_kft_pagos_planes: DataFrame, span: Span | None = None
) -> DataFrame:
    """F15."""
    return m.new_rows(fact_kft_pagos_planes, payouts_source(pages, span), ["pago_tx"])


def payouts_update_source(pages: DataFrame, span: Span | None = None) -> DataFrame:
    """Records keyed by the id without its marker, letters of any case (Q11)."""
    number = jsonfields.number_without(F.col("id_pago"), fixed.PAYOUT_PREFIX)
    return _payouts(pages, number, span).select(
        "pago_tx",
        jsonfields.amount(F.col("amount")).alias("amount"),
        F.col("Asset").alias("asset"),
        "coin",
        jsonfields.amount(F.col("cotizacion")).alias("cotizacion"),
        F.col("status").alias("estatus"),
        "id_tx",
        "id_wallet",
        jsonfields.amount(F.col("amount_cripto"), "decimal(38,9)").alias("amount_crypto"),
    )


def json_payouts_changed(
    pages: DataFrame, fact_kft_pagos_planes: DataFrame, span: Span | None = None
) -> DataFrame:
    """F16."""
    return PAYOUT_UPDATE.state(fact_kft_pagos_planes, payouts_update_source(pages, span))
