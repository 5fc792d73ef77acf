"""JSON pages written from test tables, one document per row, in the shapes the endpoints used."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.checks.standins import Tables


def _envelope(record: Column) -> Column:
    return F.concat(F.lit('{"response": {"results": ['), record, F.lit("]}}"))


def _text(name: str, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.col(name).cast("string"))


def wallets(t: Tables) -> DataFrame:
    """`body` is a list for views and text holding a list otherwise; clicks have no balance."""
    one = F.to_json(
        F.array(
            F.struct(
                _text("user_id", "W").alias("Id"),
                F.col("event_type").alias("Coin"),
                F.when(F.col("event_type") != "click", F.col("value")).alias("Saldo"),
            )
        )
    )
    as_text = F.to_json(F.struct(one.alias("body")))
    as_list = F.concat(F.lit('{"body": '), one, F.lit("}"))
    return t("events").select(
        F.when(F.col("event_type") == "view", as_list).otherwise(as_text).alias("payload")
    )


def transfers(t: Tables) -> DataFrame:
    record = F.to_json(
        F.struct(
            _text("event_id", "k").alias("_id"),
            _text("user_id", "W").alias("walletId"),
            F.col("event_type").alias("type"),
            F.when(F.col("event_type") != "error", F.lit("BTC")).alias("coin"),
            F.col("value"),
        )
    )
    return t("events").select(_envelope(record).alias("payload"))


def _landed(day: str) -> Column:
    """Landing order of pages that arrived on a day; one file a day."""
    return F.struct(
        F.lit(day).cast("timestamp").alias("at"),
        F.lit(f"{day}.json").alias("file"),
        F.lit(0).cast("long").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    ).alias("landed")


def _fetched_twice(latest: DataFrame, before: DataFrame) -> DataFrame:
    """Pages of two fetches: of the first, pages that hold two old versions of a record each."""
    first = before.select(F.concat_ws(", ", "older", "old").alias("record"), _landed("2024-05-01"))
    second = latest.select("record", _landed("2024-06-01"))
    pages = second.unionByName(first)
    return pages.select(_envelope(F.col("record")).alias("payload"), "landed")


#: Shapes of time text by order priority; 4-NOT SPECIFIED keeps ISO text, 5-LOW is blank in its last version.
TIME_SHAPES = {
    "1-URGENT": "M/d/yyyy",
    "2-HIGH": "MMM d, yyyy h:mm a",
    "3-MEDIUM": "EEE, dd MMM yyyy HH:mm:ss 'GMT'",
}


def _payment_time() -> Column:
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    for priority, shape in TIME_SHAPES.items():
        text = F.when(F.col("o_orderpriority") == priority, F.date_format("o_orderdate", shape)).otherwise(text)
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("")).otherwise(text)
    return F.when(F.col("o_orderstatus") == "P", F.lit("not a time")).otherwise(text)


def purchases(t: Tables) -> DataFrame:
    """The complement is bare text, an object, an unknown id or absent; times come in several shapes,
    blank or unreadable; two records in five were fetched before, with other values, some of them with a
    payment time that their last version lacks."""
    kind = F.col("o_custkey") % 10
    other = _text("o_custkey", "r")
    common = [
        _text("o_orderkey", "r").alias("_id"),
        _text("o_orderkey", "CP").alias("id_compra"),
        _text("o_custkey", "addr ").alias("address"),
        F.col("o_totalprice").alias("cantidad"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
        .otherwise(F.col("o_totalprice").cast("decimal(19,2)").cast("string"))
        .alias("Monto_recibido"),
        F.col("o_orderstatus").alias("status"),
        _payment_time().alias("Fecha_pago"),
        F.when(F.col("o_orderstatus") == "F", F.lit("BTC")).alias("coin"),
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_totalprice")).alias("USD"),
        _text("o_custkey", "W").alias("wallet"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("Created Date"),
    ]
    text = F.to_json(F.struct(*common, other.alias("complemento_de")))
    unknown = F.to_json(F.struct(*common, F.lit("nobody").alias("complemento_de")))
    nested = F.to_json(F.struct(*common, F.struct(other.alias("_id")).alias("complemento_de")))
    record = (
        F.when(kind == 0, text)
        .when(kind == 1, nested)
        .when(kind == 2, unknown)
        .otherwise(F.to_json(F.struct(*common)))
    )

    def version(status: str) -> Column:
        return F.to_json(
            F.struct(
                _text("o_orderkey", "r").alias("_id"),
                _text("o_orderkey", "CP").alias("id_compra"),
                F.lit(status).alias("status"),
                # the blank times of 5-LOW are times that were there and went
                F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_orderdate").cast("string")).alias("Fecha_pago"),
                F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("Created Date"),
            )
        )

    orders = t("orders")
    before = orders.where(F.col("o_orderpriority").isin("2-HIGH", "5-LOW")).select(
        version("first").alias("older"), version("second").alias("old")
    )
    return _fetched_twice(orders.select(record.alias("record")), before)


def payouts(t: Tables) -> DataFrame:
    """Views were fetched before, with another status."""

    def version(status: str) -> Column:
        return F.to_json(
            F.struct(
                F.concat(
                    F.when(F.col("event_type") == "view", F.lit("pa")).otherwise(F.lit("PA")),
                    F.col("event_id").cast("string"),
                ).alias("id_pago"),
                F.col("value").alias("amount"),
                F.col("event_type").alias("Asset"),
                F.lit("BTC").alias("coin"),
                F.lit(64000.25).alias("cotizacion"),
                F.lit(status).alias("status"),
                _text("event_id", "TX").alias("id_tx"),
                F.when(F.col("event_type") != "error", _text("user_id", "W")).alias("id_wallet"),
                F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("Created Date"),
                F.col("value").alias("amount_cripto"),
                F.lit("usd").alias("moneda"),
                F.when(F.col("event_type") != "click", F.col("user_id").cast("string"))
                .otherwise(F.lit(""))
                .alias("socio"),
            )
        )

    events = t("events")
    before = events.where(F.col("event_type") == "view").select(
        version("first").alias("older"), version("second").alias("old")
    )
    return _fetched_twice(events.select(version("Done").alias("record")), before)
