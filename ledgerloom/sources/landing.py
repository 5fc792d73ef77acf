"""JSON record dumps (P2-P4): one landed file per fetched page, each page one JSON document.

Fetching pages is not Spark work; whatever lands them writes one document per line.  Reading
the whole folder replaces the page loop, and never stops at the first page (Q23).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.dates import lenient_timestamp, let
from ledgerloom.operators.maintenance import first_per_key

# Every field is read as text and cast by the job, so one odd record does not void a page.
PURCHASE_RECORD = (
    "_id string, id_compra string, address string, cantidad string, Monto_recibido string, "
    "status string, Fecha_pago string, coin string, complemento_de string, USD string, "
    "wallet string, `Created Date` string"
)
PAYOUT_RECORD = (
    "id_pago string, amount string, Asset string, coin string, cotizacion string, status string, "
    "id_tx string, id_wallet string, `Created Date` string, address string, amount_cripto string, "
    "moneda string, socio string"
)
TRANSFER_RECORD = "_id string, walletId string, type string, coin string, value string"
WALLET_RECORD = "Id string, Coin string, Saldo string"


def landed(lines: bool = True) -> list[Column]:
    """Where and when the file of a row landed, as one sortable column `landed`.

    `lines` adds a number that ascends with the lines of a part of a file; a stream adds it batch by
    batch with `number_lines`.
    """
    parts = [
        F.col("_metadata.file_modification_time").alias("at"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    ]
    if lines:
        parts.append(F.monotonically_increasing_id().alias("line"))
    return [F.col("value").alias("payload"), F.struct(*parts).alias("landed")]


def landing_order(at: Column) -> Column:
    """`landed` for pages that came without it: all at one moment, in the order they are read."""
    return F.struct(
        at.cast("timestamp").alias("at"),
        F.lit("").alias("file"),
        F.lit(0).cast("long").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


def number_lines(pages: DataFrame) -> DataFrame:
    """Pages of a micro-batch with their line numbers in `landed`."""
    return pages.withColumn(
        "landed", F.struct("landed.*", F.monotonically_increasing_id().alias("line"))
    )


def read_pages(spark: SparkSession, folder: str, whole_files: bool = False) -> DataFrame:
    """The landed documents as text column `payload`, with `landed`, their order of landing.

    One document per line, or, with `whole_files`, one document of any shape per file.
    """
    return spark.read.text(folder, wholetext=whole_files).select(*landed())


def parsed(pages: DataFrame, record: str, payload: str = "payload") -> DataFrame:
    """The records of the `response.results` envelopes, each page read once.

    One row per record: `_record`, and `_landed`, its order.  A page that is no such envelope (cut off,
    spread over lines, an error document) is a row with its text in `_unread`; blank lines are no pages.
    """
    results = F.from_json(F.col(payload), _envelope(record))["response"]["results"]
    return _exploded(pages, results, F.col(payload))


def parsed_wallets(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """As `parsed`, for wallets; `body` is a JSON list, or text that holds one.

    `get_json_object` gives the same text for both shapes.
    """
    body = F.get_json_object(F.col(payload), "$.body")
    results = F.from_json(body, f"array<struct<{_as_struct(WALLET_RECORD)}>>")
    return _exploded(pages, results, F.col(payload))


def _exploded(pages: DataFrame, results: Column, payload: Column) -> DataFrame:
    order = [F.col("landed")] if "landed" in pages.columns else []
    # the parsed column is named twice below, so it stays a column and is not computed twice
    read = pages.select(*order, payload.alias("_text"), results.alias("_results"))
    unread = F.when(F.col("_results").isNull() & (F.coalesce(F.trim("_text"), F.lit("")) != ""), F.col("_text"))
    flagged = read.select(*order, "_results", unread.alias("_unread"))
    # outer: a page without an array keeps a row, and Spark infers no filter that would parse again
    rows = flagged.select(*order, "_unread", F.posexplode_outer("_results").alias("_place", "_record"))
    found = rows.where(F.col("_place").isNotNull() | F.col("_unread").isNotNull())
    return found.select("_record", F.struct(*order, "_place").alias("_landed"), "_unread")


def read_records(found: DataFrame, allow_unread: bool = False) -> DataFrame:
    """The fields of the records of `parsed`, and `_landed`.

    A page that was not understood fails the job; with `allow_unread` it is left out here and found by
    `unread`.
    """
    # only a page that was not understood is a row without a place; a test of `_unread` would be pushed
    # below the explosion and there parse the page again
    misread = F.col("_landed._place").isNull()
    kept = ~misread
    if not allow_unread:
        message = F.concat(F.lit("page not understood: "), F.substring("_unread", 1, 200))
        kept = F.when(misread, F.raise_error(message).cast("boolean")).otherwise(True)
    return found.where(kept).select("_record.*", "_landed")


def unread(found: DataFrame) -> DataFrame:
    """The pages of `parsed` that were not understood, as `payload`."""
    return found.where(F.col("_landed._place").isNull()).select(F.col("_unread").alias("payload"))


def records(
    pages: DataFrame, record: str, payload: str = "payload", allow_unread: bool = False
) -> DataFrame:
    """One row per record of the `response.results` envelopes, see `parsed` and `read_records`."""
    return read_records(parsed(pages, record, payload), allow_unread)


def wallet_records(
    pages: DataFrame, payload: str = "payload", allow_unread: bool = False
) -> DataFrame:
    """One row per wallet."""
    return read_records(parsed_wallets(pages, payload), allow_unread)


def unread_pages(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """The pages that are neither an envelope of records nor blank."""
    return unread(parsed(pages, "_id string", payload))


def _envelope(record: str) -> str:
    return f"response struct<results: array<struct<{_as_struct(record)}>>>"


def latest(rows: DataFrame, key: str) -> DataFrame:
    """The version of each record that landed last; rows without the key all stay.

    A folder gathers a record again with every fetch that met it.
    """
    apart = F.when(F.col(key).isNull(), F.col("_landed"))
    return first_per_key(rows.withColumn("_apart", apart), [key, "_apart"], [F.desc("_landed")]).drop(
        "_apart"
    )


def created_between(
    df: DataFrame, after: dt.datetime, before: dt.datetime, filled: str | None = None
) -> DataFrame:
    """The filter the endpoint applied, i.e. created inside a span and a field not blank.

    The endpoint filters what it holds now, so `df` has the last version of each record (`latest`): one
    that lost the field since is out, although an older version of it has landed.
    """
    inside = let(
        lenient_timestamp(F.col("Created Date")), lambda at: (at > F.lit(after)) & (at < F.lit(before))
    )
    kept = df.where(inside)
    return kept if filled is None else kept.where(F.coalesce(F.col(filled), F.lit("")) != "")


def columns(record: str) -> list[tuple[str, str]]:
    """Names and types of the fields of a record."""
    parts = (f.strip().rpartition(" ") for f in record.split(","))
    return [(name.strip("`"), kind) for name, _, kind in parts]


def _as_struct(record: str) -> str:
    return ", ".join(f"`{name}`: {kind}" for name, kind in columns(record))
