"""Purchases from a stream of pages, with what other records say of them as keyed state.

A purchase may complement one whose page landed long ago or lands later.  For each record id the state
holds its number, once it is known, and the purchases that ask for it until then.  A micro-batch sends
every record to the state of its own id, which learns the number, and to that of the record it
complements, which answers now or when the number comes.  So a batch reads its own pages, the state of
the ids it names, and the id blocks of the fact that it falls into: nothing that grows with what was
loaded before.  The state lives in RocksDB on the executors, its changes in the checkpoint.

A replayed batch gives the same rows and finds its purchases in the fact already.  After a lost checkpoint
all pages are read again; facts that are there stay, and complements come out the same.

The purchases that wait for one number are kept together, some 10 bytes each.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerloom.functions import jsonfields
from ledgerloom.operators import maintenance as m
from ledgerloom.plans import records
from ledgerloom.session import materialise
from ledgerloom.sources import landing, tables

_STATE = "numero long, orden string, esperan string"
_ANSWER = "id_compra long, complemento_de long, orden string, registro string"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FIELDS = [name for name, _ in landing.columns(landing.PURCHASE_RECORD)]


def read_numbered_pages(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Landed pages as a stream with `payload` and their order of landing, the line in the file included.

    Line numbers need whole files, so a file is read as one text; each holds what one fetch brought.
    """
    texts = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("wholetext", True).text(folder)
    lines = texts.select(
        F.col("_metadata.file_modification_time").alias("at"),
        F.col("_metadata.file_path").alias("file"),
        F.posexplode(F.split("value", "\n")).alias("line", "payload"),
    )
    order = F.struct("at", "file", F.lit(0).cast("long").alias("block"), F.col("line").cast("long").alias("line"))
    return lines.select("payload", order.alias("landed"))


def events(rows: DataFrame) -> DataFrame:
    """What purchase records (text fields and `_landed`) tell and ask, by the record id it concerns.

    A number event has `numero`, the number of the record `clave`; a purchase event has `id_compra` and
    the record as `registro`, and `pregunta` where it asks for the number of `clave`.
    """
    number = jsonfields.number_after_prefix(F.col("id_compra"))
    landed = F.col("_landed.landed")
    order = F.concat_ws(
        "/",
        F.date_format(landed["at"], "yyyyMMddHHmmssSSSSSS"),
        landed["file"],
        F.lpad(landed["line"].cast("string"), 10, "0"),
        F.lpad(F.col("_landed._place").cast("string"), 10, "0"),
    ).alias("orden")
    asked = jsonfields.reference_id(F.col("complemento_de"))
    none = F.lit(None).cast("long")
    told = F.when(
        (F.col("_id") != "") & (F.col("id_compra") != ""),
        F.struct(
            F.col("_id").alias("clave"), order, number.alias("numero"), none.alias("id_compra"),
            F.lit(False).alias("pregunta"), F.lit(None).cast("string").alias("registro"),
        ),
    )
    bought = F.struct(
        # a purchase that complements none goes by itself and leaves no state
        F.coalesce(asked, F.concat(F.lit("#"), F.coalesce("id_compra", F.lit("")))).alias("clave"),
        order, none.alias("numero"), number.alias("id_compra"), asked.isNotNull().alias("pregunta"),
        F.to_json(F.struct(*_FIELDS)).alias("registro"),
    )
    both = rows.select(F.explode(F.array(told, bought)).alias("evento"))
    return both.where(F.col("evento").isNotNull()).select("evento.*")


def _answer(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The purchases of one record id with what they complement, and answers to those that waited."""
    number, order, waiting = state.get if state.exists else (None, "", "")
    before = (number, order, waiting)
    asking = []
    for batch in batches:
        told = batch[batch["registro"].isna()].sort_values("orden")
        if len(told) and told["orden"].iloc[-1] >= order:
            number, order = int(told["numero"].iloc[-1]), str(told["orden"].iloc[-1])
        asking.append(batch[batch["registro"].notna()])
    late = []
    if number is not None and waiting:
        late = [int(p) for p in waiting.split(",")]
        waiting = ""
    for batch in asking:
        known = pd.array([number] * len(batch), dtype="Int64")
        found = pd.DataFrame(
            {
                "id_compra": batch["id_compra"].astype("Int64"),
                "complemento_de": known,
                "orden": batch["orden"],
                "registro": batch["registro"],
            }
        )
        found.loc[~batch["pregunta"].astype(bool), "complemento_de"] = pd.NA
        if number is None:
            open_ = batch.loc[batch["pregunta"].astype(bool) & batch["id_compra"].notna(), "id_compra"]
            ids = dict.fromkeys([*filter(None, waiting.split(",")), *map(str, open_.astype("int64"))])
            waiting = ",".join(ids)
        yield found
    if late:
        yield pd.DataFrame(
            {
                "id_compra": pd.array(late, dtype="Int64"),
                "complemento_de": pd.array([number] * len(late), dtype="Int64"),
                "orden": order,
                "registro": pd.Series([None] * len(late), dtype=object),
            }
        )
    if (number, order, waiting) != before:
        state.update((number, order, waiting))


def answers(told: DataFrame) -> DataFrame:
    """The stream of purchases and late answers from a stream of `events`."""
    return told.groupBy("clave").applyInPandasWithState(
        _answer, _ANSWER, _STATE, "append", GroupStateTimeout.NoTimeout
    )


def load(batch: DataFrame, table: str, base: str, block: str | None = None, block_size: int = 1) -> None:
    """Insert the purchases that `table` lacks and bring the answers into those it has.

    `block` names the partition of the table, the id over `block_size`; without it the table is plain.
    """
    found, _ = materialise(batch, "purchase-answers")
    # the last version in the batch counts, also where it complements none; else a late answer does
    version = F.struct(F.col("registro").isNotNull(), "orden")
    told = found.where(F.col("id_compra").isNotNull()).groupBy("id_compra")
    told = told.agg(F.max_by("complemento_de", version).alias("complemento_de"))
    told = told.where(F.col("complemento_de").isNotNull())
    text = ", ".join(f"`{name}` string" for name in _FIELDS)
    read = found.where(F.col("registro").isNotNull()).select(
        F.from_json("registro", text).alias("r"), F.col("orden").alias("_landed")
    )
    typed = records.typed_purchases(read.select("r.*", "_landed"))
    rows = typed.join(told, "id_compra", "left").select("id_compra", *records.PURCHASE_WATCH)
    if block is None:
        target = tables.current(batch.sparkSession, table)
        tables.append(m.new_rows(target, rows, ["id_compra"]), table)
    else:
        rows = rows.withColumn(block, F.floor(F.col("id_compra") / block_size))
        tables.insert_new(table, rows, ["id_compra"])
    tables.update(table, records.COMPLEMENT_UPDATE, told, base, "complement")


def purchase_intake(
    spark: SparkSession,
    folder: str,
    checkpoint: str,
    table: str,
    base: str,
    block: str | None = None,
    block_size: int = 1,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Start an available-now run that loads the purchases of the pages landed in `folder` since the last."""
    pages = read_numbered_pages(spark, folder, files_per_batch)
    rows = landing.read_records(landing.parsed(pages, landing.PURCHASE_RECORD))
    with tables.setting(spark, "spark.sql.streaming.stateStore.providerClass", _ROCKSDB):
        return (
            answers(events(rows))
            .writeStream.foreachBatch(lambda batch, _: load(batch, table, base, block, block_size))
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
