"""Incremental JSON intake: the Spark form of polling an endpoint (7.5).

Each run picks up the files landed since the last one, inserts the records the fact lacks, and
stops.  A replayed micro-batch finds its records already in the table, so a lost executor or a
restarted run inserts nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerloom.operators import maintenance as m
from ledgerloom.plans import records
from ledgerloom.session import materialise
from ledgerloom.sources import landing, tables

Load = Callable[[DataFrame], None]


def read_page_stream(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """Landed pages as a stream with `payload` and where they landed."""
    pages = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(folder)
    return pages.select(*landing.landed(lines=False))


def intake(
    spark: SparkSession, folder: str, checkpoint: str, load: Load, files_per_batch: int = 1000
) -> StreamingQuery:
    """Start an available-now run that hands the new pages of `folder` to `load`, batch by batch."""
    return (
        read_page_stream(spark, folder, files_per_batch)
        .writeStream.foreachBatch(lambda batch, _: load(landing.number_lines(batch)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def add_new(table: str, rows_of: Callable[[DataFrame], DataFrame], keys: Sequence[str]) -> Load:
    """Load by appending the records `table` lacks.

    The table is read by the session of the micro-batch, which is the one that appends to it.
    """

    def load(batch: DataFrame) -> None:
        target = tables.current(batch.sparkSession, table)
        tables.append(m.new_rows(target, rows_of(batch), keys), table)

    return load


def add_purchases(table: str, numbers: str, waiting: str, base: str) -> Load:
    """Load for purchase records (F13), whose complements may sit in pages landed long ago or later.

    The table `numbers` (`_id string, numero bigint`) remembers the number of every record seen, and
    `waiting` (`id_compra bigint, referido string`) the facts whose complement has no number yet.  A
    batch costs its own pages and narrow lookups, not a second reading of the landing folder: new
    numbers meet the facts that wait for them, which are then updated.
    """

    def load(batch: DataFrame) -> None:
        session = batch.sparkSession
        parsed, _ = materialise(records.purchase_records(batch), "batch-records")
        seen, _ = materialise(records.record_numbers(parsed), "batch-numbers")
        tables.update(numbers, records.NUMBER_UPDATE, seen, base, "numbers")
        tables.append(m.new_rows(tables.current(session, numbers), seen, ["_id"]), numbers)
        known = tables.current(session, numbers)
        typed, _ = materialise(records.typed_purchases(parsed), "batch-purchases")
        open_ = typed.where(F.coalesce("referido", F.lit("")) != "").select("id_compra", "referido")
        open_ = open_.join(known.select(F.col("_id").alias("referido")), "referido", "left_anti")
        keys = ["id_compra", "referido"]
        tables.append(m.new_rows(tables.current(session, waiting), open_, keys), waiting)
        rows = records.with_complements(typed, known)
        tables.append(m.new_rows(tables.current(session, table), rows, ["id_compra"]), table)
        found = tables.current(session, waiting).join(
            seen.select(F.col("_id").alias("referido"), F.col("numero").alias("complemento_de")), "referido"
        )
        tables.update(
            table, records.COMPLEMENT_UPDATE, found.select("id_compra", "complemento_de"), base, "complement"
        )

    return load
