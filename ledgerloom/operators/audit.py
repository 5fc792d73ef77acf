"""L1: the run log, one row per step."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LOG_COLUMNS = ("estatus", "tabla", "proceso", "registros_insertados", "error_text", "fecha_registro")
LOG_SCHEMA = (
    "estatus string, tabla string, proceso string, registros_insertados bigint, "
    "error_text string, fecha_registro timestamp"
)
NO_ERROR = "No error"


def log_of(rows: DataFrame, table: str, process: str) -> DataFrame:
    """The log row of a step whose written rows are given, as a lazy one-row DataFrame."""
    return rows.agg(F.count("*").alias("registros_insertados")).select(
        F.lit("success").alias("estatus"),
        F.lit(table).alias("tabla"),
        F.lit(process).alias("proceso"),
        "registros_insertados",
        F.lit(NO_ERROR).alias("error_text"),
    )


def run_step(
    spark: SparkSession,
    table: str,
    process: str,
    work: Callable[[Observation], int | None],
    run_ts: dt.datetime,
) -> DataFrame:
    """Run one step and return its log row.

    `work` gets an observation to count written rows with (metric `n`), so that no second job
    counts them; or it returns the number itself.  A failure becomes a `failed` row with the
    message, as the log is what later steps and people look at.
    """
    counter = Observation()
    try:
        rows = work(counter)
        row = ("success", table, process, counter.get["n"] if rows is None else rows, NO_ERROR, run_ts)
    except Exception as error:  # any failure of the step belongs in the log
        row = ("failed", table, process, 0, str(error), run_ts)
    return spark.createDataFrame([row], LOG_SCHEMA)


def counted(df: DataFrame, counter: Observation) -> DataFrame:
    """`df` with its rows counted while they are written."""
    return df.observe(counter, F.count(F.lit(1)).alias("n"))
