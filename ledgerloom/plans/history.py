"""Change history of partners."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import maintenance as m

KEY, AT = "id_socio", "fecha_registro"
STATUS_WATCH = ("estatus", "fecha_vigencia_membresia")
RANK_WATCH = ("id_rango",)


def _status(dim_socios: DataFrame) -> DataFrame:
    return dim_socios.select(KEY, "estatus", "fecha_ingreso", "fecha_vigencia_membresia")


def _rank(dim_socios: DataFrame) -> DataFrame:
    return dim_socios.where(F.col("id_rango_actual") != 0).select(KEY, F.col("id_rango_actual").alias("id_rango"))


def status_changes(dim_socios: DataFrame, last: DataFrame, run_ts: Column) -> DataFrame:
    """Rows to append where status or validity date changed since the last record of a partner; the
    join date comes along."""
    return m.changes_since(_status(dim_socios), last, KEY, STATUS_WATCH, run_ts)


def rank_changes(dim_socios: DataFrame, last: DataFrame, run_ts: Column) -> DataFrame:
    """Rows to append where the rank changed; rank 0 and missing ranks are skipped, a last
    record without rank counts as none."""
    return m.changes_since(_rank(dim_socios), last, KEY, RANK_WATCH, run_ts, null_is_absent=True)


def status_history(dim_socios: DataFrame, hist_membresias: DataFrame, run_ts: Column) -> DataFrame:
    """S1 against the whole history."""
    return status_changes(dim_socios, m.latest_per_key(hist_membresias, [KEY], AT, STATUS_WATCH), run_ts)


def rank_history(dim_socios: DataFrame, hist_rangos: DataFrame, run_ts: Column) -> DataFrame:
    """S2 against the whole history."""
    return rank_changes(dim_socios, m.latest_per_key(hist_rangos, [KEY], AT, RANK_WATCH), run_ts)
