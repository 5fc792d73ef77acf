"""Report sink.  A report is written as one folder of CSV or Parquet files."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(df: DataFrame, folder: str, kind: str = "csv") -> None:
    if kind == "csv":
        df.write.mode("overwrite").option("header", True).csv(folder)
    elif kind == "parquet":
        df.write.mode("overwrite").parquet(folder)
    else:
        raise ValueError(f"unknown report format: {kind}")
