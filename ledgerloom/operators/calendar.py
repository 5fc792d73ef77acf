"""Gap-free day calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def day_calendar(spark: SparkSession, start: dt.date, end: dt.date, name: str = "fecha") -> DataFrame:
    """One row per day from `start` to `end`, both included."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))
    return spark.range(1).select(F.explode(days).alias(name))
