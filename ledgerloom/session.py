"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Reproducible dates need UTC; strict casts need ANSI; skewed joins are split at run time by AQE.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even when the split costs one more exchange above it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app: str = "ledgerloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session for scripts and tests; on a cluster `spark-submit` supplies master and sizes."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        # no Python call site per column: jobs build hundreds of them
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_sql_settings(spark: SparkSession) -> SparkSession:
    """Set the run-time SQL settings on a session somebody else created."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The application's folder for intermediate tables, under `spark.checkpoint.dir`.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine-local folder would not survive the loss of an executor, so that is refused.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if context.master != "local" and not context.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="ledgerloom-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def materialise(df: DataFrame, label: str, **counts: Column) -> tuple[DataFrame, dict]:
    """Write `df` as a table in the shared folder and read it back, with `counts` of its rows.

    This cuts the lineage with files that outlive any executor, gives the following joins true
    sizes to plan with, and leaves them a plain exchange that AQE can split.  The aggregates named
    in `counts` are observed during the write.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    seen = Observation()
    observed = df.observe(seen, *[c.alias(name) for name, c in counts.items()]) if counts else df
    observed.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), seen.get if counts else {}
