"""A third of all rows under one key: no task gets them all, and results stay whole.

The thresholds of AQE are lowered so that small data shows what large data would do.
"""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import maintenance as m
from ledgerloom.operators.hierarchy import nearest_ancestor
from ledgerloom.plans import kpis, payments, records

ROWS = 300_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
}


@pytest.fixture
def low_thresholds(spark):
    for key, value in SMALL.items():
        spark.conf.set(key, value)
    yield
    for key in SMALL:
        spark.conf.unset(key)


def final_plan(df) -> str:
    """The plan AQE ended with."""
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


def hot(spark, key: str, value):
    """`ROWS` rows over many partitions, a third of them with one key."""
    return spark.range(0, ROWS, 1, 24).select(
        F.when(F.col("id") % 3 == 0, F.lit(value)).otherwise(F.col("id")).cast("long").alias(key),
        F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


@pytest.mark.parametrize("key", [7, None])
def test_new_rows_with_a_hot_or_missing_key(spark, low_thresholds, key):
    target = spark.range(0, ROWS, 2, 8).select(F.col("id").alias("k"))
    fresh = m.new_rows(target, hot(spark, "k", key), ["k"])
    assert "skew=true" in final_plan(fresh)
    distinct = ROWS - ROWS // 3
    evens = spark.range(0, ROWS, 2).where("id % 3 <> 0").count()
    assert fresh.count() == distinct - evens + ROWS // 3


def test_lookup_of_a_hot_type(spark, low_thresholds):
    pagos = hot(spark, "tipo", 4).select(
        F.col("v").alias("pago"), F.col("v").alias("socio"), (F.col("tipo") % 20).cast("int").alias("tipo"),
        F.lit(1).cast("decimal(19,2)").alias("monto"), F.lit(0).cast("decimal(38,9)").alias("monto_pagado_btc"),
        F.lit(0).cast("decimal(38,9)").alias("cotiza_btc"), F.lit(1).alias("estatus"),
        *[F.lit(None).cast("timestamp_ntz").alias(c) for c in ("fecha", "fecha_pago", "fecha_pagado", "fecha_cancelacion")],
        F.lit(True).alias("defi"), F.lit(2).alias("mtd_dsp"), F.lit("1").alias("pago_tx"), "payload",
    )
    enum = spark.range(20).select(
        F.col("id").cast("int").alias("codigo"), F.lit("TipoPago").alias("categoria"), F.lit("x").alias("nombre")
    )
    rows = payments.bonuses_source(pagos, enum)
    assert "skew=true" in final_plan(rows)
    assert rows.count() == ROWS


def test_children_of_a_hot_parent(spark, low_thresholds):
    nodes = spark.range(0, ROWS, 1, 24).select(
        F.col("id").alias("node"),
        F.when(F.col("id") == 0, None)
        .when(F.col("id") % 3 == 0, F.lit(1))
        .otherwise((F.col("id") / 2).cast("long"))
        .alias("parent"),
    )
    good = spark.range(1).select(F.lit(0).cast("long").alias("node"))
    hits = nearest_ancestor(nodes, good)
    assert "skew=true" in final_plan(hits)
    assert hits.where("hit = 0").count() == ROWS - 1


def test_records_that_complement_one_purchase(spark, low_thresholds):
    record = F.to_json(
        F.struct(
            F.concat(F.lit("r"), F.col("id")).alias("_id"),
            F.concat(F.lit("CP"), F.col("id")).alias("id_compra"),
            F.when(F.col("id") % 3 == 0, F.lit("r1")).alias("complemento_de"),
            F.sha2(F.col("id").cast("string"), 256).alias("address"),
        )
    )
    pages = spark.range(0, ROWS // 3, 1, 24).select(
        F.concat(F.lit('{"response":{"results":['), record, F.lit("]}}")).alias("payload")
    )
    source = records.purchases_source(pages)
    assert "skew=true" in final_plan(source)
    assert source.where("complemento_de = 1").count() == source.where("id_compra % 3 = 0").count()
    assert source.count() == ROWS // 3


def test_aggregates_send_one_row_per_group_and_task(spark):
    """Hot groups are combined before the shuffle: written records are bounded by the groups."""
    compras = spark.range(0, ROWS, 1, 24).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 50).alias("socio"),
        F.lit(6).alias("estatus"),
        F.lit(2).alias("tipo_item"),
        F.timestamp_seconds(F.lit(1735689600) + F.col("id") * 10).cast("timestamp_ntz").alias("fecha_pago"),
    )
    rows = kpis.repurchase_monthly(compras, dt.date(2025, 1, 1))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.rindex("HashAggregate(keys=[socio")
    assert rows.agg(F.sum("total_compras"), F.sum("primeras_compras")).first()[:2] == (ROWS, 50)
