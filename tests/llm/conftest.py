from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

TABLES = "documents embeddings labels".split()
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def small():
    """Rows of a table of the smallest folder, and the folder."""
    folder = "/root/testdata/sf0.001"

    def rows(sql: str) -> list[tuple]:
        connection = duckdb.connect()
        for table in TABLES:
            connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
        return connection.sql(sql).fetchall()

    rows.folder = folder
    return rows


@pytest.fixture
def docs(spark):
    """`docs([(doc_id, text), ...])` as a documents table, also with columns of other operators."""

    def build(rows, extra: bool = True):
        full = [(i, t, "en", f"s{n % 3}", len(t or "")) for n, (i, t) in enumerate(rows)]
        frame = spark.createDataFrame(full, DOCS).repartition(3)
        if not extra:
            return frame
        clashing = (
            "row out doc kept lost fp ids n_ids crcs grp round sequence_id offset component "
            "component_id keeper node label found spans score own host path anchor segment y features"
        )
        from pyspark.sql import functions as F

        return frame.select("*", *[F.lit("x").alias(c) for c in clashing.split()])

    return build


@pytest.fixture
def table(spark, tmp_path):
    """`table(name, frame)` writes a table of a folder of its own and returns the folder."""

    def write(**frames):
        for name, frame in frames.items():
            frame.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
