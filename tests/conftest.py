from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from ledgerloom.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "ledgerloom-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """`frame(schema, row, row, ...)` as a DataFrame of several partitions."""

    def build(schema: str, *rows):
        return spark.createDataFrame(list(rows), schema).repartition(3)

    return build


@pytest.fixture
def values():
    """Rows of a DataFrame as a sorted list of tuples, NULL first."""

    def read(df, *columns):
        rows = (df.select(*columns) if columns else df).collect()
        return sorted((tuple(r) for r in rows), key=lambda r: [(v is not None, str(v)) for v in r])

    return read
