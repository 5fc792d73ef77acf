"""Physical plans: what reaches the scan, how often data is shuffled, what is never there."""

from __future__ import annotations

import re

import pytest
from conftest import SF_CHECK
from pyspark.sql import functions as F

import ledgerloom
from ledgerloom.checks.queries import registered
from ledgerloom.operators import maintenance as m

QUERIES = registered()


def plan(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def scans(text: str) -> dict[str, str]:
    """Details of each Parquet scan by file name."""
    found = {}
    for block in re.split(r"\n\n+", text):
        name = re.search(r"Location: .*?/(\w+)\.parquet", block)
        if name:
            found.setdefault(name.group(1), []).append(block)
    return {k: "\n".join(v) for k, v in found.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_and_no_cartesian(spark, name):
    text = plan(QUERIES[name](spark, SF_CHECK))
    for word in ("PythonUDF", "ArrowEval", "BatchEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoop"):
        assert word not in text, word


def exchanges(text: str) -> int:
    tree = text.split("\n\n")[0]
    return len(re.findall(r"\+- Exchange|:- Exchange|^Exchange", tree, re.M))


def test_balance_is_one_shuffle_and_pushes_the_year(spark):
    text = plan(QUERIES["daily_balance"](spark, SF_CHECK))
    assert exchanges(text) == 1
    orders = scans(text)["orders"]
    assert "GreaterThanOrEqual(o_orderdate,1997-01-01" in orders
    assert "LessThan(o_orderdate,1998-01-01" in orders
    assert "o_comment" not in orders and "o_custkey" in orders


def test_paid_share_is_one_shuffle(spark):
    assert exchanges(plan(QUERIES["client_paid_pct"](spark, SF_CHECK))) == 1


def test_type_filter_reaches_the_scan_columns(spark):
    text = plan(QUERIES["aum_open_products"](spark, SF_CHECK))
    lines = scans(text)["lineitem"]
    schema = re.search(r"ReadSchema: struct<(.*)>", lines).group(1)
    names = {part.split(":")[0] for part in schema.split(",")}
    assert names == {
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate",
    }


def test_first_per_key_limits_before_the_shuffle(frame):
    df = frame("k long, o long", (1, 1))
    text = plan(m.first_per_key(df, ["k"], [F.col("o")]))
    assert re.search(r"WindowGroupLimit.*\n.*\n.*Exchange[\s\S]*WindowGroupLimit", text) or (
        text.count("WindowGroupLimit") >= 2
    )


def test_update_join_reuses_the_sort_of_the_key_check(spark, frame):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = frame("k long, w string", (1, "a"))
        source = frame("k long, w string", (1, "b"))
        tree = plan(m.diff_update(target, source, ["k"], ["w"])).split("\n\n")[0]
        # one exchange per join side, besides the two that `frame` adds; rows without a key need no other scan
        assert tree.count("SortMergeJoin") == 1
        assert len(re.findall(r"Sort \(", tree)) == 2
        assert tree.count("Scan ExistingRDD") == 2
        # the same for an upsert, and one exchange a side for an insert of new rows
        tree = plan(m.upsert(target, source, ["k"])).split("\n\n")[0]
        assert (tree.count("SortMergeJoin"), tree.count("Scan ExistingRDD")) == (1, 2)
        assert len(re.findall(r"Sort \(", tree)) == 2
        tree = plan(m.new_rows(target, source, ["k"])).split("\n\n")[0]
        assert (tree.count("SortMergeJoin"), tree.count("Scan ExistingRDD")) == (1, 2)
        assert len(re.findall(r"Exchange \(", tree)) == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_only_bounded_sides_are_hinted():
    """Every broadcast hint in the package is on a side that one aggregate bounds."""
    from pathlib import Path

    package = Path(ledgerloom.__file__).parent
    hints = [
        f"{path.name}: {line.strip()}"
        for path in package.rglob("*.py")
        for line in path.read_text().splitlines()
        if "F.broadcast(" in line
    ]
    assert sorted(hints) == [
        'purchases.py: .join(F.broadcast(plan), "tipo_item", "left")',
    ]


def test_updates_read_narrow_and_rewrite_without_a_shuffle(spark, tmp_path):
    wide = spark.range(1000).selectExpr("id AS k", "id % 7 AS w", "id AS a", "id AS b", "'x' AS c")
    wide.write.parquet(str(tmp_path / "wide.parquet"))
    target = spark.read.parquet(str(tmp_path / "wide.parquet"))
    source = spark.range(1000).selectExpr("id AS k", "if(id < 5, 9, id % 7) AS w")
    update = m.Update(("k",), ("w",))
    found = update.changes(target, source)
    schema = re.search(r"ReadSchema: struct<(.*)>", scans(plan(found))["wide"]).group(1)
    assert schema == "k:bigint,w:bigint"
    found.write.parquet(str(tmp_path / "changes.parquet"))
    changes = spark.read.parquet(str(tmp_path / "changes.parquet"))
    assert changes.count() == 5
    tree = plan(update.apply(target, changes)).split("\n\n")[0]
    assert "BroadcastHashJoin LeftOuter" in tree
    assert not re.search(r"[-:] Exchange", tree)
    assert update.apply(target, changes).where("w = 9").count() == 5
