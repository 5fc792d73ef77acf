"""Helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import materialise


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


class Remembered:
    """Values of words in a worker: `compute` gives those of a list of words not known.

    Two generations: what a batch uses is in the young one, taken over from the old one or computed; a
    young one that is full becomes the old one.  Words longer than `longest` are not kept.
    """

    def __init__(self, compute: Callable[[list[str]], list], generation: int = 300_000, longest: int = 64):
        self.compute, self.generation, self.longest = compute, generation, longest
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}

    def values(self, words: list[str]) -> list:
        """One value per word; the words are distinct, values are not None."""
        young, old = self.young, self.old
        missing = []
        for word in [w for w, v in zip(words, map(young.get, words), strict=True) if v is None]:
            if (value := old.get(word)) is None:
                missing.append(word)
            else:
                young[word] = value
        young.update(zip(missing, self.compute(missing), strict=True))
        found = list(map(young.__getitem__, words))
        for word in missing:
            if len(word) > self.longest:
                del young[word]
        if len(young) > self.generation:
            self.young, self.old = {}, young
        return found


def groups_for(rows: int, per_group: int) -> int:
    """How many groups keep `rows` rows at about `per_group` each; at least one."""
    return max(1, -(-rows // per_group))


def local_components(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node reachable from each of `count` nodes over the edges (a, b)."""
    label = np.arange(count)
    if not len(a):
        return label
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
        if np.array_equal(before, label):
            return label


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of `edges` (a, b: long): one row (node, component) per node that has an
    edge, the component named by its smallest node.

    Large-star and small-star rounds: each replaces the edges by ones that point to smaller nodes
    until every component is a star.  Nothing is collected; a hub is met by an aggregate (one row
    per map task) and an equi-join that AQE can split.  Every round is cut by a written table.
    """
    state, seen = None, None
    current = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    checks = {"n": F.count(F.lit(1)), "h": F.bit_xor(F.xxhash64("a", "b"))}
    current, state = materialise(current, label, **checks)
    while state["n"] and state != seen:
        seen = state
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = (
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        )
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        joined = large.join(low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).union(
            low.select("a", F.col("low").alias("b"))
        )
        current, state = materialise(small.where("a <> b").distinct(), label, **checks)
    stars = current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, unless they can import it already.

    Python functions on executors import their module; a job started from another folder, or on
    machines without the package, gets it as a file that Spark distributes.
    """
    import shutil
    import tempfile
    from pathlib import Path

    context = spark.sparkContext
    if _shipped.get("to") == context.applicationId:
        return

    def importable(batches):
        import importlib.util

        import pyarrow as pa

        for batch in batches:
            found = importlib.util.find_spec("ledgerloom") is not None
            yield pa.RecordBatch.from_arrays([pa.array([found] * batch.num_rows)], ["found"])

    if not spark.range(1).mapInArrow(importable, "found boolean").first()["found"]:
        root = Path(__file__).resolve().parents[2]
        target = Path(tempfile.mkdtemp(prefix="package-")) / "ledgerloom"
        context.addPyFile(shutil.make_archive(str(target), "zip", root, "ledgerloom"))
    _shipped["to"] = context.applicationId


_shipped: dict[str, str] = {}
