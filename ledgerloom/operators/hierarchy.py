"""H1: nearest qualified ancestor in a parent-pointer tree.

Every node keeps either its answer or a pointer to the next ancestor to ask.  In a round each
open node takes over what that ancestor already knows, so the distance covered doubles: a
chain of a million nodes needs about twenty rounds, each of them one shuffle join on a
three-column table.

Rounds are cut by a table in the shared folder, so a lost executor does not replay earlier
rounds.  A round writes only the nodes that were open before it; answered ones stay in the table of
the round that answered them.  Reading the tables back leaves both join inputs as plain exchanges,
which lets AQE split the children of a hot parent over several tasks, and lets Spark broadcast them
when their measured size is small.
"""

from __future__ import annotations

import math
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialise


def nearest_ancestor(
    nodes: DataFrame, qualified: DataFrame, node: str = "node", parent: str = "parent"
) -> DataFrame:
    """`(node, hit)` for every node: its nearest qualified proper ancestor, NULL when none.

    `nodes` has one row per node; `qualified` may repeat nodes.  A parent that is no node ends
    the walk.  Rows in or below a cycle without a qualified member get NULL.
    """
    edges = nodes.select(F.col(node).alias("node"), F.col(parent).alias("parent"))
    good = qualified.select(F.col(node).alias("node")).distinct().withColumn("good", F.lit(True))

    # `best`: the nearest qualified node from here upward, this node included;
    # `ask`: the ancestor to ask next, NULL once the search is over
    first = edges.join(good, "node", "left").select(
        "node",
        F.when(F.col("good"), F.col("node")).alias("best"),
        F.when(F.col("good").isNull(), F.col("parent")).alias("ask"),
    )
    asking = F.col("ask").isNotNull()
    written, seen = materialise(first, "ancestor", total=F.count("*"), open=F.count("ask"))
    rounds = math.ceil(math.log2(seen["total"] + 1)) + 1
    answered, state = written.where(~asking), written
    while seen["open"] and rounds:
        asked = state.select(
            F.col("node").alias("ask"), F.col("best").alias("their_best"), F.col("ask").alias("their_ask")
        )
        moved = (
            written.where(asking)
            .join(asked, "ask", "left")
            .select("node", F.col("their_best").alias("best"), F.col("their_ask").alias("ask"))
        )
        written, seen = materialise(moved, "ancestor", open=F.count("ask"))
        state = answered.unionByName(written)
        answered = answered.unionByName(written.where(~asking))
        rounds -= 1
    if seen["open"]:
        warnings.warn(f"{seen['open']} nodes are in or below a cycle without a qualified member", stacklevel=2)

    # what a node's parent knows is the nearest proper ancestor of the node
    above = state.select(F.col("node").alias("parent"), "best")
    rooted = edges.where(F.col("parent").isNull()).withColumn(
        "best", F.lit(None).cast(state.schema["best"].dataType)
    )
    linked = edges.where(F.col("parent").isNotNull()).join(above, "parent", "left")
    # a node can meet itself only inside a cycle
    return rooted.unionByName(linked).select(
        "node", F.when(F.col("best") != F.col("node"), F.col("best")).alias("hit")
    )
