"""H1 and the leader dimension."""

from __future__ import annotations

import random

import pytest

from ledgerloom.operators import hierarchy
from ledgerloom.operators.hierarchy import nearest_ancestor
from ledgerloom.plans import dimensions
from ledgerloom.session import shared_folder

EDGE = "node long, parent long"


def walk(parents: dict, good: set) -> dict:
    """Brute force: climb one step at a time, stop at a known node seen twice."""
    answer = {}
    for node, parent in parents.items():
        seen, here = set(), parent
        while here in parents and here not in seen and not (here in good and here != node):
            seen.add(here)
            here = parents[here]
        answer[node] = here if here in parents and here in good and here != node else None
    return answer


def test_named_cases(frame):
    nodes = frame(
        EDGE,
        (1, None),  # root
        (2, 1),  # parent qualified
        (3, 2),  # only grandparent qualified
        (4, 3),  # self qualified, must be skipped
        (5, 4),
        (10, None),
        (11, 10),  # none qualified
        (20, 21),
        (21, 20),  # cycle of two
        (22, 20),  # below the cycle
        (30, 999),  # orphan parent id
    )
    good = frame("node long", (1,), (4,), (4,), (999,))
    with pytest.warns(UserWarning, match="3 nodes are in or below a cycle"):
        found = nearest_ancestor(nodes, good)
    hits = {r.node: r.hit for r in found.collect()}
    assert hits == {
        1: None, 2: 1, 3: 1, 4: 1, 5: 4, 10: None, 11: None, 20: None, 21: None, 22: None, 30: None,
    }


def test_cycle_with_a_qualified_member(frame):
    nodes = frame(EDGE, (1, 2), (2, 3), (3, 1), (4, 1))
    hits = {r.node: r.hit for r in nearest_ancestor(nodes, frame("node long", (3,))).collect()}
    assert hits == {1: 3, 2: 3, 3: None, 4: 3}


def test_chain_deeper_than_a_recursion_limit(spark):
    nodes = spark.range(1, 3001).selectExpr(
        "id AS node", "CASE WHEN id > 1 THEN id - 1 END AS parent"
    )
    good = spark.range(1, 2).withColumnRenamed("id", "node")
    hits = nearest_ancestor(nodes, good)
    assert hits.where("hit = 1").count() == 2999
    assert hits.where("hit IS NULL").count() == 1


def test_random_forests_with_hot_parents(spark):
    rng = random.Random(7)
    for size in (1, 40, 400):
        parents = {}
        for node in range(size):
            pick = rng.random()
            if pick < 0.1 or node == 0:
                parents[node] = None
            elif pick < 0.45:
                parents[node] = 0  # a third of all nodes hang on one parent
            else:
                parents[node] = rng.randrange(size)  # cycles may occur
        good = {n for n in parents if rng.random() < 0.15}
        nodes = spark.createDataFrame(list(parents.items()), EDGE)
        marked = spark.createDataFrame([(n,) for n in good] or [(-1,)], "node long")
        hits = {r.node: r.hit for r in nearest_ancestor(nodes, marked).collect()}
        assert hits == walk(parents, good)


def test_empty_tree(frame):
    nodes = frame(EDGE, (1, None)).where("false")
    assert nearest_ancestor(nodes, frame("node long", (1,))).count() == 0


def test_qualified_partners(frame, values):
    ranks = frame("socio long, rango int, version int",
                  (1, 18, 1), (2, 18, 2), (3, 5, 1), (4, 19, 1), (5, 18, 1), (6, 18, 1), (1, 19, 1))
    known = frame("rango int, version int", (18, 1), (18, 2), (5, 1))
    info = frame("socio long, lista_negra boolean",
                 (1, False), (2, False), (3, False), (4, False), (5, True), (6, None))
    good = dimensions.qualified_partners(ranks, known, info, [(18, 1), (19, 1)])
    assert set(values(good)) == {(1,)}


def test_leaders(frame, values):
    socios = frame(
        "socio long, padre long, nombre string, estatus int",
        (1, None, "boss", 3), (2, 1, "a", 1), (3, 2, "b", 2), (4, 3, "c", 9), (5, None, "d", 1),
    )
    ranks = frame("socio long, rango int, version int", (1, 18, 1))
    known = frame("rango int, version int", (18, 1))
    info = frame("socio long, lista_negra boolean", (1, False))
    source = dimensions.leaders_source(socios, ranks, known, info, [(18, 1)], {"Sur": [1]})
    assert values(source) == [
        (2, 1, "boss", "Sur"), (3, 1, "boss", "Sur"), (5, None, None, "Sin Region"),
    ]


def test_shared_folder_needs_a_setting_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())


def test_a_round_writes_only_open_nodes(spark, monkeypatch):
    written = []
    real = hierarchy.materialise

    def counting(df, label, **counts):
        stored, seen = real(df, label, **counts)
        written.append(stored.count())
        return stored, seen

    monkeypatch.setattr(hierarchy, "materialise", counting)
    # a chain of 64 under a wide top: most nodes are answered in the first round
    rows = [(0, None)] + [(n, 0) for n in range(1, 500)] + [(n, n - 1) for n in range(500, 564)]
    nodes = spark.createDataFrame(rows, "node long, parent long")
    marked = spark.createDataFrame([(0,)], "node long")
    hits = {r.node: r.hit for r in hierarchy.nearest_ancestor(nodes, marked).collect()}
    assert hits == {n: None if n == 0 else 0 for n, _ in rows}
    assert written[0] == len(rows) and written == sorted(written, reverse=True)
    assert max(written[2:]) <= 64  # the chain alone
