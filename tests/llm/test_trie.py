"""Conversation trie: against a plain version, over many shards and rounds, edge rows, hot copies."""

from __future__ import annotations

import random

import plain
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import trie
from ledgerloom.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def forest(seed: int, count: int) -> list[tuple]:
    """Rows of conversations that share first turns: copies, prefixes of others, a few long ones."""
    rng = random.Random(seed)
    kinds = [("user", "hi"), ("user", "hello there"), ("assistant", "yes it is"), ("user", ""), ("assistant", "a b c d")]
    paths: list[list] = [[]]
    rows = []
    for conv in range(count):
        path = [*rng.choice(paths)[: rng.randint(1, 12)]]
        path += [rng.choice(kinds) for _ in range(rng.randint(not path, 3))]
        if rng.random() < 0.03:
            path += [rng.choice(kinds) for _ in range(80)]
        paths.append(path)
        rows += [(conv * 3, t, *turn) for t, turn in enumerate(path)]
    rng.shuffle(rows)
    return rows


def paths_of(rows) -> dict:
    found: dict = {}
    for conv, _, role, text in sorted(rows):
        found.setdefault(conv, []).append((role, text))
    return {c: tuple(t) for c, t in found.items()}


def nodes(frame, **sizes):
    got = trie.prefix_trie(trie.as_paths(trie.named_turns(frame)), **sizes)
    return sorted(map(tuple, got.collect()), key=str)


@pytest.mark.parametrize(
    "count, sizes",
    [
        (150, {}),
        (150, {"shard_turns": 60, "group": 4}),
        (120, {"shard_turns": 12, "group": 2}),
        (40, {"shard_turns": 3, "group": 3}),
    ],
)
def test_nodes_equal_a_plain_version(spark, count, sizes):
    rows = forest(count + len(sizes), count)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert nodes(frame, **sizes) == plain.trie_nodes(paths_of(rows))


def test_nodes_over_narrow_panels(spark, monkeypatch):
    monkeypatch.setattr(trie, "PANEL", 3)
    rows = forest(9, 60)
    batches = {}
    # the folding itself, without Spark, with panels narrower than the conversations
    frame = trie.distinct_paths(trie.as_paths(trie.named_turns(spark.createDataFrame(rows, SCHEMA))))
    table = frame.withColumn("shard", F.lit(0).cast("long")).select(
        "shard", "path", "words", "conv_id", "copies", "ends"
    ).toArrow()
    (group,) = [b for b in trie._fold_shard(table.to_batches()) if b["open"].null_count < b.num_rows]
    for batch in trie._fold_shard(table.to_batches()):
        for depth, n in zip(batch["depth"].to_pylist(), batch["n_convs"].to_pylist(), strict=True):
            if depth is not None:
                batches.setdefault(depth, []).append(n)
    wanted: dict = {}
    for _, depth, _, n, *_ in plain.trie_nodes(paths_of(rows)):
        wanted.setdefault(depth, []).append(n)
    first, last = (set(range(len(p["path"]) + 1)) for p in group["open"].to_pylist())
    for depth in wanted:
        missing = len(wanted[depth]) - len(batches.get(depth, []))
        assert missing <= (depth in first) + (depth in last)
        assert not set(batches.get(depth, [])) - set(wanted[depth])


EDGES = [
    (20, None, None, None),
    (20, 0, "user", "x y"),
    (20, 0, "user", "x y"),
    (40, 1, "user", ""),
    (41, 0, "", None),
    (42, 0, None, ""),
    (43, 0, "user", "a\x1cb   c"),
    (63, 0, "user", "no base"),
    (None, 0, "user", "no id"),
]


def test_edge_rows_and_other_columns(spark, table):
    frame = spark.createDataFrame(EDGES, SCHEMA).select(
        "*", *[F.lit("x").alias(c) for c in ("turns", "name", "words", "path", "found", "one", "key", "base", "head", "depth", "open")]
    )
    got = QUERIES["op13_conversation_trie"](spark, table(conversations=frame))
    wanted = plain.trie_nodes(plain.rebuilt_conversations(EDGES))
    assert sorted(map(tuple, got.collect()), key=str) == wanted
    assert nodes(frame.limit(0)) == []


def test_query_with_prefixes_copies_and_turnless_conversations(spark, table):
    rng = random.Random(3)
    rows = []
    for conv in [*range(0, 400), *range(1001, 1019)]:  # no base for the last ones
        rows += [(conv, t, rng.choice(["user", "assistant"]), rng.choice(["a", "b c", "d e f"])) for t in range(rng.randint(1, 5))]
    got = QUERIES["op13_conversation_trie"](spark, table(conversations=spark.createDataFrame(rows, SCHEMA))).collect()
    rebuilt = plain.rebuilt_conversations(rows)
    assert () in rebuilt.values()
    assert sorted(map(tuple, got), key=str) == plain.trie_nodes(rebuilt)


def test_a_third_of_all_conversations_equal(spark):
    hot = [(c, t, "user", "the same") for c in range(0, 70_000, 2) for t in range(2)]
    rest = [(c, 0, "user", f"text {c % 5000}") for c in range(1, 70_000, 2)]
    rows = spark.createDataFrame(hot + rest, SCHEMA)
    got = {(r[0], r[1]): r for r in nodes(rows, shard_turns=2000, group=4)}
    paths = paths_of(hot + rest)
    assert sorted(got.values(), key=str) == plain.trie_nodes(paths)
    assert got[(0, 2)][3] == 35_000


def test_only_names_of_turns_are_exchanged(spark):
    frame = spark.createDataFrame(EDGES, SCHEMA)
    plan = trie.named_turns(frame)._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange hashpartitioning(conv_id")[1]
    assert "partial_collect_list(one" in below and plan.count("Exchange hash") == 1
    one = dict(trie.named_turns(frame).dtypes)["turns"]
    assert one == "array<struct<name:binary,words:int>>"
