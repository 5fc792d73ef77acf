"""Periodic runs: trees, runs against a plain search, edge rows, the registered query."""

from __future__ import annotations

import random
import time

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import periodic
from ledgerloom.llm.queries import QUERIES


def test_tree_gives_ranks_and_common_prefixes():
    rng = random.Random(2)
    for _ in range(400):
        n = rng.randint(1, 14)
        symbols = [rng.randrange(rng.choice([1, 2, 3])) for _ in range(n)]
        tree = periodic.SuffixTree(symbols)
        by_suffix = sorted(range(n + 1), key=lambda i: [s + 1 for s in symbols[i:]] + [0])
        assert [tree.rank[i] for i in by_suffix] == list(range(n + 1))
        pairs = [(a, b) for a in range(n + 1) for b in range(n + 1) if a != b]
        got = tree.common(*np.array(pairs).T)
        for (a, b), k in zip(pairs, got.tolist(), strict=True):
            assert symbols[a : a + k] == symbols[b : b + k] and a + k <= n and b + k <= n
            assert max(a, b) + k == n or symbols[a + k] != symbols[b + k]


@pytest.mark.parametrize("limits", [(24, 3), (6, 3), (2, 2), (10, 4)])
def test_runs_equal_a_plain_search(limits):
    rng = random.Random(limits[0])
    met = 0
    for _ in range(300):
        n, kinds = rng.randint(0, 90), rng.choice([1, 2, 2, 3, 5])
        words = [rng.randrange(kinds) for _ in range(n)]
        if n > 30:
            for _ in range(rng.randint(0, 2)):  # copies one period back
                a, q = rng.randrange(n - 24), rng.randint(1, 10)
                for i in range(a + q, min(n, a + rng.randint(20, 60))):
                    words[i] = words[i - q]
        wanted = plain.periodic_runs(words, *limits)
        assert periodic.find_runs(words, *limits) == wanted
        met += len(wanted)
    assert met > 100


def test_strings_that_the_filter_looks_for():
    assert periodic.gram_size(24, 3) == 9
    assert [periodic.gram_size(*x) for x in ((2, 2), (6, 3), (10, 4), (100, 3))] == [1, 3, 7, 35]


EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t"),
    (4, "one"),
    (5, "a " * 24),
    (6, "a " * 23),
    (7, "x " + "a b c " * 8 + "a b"),
    (8, "\x0bé\u00a0é " * 30),  # a no-break space and other Unicode blanks belong to words
    (9, "\x1c \x85 " * 20),
    (10, "a b " * 15 + "a c " * 15),
    (None, "q r s " * 20),
    (None, None),
    (5, "a " * 24),
    (5, "b c " * 40),
]


def test_edge_rows(spark, docs):
    frame = docs(EDGES)
    got = frame.select("doc_id", "text", periodic.periodic_runs(F.col("text")).alias("r")).collect()
    assert len(got) == len(EDGES)
    for doc, text, found in got:
        words = plain.WORD.findall(text or "")
        assert found.words == len(words)
        assert [tuple(r) for r in found.runs] == plain.periodic_runs(words)
    assert frame.limit(0).select(periodic.periodic_runs(F.col("text"))).count() == 0


def test_query_on_edges_and_planted_runs(spark, docs, table):
    rng = random.Random(5)
    rows = [(n, " ".join(rng.choices("abcdefgh", k=rng.choice([0, 1, 2, 5, 60, 400])))) for n in range(20, 320)]
    rows += EDGES
    got = QUERIES["op12_periodic_runs"](spark, table(documents=docs(rows))).collect()
    wanted = [plain.periodic_row(*r) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(wanted, key=str)
    assert sum(r.n_runs > 0 for r in got) > 10


def test_query_on_the_small_table(spark, small):
    texts = small("SELECT doc_id, text FROM documents WHERE length(text) < 6000")
    wanted = {r[0]: r for r in (plain.periodic_row(*t) for t in texts)}
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, small.folder).collect()}
    assert len(got) == 200 and len(wanted) > 150
    assert {k: v for k, v in got.items() if k in wanted} == wanted


def test_strongest_compares_exactly(spark):
    big = 10**9
    runs = [(5, 3 * big + 1, big), (4, 3 * big + 2, big), (2, 3 * big + 2, big), (9, 9, 3)]
    frame = spark.createDataFrame([(runs,), ([],)], "runs array<struct<start: bigint, length: bigint, period: bigint>>")
    got = [r[0] for r in frame.select(periodic.strongest(F.col("runs"))).collect()]
    assert [None if g is None else tuple(g) for g in got] == [runs[2], None]


def test_long_periodic_text_is_near_linear():
    rng = random.Random(4)
    root = [rng.randrange(5000) for _ in range(20_000)]
    began = time.perf_counter()
    assert periodic.find_runs((root * 5)[:90_000]) == [(0, 90_000, 20_000)]
    assert time.perf_counter() - began < 20
