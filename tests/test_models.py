"""Maintenance operators against plain-Python models on random tables with NULLs and repeats."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import maintenance as m

SCHEMA = "k long, j string, w long, s string"


def table(rng, size, unique):
    rows, seen = [], set()
    for _ in range(size):
        key = (rng.choice([None, *range(12)]), rng.choice([None, "a", "b", "c"]))
        if unique and None not in key:
            if key in seen:
                continue
            seen.add(key)
        rows.append((*key, rng.choice([None, 1, 2]), rng.choice([None, "x", "y"])))
    return rows


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def model_new(target, source):
    known = {r[:2] for r in target}
    return [r for r in source if r[:2] not in known]


def model_update(target, source):
    by_key = {r[:2]: r for r in source if None not in r[:2]}
    result = []
    for row in target:
        new = by_key.get(row[:2])
        result.append((*row[:2], *new[2:]) if new and new[2] != row[2] else row)
    return result


def model_upsert(target, source):
    replaced = {r[:2] for r in source if None not in r[:2]}
    return [r for r in target if r[:2] not in replaced] + source


def model_ignore(target, source):
    taken = {r[:2] for r in target if None not in r[:2]}
    result = list(target)
    for row in sorted(source, key=lambda r: [(v is not None, v) for v in r]):
        if None in row[:2] or row[:2] not in taken:
            result.append(row)
            taken.add(row[:2])
    return result


def model_first(rows):
    first = {}
    for row in sorted(rows, key=lambda r: [(v is not None, v) for v in r[2:]]):
        first.setdefault(row[:2], row)
    return list(first.values())


@pytest.mark.parametrize("seed", range(4))
def test_operators_match_their_models(spark, seed):
    rng = random.Random(seed)
    target, source = table(rng, 40, True), table(rng, 40, True)
    repeats = table(rng, 60, False)
    old = spark.createDataFrame(target, SCHEMA).repartition(3)
    new = spark.createDataFrame(source, SCHEMA).repartition(4)
    many = spark.createDataFrame(repeats, SCHEMA).repartition(5)
    keys = ["k", "j"]
    update = m.Update(tuple(keys), ("w",), ("w", "s"))

    assert bag(m.new_rows(old, many, keys)) == sorted(model_new(target, repeats), key=repr)
    assert bag(update.state(old, new)) == sorted(model_update(target, source), key=repr)
    assert bag(update.apply(old, update.changes(old, new))) == bag(update.state(old, new))
    assert bag(m.upsert(old, new, keys)) == sorted(model_upsert(target, source), key=repr)
    assert bag(m.insert_or_ignore(old, many, keys)) == sorted(model_ignore(target, repeats), key=repr)
    order = [F.col("w"), F.col("s")]
    assert bag(m.first_per_key(many, keys, order)) == sorted(model_first(repeats), key=repr)
