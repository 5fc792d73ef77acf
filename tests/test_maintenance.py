"""M1-M12 on the edge rows of FIXTURES.md, and the properties of SURVEY 5."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import compare
from ledgerloom.operators import maintenance as m

RUN_AT = dt.datetime(2030, 1, 1)


def run():
    return F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")


# --- M1-M3 ------------------------------------------------------------------------------------


def test_insert_new_keeps_batch_duplicates_and_matches_null(frame, values):
    target = frame("k long, v string", (1, "old"), (None, "old"))
    source = frame("k long, v string", (1, "x"), (2, "a"), (2, "b"), (None, "x"), (3, "c"))
    assert values(m.new_rows(target, source, ["k"])) == [(2, "a"), (2, "b"), (3, "c")]
    assert m.insert_new(target, source, ["k"]).count() == 5


def test_insert_new_null_key_only_in_source(frame, values):
    target = frame("k long, v string", (1, "old"))
    source = frame("k long, v string", (None, "x"), (None, "y"), (1, "z"))
    assert values(m.new_rows(target, source, ["k"])) == [(None, "x"), (None, "y")]


def test_insert_new_composite_key_with_null_date(frame, values):
    schema = "k string, d date, v long"
    day = dt.date(2024, 1, 1)
    target = frame(schema, ("a", None, 1), ("a", day, 2))
    source = frame(schema, ("a", None, 9), ("a", day, 9), ("b", None, 9), (None, None, 9))
    assert values(m.new_rows(target, source, ["k", "d"])) == [(None, None, 9), ("b", None, 9)]


def test_insert_new_empty_sides(frame):
    schema = "k long, v string"
    some, none = frame(schema, (1, "a")), frame(schema, (1, "a")).where("false")
    assert m.new_rows(some, none, ["k"]).count() == 0
    assert m.new_rows(none, some, ["k"]).count() == 1


def test_insert_new_twice_inserts_nothing_more(frame, values):
    schema = "k long, v string"
    target, source = frame(schema, (1, "a")), frame(schema, (1, "b"), (2, "c"), (None, "d"))
    once = m.insert_new(target, source, ["k"])
    assert values(m.insert_new(once, source, ["k"])) == values(once)


def test_insert_new_first_takes_the_first_in_order(frame, values):
    schema = "k long, o long, v string"
    target = frame(schema, (1, 0, "old"))
    source = frame(schema, (1, 5, "x"), (2, 7, "late"), (2, 3, "early"), (None, 2, "n2"), (None, 1, "n1"))
    fresh = m.new_rows_first(target, source, ["k"], [F.col("o")])
    assert values(fresh, "k", "v") == [(None, "n1"), (2, "early")]


def test_insert_or_ignore_null_never_conflicts(frame, values):
    schema = "k long, d date, v long"
    day = dt.date(2024, 1, 1)
    target = frame(schema, (1, day, 0), (None, day, 0))
    source = frame(schema, (1, day, 9), (2, day, 8), (2, day, 7), (None, day, 6), (None, day, 5))
    result = m.insert_or_ignore(target, source, ["k", "d"], [F.col("v")])
    assert values(result, "k", "v") == [(None, 0), (None, 5), (None, 6), (1, 0), (2, 7)]


# --- M4, M5 -----------------------------------------------------------------------------------


def test_diff_update_watch_and_assign(frame, values):
    schema = "k long, w string, s string, other string"
    target = frame(
        schema,
        (1, "same", "s", "t"),
        (2, "old", "s", "t"),
        (3, "same", "s", "t"),
        (4, None, "s", "t"),
        (5, "old", "s", "t"),
        (6, None, "s", "t"),
        (7, "only target", "s", "t"),
        (None, "null key", "s", "t"),
    )
    source = frame(
        "k long, w string, s string",
        (1, "same", "s"),
        (2, "new", "S"),
        (3, "same", "S"),  # set-only change: must not trigger
        (4, "new", "S"),
        (5, None, "S"),
        (6, None, "S"),
        (8, "only source", "S"),
        (None, "null key changed", "S"),
    )
    result = m.diff_update(target, source, ["k"], ["w"], ["w", "s"])
    assert result.columns == target.columns
    assert values(result) == [
        (None, "null key", "s", "t"),
        (1, "same", "s", "t"),
        (2, "new", "S", "t"),
        (3, "same", "s", "t"),
        (4, "new", "S", "t"),
        (5, None, "S", "t"),
        (6, None, "s", "t"),
        (7, "only target", "s", "t"),
    ]
    again = m.diff_update(result, source, ["k"], ["w"], ["w", "s"])
    assert values(again) == values(result)
    update = m.Update(("k",), ("w",), ("w", "s"))
    changes = update.changes(target, source)
    assert values(changes) == [(2, "new", "S"), (4, "new", "S"), (5, None, "S")]
    assert values(update.apply(target, changes)) == values(result)


def test_diff_update_refuses_duplicate_source_keys(frame):
    target = frame("k long, w string", (1, "a"))
    source = frame("k long, w string", (1, "b"), (1, "c"))
    with pytest.raises(Exception, match="duplicate key in source"):
        m.diff_update(target, source, ["k"], ["w"]).collect()


def test_update_of_a_key_the_target_repeats(frame, values):
    target = frame("k long, w string", (1, "a"), (1, "b"), (2, "c"))
    source = frame("k long, w string", (1, "new"), (2, "c"))
    update = m.Update(("k",), ("w",))
    changes = update.changes(target, source)
    assert values(changes) == [(1, "new")]
    assert values(update.apply(target, changes)) == [(1, "new"), (1, "new"), (2, "c")]
    assert values(update.state(target, source)) == [(1, "new"), (1, "new"), (2, "c")]


def test_null_boolean_counts_as_false(frame, values):
    target = frame("k long, f boolean, g boolean", (1, None, True), (2, None, None))
    source = frame("k long, f boolean, g boolean", (1, False, True), (2, True, None))
    result = m.diff_update(target, source, ["k"], ["f", "g"], comparable=compare.null_as_false)
    assert values(result) == [(1, None, True), (2, True, None)]


def test_tolerant_update(frame, values):
    schema = "k long, n decimal(20,3), s string, t timestamp_ntz"
    at, later = dt.datetime(2024, 1, 1, 5, 0, 0), dt.datetime(2024, 1, 1, 5, 0, 0, 900)
    target = frame(
        schema,
        (1, Decimal("1.004"), " Abc ", at),
        (2, Decimal("1.010"), "abc", at),
        (3, Decimal("1"), None, at),
        (4, Decimal("1"), "x", None),
        (5, None, "x", at),
        (6, Decimal("1"), "x", None),
        (7, Decimal("1"), "\tx\n", at),
    )
    source = frame(
        schema,
        (1, Decimal("1.000"), "abc", later),
        (2, Decimal("1.000"), "abc", at),
        (3, Decimal("1"), "", at),
        (4, Decimal("1"), "x", at),
        (5, Decimal("0"), "x", at),
        (6, Decimal("1"), "x", None),
        (7, Decimal("1"), "x", at),
    )
    update = m.Update(("k",), ("n", "s", "t"), comparable=compare.tolerant)
    assert values(update.changes(target, source), "k") == [(2,), (4,), (5,)]
    result = m.diff_update_tolerant(target, source, ["k"], ["n", "s", "t"])
    assert result.count() == 7 and update.changes(result, source).count() == 0


# --- M6 ---------------------------------------------------------------------------------------


def test_upsert_inserts_updates_and_keeps(frame, values):
    old = dt.datetime(2020, 1, 1)
    target = frame(
        "k long, v string, at timestamp_ntz", (1, "keep", old), (2, "old", old), (None, "n", old)
    )
    source = frame("k long, v string", (2, None), (3, "new"), (None, "m"))
    result = m.upsert(target, source, ["k"], "at", run())
    assert values(result) == [
        (None, "m", None),
        (None, "n", old),
        (1, "keep", old),
        (2, None, RUN_AT),
        (3, "new", None),
    ]
    stamped = m.upsert(target, source, ["k"], "at", run(), on_insert=run())
    assert (3, "new", RUN_AT) in values(stamped)


def test_upsert_without_touch_and_duplicate_source(frame, values):
    target = frame("k long, v string", (1, "a"))
    assert values(m.upsert(target, frame("k long, v string", (1, "b")), ["k"])) == [(1, "b")]
    twice = frame("k long, v string", (1, "b"), (1, "c"))
    with pytest.raises(Exception, match="duplicate key in source"):
        m.upsert(target, twice, ["k"]).collect()


# --- M7-M9, M11 -----------------------------------------------------------------------------


def test_replace_all_and_guarded_replace(frame, values):
    target = frame("v string, k long", ("old", 1))
    source = frame("k long, v string", (2, "new"))
    empty = source.where("false")
    assert values(m.replace_all(target, source)) == [("new", 2)]
    assert values(m.replace_all(target, empty)) == []
    assert values(m.replace_keep_old(target, source)) == [("new", 2)]
    assert values(m.replace_keep_old(target, empty)) == [("old", 1)]


def test_guarded_replace_ignores_an_empty_aggregate(frame, values):
    target = frame("latest long, total long", (1, 10))
    nothing = frame("x long", (1,)).where("false")
    row = nothing.agg(F.max("x").alias("latest"), F.sum("x").alias("total"))
    assert values(m.replace_keep_old(target, row, "latest")) == [(1, 10)]
    assert values(m.replace_keep_old(target, row)) == [(None, None)]


def test_replace_range_bounds_nulls_and_rerun(frame, values):
    schema = "d date, v string"

    def day(month, number):
        return dt.date(2025, month, number)

    target = frame(
        schema,
        (dt.date(2024, 12, 31), "before"),
        (day(1, 1), "first"),
        (day(12, 31), "last"),
        (dt.date(2026, 1, 1), "after"),
        (None, "none"),
    )
    source = frame(schema, (day(5, 5), "new"), (dt.date(2026, 5, 5), "outside"))
    bounds = F.lit(dt.date(2025, 1, 1)), F.lit(dt.date(2026, 1, 1))
    once = m.replace_range(target, source, "d", *bounds)
    assert values(once, "v") == [("after",), ("before",), ("new",), ("none",)]
    assert values(m.replace_range(once, source, "d", *bounds)) == values(once)


def test_append_snapshot(frame):
    rows = frame("k long", (1,), (2,))
    assert m.append_snapshot(rows, rows).count() == 4


# --- M10 --------------------------------------------------------------------------------------


def test_change_history(frame, values):
    first, second = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
    history = frame(
        "k long, w string, fecha_registro timestamp_ntz",
        (1, "a", first),
        (2, "a", first),
        (3, "a", first),
        (3, "b", second),
        (4, None, first),
        (5, "a", second),
        (5, "b", None),
    )
    current = frame(
        "k long, w string", (1, "a"), (2, "b"), (3, "a"), (4, "x"), (5, "b"), (6, "new")
    )
    added = m.changes_for_history(current, history, "k", ["w"], run())
    # 3 changed back, 4 had no value, 5's record without time is its latest
    assert values(added, "k", "w") == [(2, "b"), (3, "a"), (4, "x"), (6, "new")]
    assert {r[2] for r in values(added)} == {RUN_AT}
    later = F.lit("2031-01-01 00:00:00").cast("timestamp_ntz")
    whole = m.append_change_history(current, history, "k", ["w"], run())
    assert m.changes_for_history(current, whole, "k", ["w"], later).where("k <> 5").count() == 0


def test_change_history_null_counts_as_absent(frame, values):
    history = frame("k long, w string, fecha_registro timestamp_ntz", (1, None, RUN_AT))
    current = frame("k long, w string", (1, None))
    assert m.changes_for_history(current, history, "k", ["w"], run()).count() == 0
    absent = m.changes_for_history(current, history, "k", ["w"], run(), null_is_absent=True)
    assert values(absent, "k") == [(1,)]
