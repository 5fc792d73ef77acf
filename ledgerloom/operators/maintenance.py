"""Table maintenance (M1-M12) as pure functions `(target, source) -> new rows or new target`.

Scale notes, valid for every operator here:

* Nothing is collected; each operator is one shuffle join on the business key.
* No side is hinted to broadcast: both sides grow with the data, so Spark decides by its own
  size check, before and during the run.
* Rows whose key is NULL never match in SQL.  Updates and upserts spread them over the tasks of the
  join by a hash of the row, so that they do not meet in one; both sides are read once.
* Keys that must be unique are checked inside the same sort the join needs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import compare

Comparable = Callable[[Column, T.DataType], Column]


def _all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame | None]:
    """Rows with a full key, and the rest (None when the schema rules it out)."""
    nullable = [k for k in keys if df.schema[k].nullable]
    if not nullable:
        return df, None
    full = _all_of([F.col(k).isNotNull() for k in nullable])
    return df.where(full), df.where(~full)


def _with_rest(df: DataFrame, *rest: DataFrame | None) -> DataFrame:
    for part in rest:
        if part is not None:
            df = df.unionByName(part)
    return df


def _missing_key(df: DataFrame, keys: Sequence[str]) -> Column | None:
    """Whether a part of the key is NULL; None when the schema rules it out."""
    nullable = [F.col(k).isNull() for k in keys if df.schema[k].nullable]
    return reduce(lambda a, b: a | b, nullable) if nullable else None


def _spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`df` with a further join column: 0 for rows with a full key, a hash of the row for others."""
    missing = _missing_key(df, keys)
    place = F.lit(0).cast("long")
    if missing is not None:
        place = F.when(missing, F.xxhash64(*df.columns)).otherwise(place)
    return df.withColumn("_spread", place)


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Fail the job when a full key occurs twice (Q27), else return the rows unchanged.

    The exchange and sort are the ones a following join on the same keys needs anyway.  A column
    `_spread` counts as part of the key.
    """
    by = [*keys, "_spread"] if "_spread" in df.columns else [*keys]
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(*by))
    message = F.concat(
        F.lit(f"duplicate key in source {tuple(keys)}: "),
        F.concat_ws(", ", *[F.col(k).cast("string") for k in keys]),
    )
    missing = _missing_key(df, keys)
    twice = F.col("_nth") > 1 if missing is None else (F.col("_nth") > 1) & ~missing
    checked = F.when(twice, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return df.withColumn("_nth", nth).where(checked).drop("_nth")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order.

    Spark applies the rank limit before the shuffle too, so each map task sends at most one row
    per key and a hot key costs no more than a rare one.
    """
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", nth).where(F.col("_nth") == 1).drop("_nth")


# --- inserts -----------------------------------------------------------------------------


def new_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `source` whose key `target` lacks; NULL equals NULL, batch duplicates all stay.

    One exchange per side: a key the target repeats does no harm to an anti join, which keeps one
    row of it, and a side that comes straight from its exchange can be split where a key is hot.
    """
    known = target.select(*[F.col(k).alias(f"_known_{k}") for k in keys])
    same = _all_of([F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in keys])
    return source.join(known, same, "left_anti")


def insert_new(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M1: target plus the new rows of the source."""
    return target.unionByName(new_rows(target, source, keys))


def new_rows_first(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """New rows, one per key: the first in the given order."""
    return new_rows(target, first_per_key(source, keys, order), keys)


def insert_new_first(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """M2: as M1, only the first source row per key."""
    return target.unionByName(new_rows_first(target, source, keys, order))


def insert_or_ignore(
    target: DataFrame, source: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None
) -> DataFrame:
    """M3: insert, on key conflict do nothing; a NULL key never conflicts.

    `order` says which of several equal keys in the batch comes first; without it, all columns
    in turn do, so that a re-run picks the same row.
    """
    keyed, unkeyed = _split_null_keys(source, keys)
    first = first_per_key(keyed, keys, order or [F.col(c) for c in source.columns])
    known = target.select(*keys).distinct()
    fresh = first.join(known, list(keys), "left_anti").select(*target.columns)
    return _with_rest(target.unionByName(fresh), unkeyed)


# --- updates -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Update:
    """How a target follows its source: M4, or M5 with the tolerant `comparable`.

    Where a watched column differs between rows of one key, the `assign` columns (by default the
    watched ones) are taken from the source.  `comparable` normalises both sides before the test.
    Target rows without a match stay as they are, source rows without a match are ignored.  Source
    keys must be unique.
    """

    keys: tuple[str, ...]
    watch: tuple[str, ...]
    assign: tuple[str, ...] = ()
    comparable: Comparable = compare.exact

    @property
    def assigned(self) -> tuple[str, ...]:
        return self.assign or self.watch

    def state(self, target: DataFrame, source: DataFrame) -> DataFrame:
        """The new target, in one join that reads both sides once."""
        joined = _spread(target, self.keys).join(
            self._incoming(source), [*self.keys, "_spread"], "left"
        )
        changed = F.coalesce(F.col("_hit"), F.lit(False)) & self._differs(target)
        return _assign(joined, target, changed, self.assigned)

    def changes(
        self, target: DataFrame, source: DataFrame, carry: Sequence[str] = ()
    ) -> DataFrame:
        """Keys and new values of the rows that change, and the target's `carry` columns.

        The join reads only keys and watched columns of the target.  Together with `apply`, on a
        stored result, this rewrites a wide target without shuffling it when little changed.
        """
        columns = dict.fromkeys([*self.keys, *self.watch, *carry])
        narrow = _split_null_keys(target.select(*columns), self.keys)[0]
        joined = _spread(narrow, self.keys).join(self._incoming(source), [*self.keys, "_spread"])
        kinds = _kinds(target)
        found = joined.where(self._differs(target)).select(
            *self.keys,
            *[F.col(f"_new_{c}").cast(kinds[c]).alias(c) for c in self.assigned],
            *carry,
        )
        return found.distinct()  # a key the target repeats changes once

    def apply(self, target: DataFrame, changes: DataFrame) -> DataFrame:
        """The new target, from what `changes` found."""
        found = changes.select(
            *self.keys, *[F.col(c).alias(f"_new_{c}") for c in self.assigned], F.lit(True).alias("_hit")
        )
        joined = _spread(target, self.keys).join(
            _spread(found, self.keys), [*self.keys, "_spread"], "left"
        )
        return _assign(joined, target, F.col("_hit"), self.assigned)

    def _incoming(self, source: DataFrame) -> DataFrame:
        columns = dict.fromkeys([*self.watch, *self.assigned])
        rows = source.select(
            *self.keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit")
        )
        return require_unique(_spread(_split_null_keys(rows, self.keys)[0], self.keys), self.keys)

    def _differs(self, target: DataFrame) -> Column:
        kinds = _kinds(target)

        def both(column: str) -> tuple[Column, Column]:
            kind = kinds[column]
            new = F.col(f"_new_{column}").cast(kind)
            return self.comparable(F.col(column), kind), self.comparable(new, kind)

        return compare.differs([both(c) for c in self.watch])


def _kinds(df: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in df.schema}


def _assign(joined: DataFrame, target: DataFrame, when: Column, assigned: Sequence[str]) -> DataFrame:
    kinds = _kinds(target)
    return joined.select(
        *[
            F.when(when, F.col(f"_new_{c}").cast(kinds[c])).otherwise(F.col(c)).alias(c)
            if c in assigned
            else F.col(c)
            for c in target.columns
        ]
    )


def diff_update(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    watch: Sequence[str],
    assign: Sequence[str] = (),
    comparable: Comparable = compare.exact,
) -> DataFrame:
    """M4: the new target, see `Update`."""
    return Update(tuple(keys), tuple(watch), tuple(assign), comparable).state(target, source)


def diff_update_tolerant(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    watch: Sequence[str],
    assign: Sequence[str] = (),
) -> DataFrame:
    """M5: as M4, blind to sub-cent, letter-case, outer-blank and sub-second differences."""
    return diff_update(target, source, keys, watch, assign, compare.tolerant)


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    touch: str | None = None,
    run_ts: Column | None = None,
    on_insert: Column | None = None,
) -> DataFrame:
    """M6: insert or overwrite by key; rows only the target has stay (Q26).

    `touch` names a time column the source lacks: it becomes `run_ts` on update, `on_insert`
    (NULL by default) on insert.
    """
    untouched = F.lit(None) if on_insert is None else on_insert
    kinds = _kinds(target)
    if touch:
        source = source.withColumn(touch, untouched.cast(kinds[touch]))
    values = [c for c in target.columns if c not in keys]

    new = require_unique(_spread(source.select(*target.columns), keys), keys)
    incoming = new.select(
        *keys, "_spread", *[F.col(c).cast(kinds[c]).alias(f"_new_{c}") for c in values], F.lit(True).alias("_new")
    )
    old = _spread(target, keys).withColumn("_old", F.lit(True))
    joined = old.join(incoming, [*keys, "_spread"], "full_outer")

    is_new = F.coalesce(F.col("_new"), F.lit(False))
    is_update = is_new & F.coalesce(F.col("_old"), F.lit(False))

    def value(name: str) -> Column:
        chosen = F.when(is_new, F.col(f"_new_{name}")).otherwise(F.col(name))
        if name == touch:
            chosen = F.when(is_update, run_ts.cast(kinds[name])).otherwise(chosen)
        return chosen.alias(name)

    return joined.select(*[F.col(c) if c in keys else value(c) for c in target.columns])


# --- replacements ------------------------------------------------------------------------


def replace_all(target: DataFrame, source: DataFrame) -> DataFrame:
    """The new content is the source, in the target's column order; the sink swaps it in."""
    return source.select(*target.columns)


def replace_keep_old(target: DataFrame, source: DataFrame, guard: str | None = None) -> DataFrame:
    """M8: replace, but keep the old table when the source has no row.

    With `guard`, rows where that column is NULL do not count (a global aggregate over nothing).
    Whether the source has content is a scalar subquery of the same plan, so no driver round trip
    decides.
    """
    counted = F.count(F.lit(1) if guard is None else F.col(guard))
    filled = source.agg(counted > 0).scalar()
    return target.where(~filled).unionByName(source.select(*target.columns).where(filled))


def replace_range(
    target: DataFrame, source: DataFrame, column: str, start: Column, end: Column
) -> DataFrame:
    """M9: rows with `start <= column < end` come from the source, all others from the target.

    The same range cuts both sides (Q8), so a second run gives the same table; rows with a NULL
    date stay.
    """
    at = F.col(column)
    outside = at.isNull() | (at < start) | (at >= end)  # in this form it reaches the scan
    return target.where(outside).unionByName(source.where((at >= start) & (at < end)))


# --- history -----------------------------------------------------------------------------


def latest_per_key(
    history: DataFrame, keys: Sequence[str], at: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Latest row per key; a NULL time counts as the latest, as in the source database."""
    return first_per_key(history, keys, history_order(at, ties))


def changes_since(
    current: DataFrame,
    last: DataFrame,
    key: str,
    watch: Sequence[str],
    run_ts: Column,
    at: str = "fecha_registro",
    null_is_absent: bool = False,
) -> DataFrame:
    """The rows to append, i.e. current rows never seen or changed since their last record.

    `last` has the last record of each key, with the columns of the history; `null_is_absent` treats one
    whose watched columns are all NULL as no record.
    """
    seen = last.select(key, *[F.col(c).alias(f"_last_{c}") for c in watch], F.lit(True).alias("_seen"))
    changed = compare.differs([(F.col(f"_last_{c}"), F.col(c)) for c in watch])
    fresh = F.col("_seen").isNull() | changed
    if null_is_absent:
        fresh = fresh | _all_of([F.col(f"_last_{c}").isNull() for c in watch])
    stamped = current.withColumn(at, run_ts.cast(last.schema[at].dataType))
    return stamped.join(seen, key, "left").where(fresh).select(*last.columns)


def history_order(at: str, watch: Sequence[str]) -> list[Column]:
    """Which of several records of a key is the last; a NULL time counts as the latest."""
    return [F.col(at).desc_nulls_first(), *[F.col(c).desc_nulls_last() for c in watch]]


def changes_for_history(
    current: DataFrame,
    history: DataFrame,
    key: str,
    watch: Sequence[str],
    run_ts: Column,
    at: str = "fecha_registro",
    null_is_absent: bool = False,
) -> DataFrame:
    """M10 against the whole history, whose last records are found by rank.

    `tables.append_history` keeps them in a table of their own and does not read the history.
    """
    last = latest_per_key(history, [key], at, watch)
    return changes_since(current, last, key, watch, run_ts, at, null_is_absent)


def append_change_history(
    current: DataFrame,
    history: DataFrame,
    key: str,
    watch: Sequence[str],
    run_ts: Column,
    at: str = "fecha_registro",
) -> DataFrame:
    """History plus the changes of this run."""
    return history.unionByName(changes_for_history(current, history, key, watch, run_ts, at))


def append_snapshot(target: DataFrame, batch: DataFrame) -> DataFrame:
    """All rows of the batch, no key check."""
    return target.unionByName(batch)
