"""Reading operational and warehouse tables, and writing warehouse tables.

Parquet tables have no row-level `UPDATE`, so a new state is written to a directory of its own
and the catalog entry is then pointed at it: readers see the old or the new table, never a
half-written or an empty one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.maintenance import Update, first_per_key, history_order, new_rows
from ledgerloom.session import materialise


def read_folder(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """The Parquet table `name` of a folder; a given schema saves the look into its files."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    split_by: str,
    bounds: tuple[int, int],
    partitions: int,
    properties: dict[str, str],
) -> DataFrame:
    """A database table read by many tasks, each with its own range of `split_by`."""
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=split_by, lowerBound=low, upperBound=high,
        numPartitions=partitions, properties=properties,
    )


def create_missing(spark: SparkSession, schemas: Mapping[str, str], partitioned: Mapping[str, str]) -> None:
    """Empty tables for the ones that do not exist yet."""
    for table, columns in schemas.items():
        clause = f"PARTITIONED BY ({partitioned[table]})" if table in partitioned else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {clause}")


def current(spark: SparkSession, table: str) -> DataFrame:
    """The table as it is now, also when another session wrote to it."""
    spark.catalog.refreshTable(table)
    return spark.table(table)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Columns in the order and types of the table."""
    wanted = df.sparkSession.table(table).schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in wanted])


def publish(df: DataFrame, table: str, base: str, version: str) -> None:
    """Write a complete new state, then point the table at it."""
    location = _write_version(df, table, base, version)
    _point(df.sparkSession, table, location)


def publish_if_filled(
    df: DataFrame, table: str, base: str, version: str, guard: str | None = None
) -> bool:
    """M8: as `publish`, but leave the old table when nothing (or only NULL) came out.

    The rows are written first and the written files looked at, so the query runs once.
    """
    spark = df.sparkSession
    location = _write_version(df, table, base, version)
    written = spark.read.schema(df.schema).parquet(location)
    if guard is not None:
        written = written.where(F.col(guard).isNotNull())
    if written.isEmpty():
        return False
    _point(spark, table, location)
    return True


def update(table: str, rule: Update, source: DataFrame, base: str, version: str) -> int:
    """M4, M5: bring the changes of `source` into the table; returns how many rows changed.

    The changes are found on narrow columns and stored.  None leaves the table alone; a few are
    small enough for Spark to broadcast by their measured size, and the wide target is rewritten
    without a shuffle.  Of a partitioned table only the partitions that hold a change are read and
    rewritten; the partition must follow from the key, so that no row moves to another one.
    """
    spark = source.sparkSession
    target = current(spark, table)
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if set(parts) & set(rule.assigned):
        raise ValueError(f"{table}: an update must not assign its partition {parts}")
    counts = {"rows": F.count(F.lit(1))}
    if parts:
        counts |= {"low": F.min(parts[0]), "high": F.max(parts[0])}
    found = rule.changes(target, source, carry=parts)
    changes, seen = materialise(found, f"changes-{table}", **counts)
    if not seen["rows"]:
        return 0
    if not parts:
        publish(rule.apply(target, changes), table, base, version)
        return seen["rows"]
    places = changes.select(*parts).distinct()
    touched = _in_partitions(target, places, parts[0], seen["low"], seen["high"])
    state = rule.apply(touched, changes.drop(*parts))
    # a dynamic overwrite stages its files, so the table may be read while it is written
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        state.write.insertInto(table, overwrite=True)
    return seen["rows"]


def _in_partitions(target: DataFrame, places: DataFrame, part: str, low, high) -> DataFrame:
    """The rows of `target` in the partitions named in `places`, which lie from `low` to `high`.

    The range prunes partitions before the run, the semi join prunes those inside it while it runs.
    """
    inside = target.where(F.col(part).between(F.lit(low), F.lit(high)))
    return inside.join(places, part, "left_semi").select(*target.columns)


def insert_new(table: str, rows: DataFrame, keys: Sequence[str]) -> int:
    """M1 into a partitioned table: append the rows whose key it lacks; returns how many those are.

    The partition follows from the keys.  Which partitions the batch falls into is seen on that column
    alone; of the table only these are read, and of them only the keys.
    """
    spark = rows.sparkSession
    target = current(spark, table)
    (part,) = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    counts = {"low": F.min(part), "high": F.max(part), "missing": F.count_if(F.col(part).isNull())}
    places, seen = materialise(rows.select(part).distinct(), f"places-{table}", **counts)
    known = target.where(F.lit(False))
    if seen["low"] is not None:
        known = _in_partitions(target, places, part, seen["low"], seen["high"])
    if seen["missing"]:
        known = known.unionByName(target.where(F.col(part).isNull()))
    counter = Observation()
    new = conform(new_rows(known, rows, keys), table)
    new.observe(counter, F.count(F.lit(1)).alias("n")).write.insertInto(table)
    return counter.get["n"]


def append_history(
    spark: SparkSession,
    log: str,
    state: str,
    changes_of: Callable[[DataFrame], DataFrame],
    key: str,
    watch: Sequence[str],
    run: str,
    block_size: int,
    at: str = "fecha_registro",
) -> int:
    """M10 with a table beside the log that keeps the last record of each key; returns the rows appended.

    `changes_of` finds the rows to append from that table; the log is not read.  The log is partitioned by
    the run that wrote, the state by blocks of the key, of which only those with a change are rewritten.
    Both move together: the state is marked with the run before the log is written and unmarked when it
    has the rows too, so a run that broke off in between is made good by the next one (`recover_history`),
    and writes nothing twice.
    """
    recover_history(spark, log, state, key, watch, block_size, at)
    columns = [c.name for c in spark.catalog.listColumns(state) if not c.isPartition]
    found = changes_of(current(spark, state).select(*columns))
    changes, seen = materialise(found, f"changes-{log}", rows=F.count(F.lit(1)))
    if not seen["rows"]:
        return 0
    attempt = f"{run}-{uuid.uuid4().hex[:8]}"
    _mark(spark, state, attempt)
    (part,) = [c.name for c in spark.catalog.listColumns(log) if c.isPartition]
    append(changes.withColumn(part, F.lit(attempt)), log)
    _merge_history(changes, state, key, watch, block_size, at)
    _mark(spark, state, "")
    return seen["rows"]


def recover_history(
    spark: SparkSession, log: str, state: str, key: str, watch: Sequence[str], block_size: int, at: str
) -> None:
    """Bring the state up to its log: after a run that broke off, or where the log is older than the state."""
    (part,) = [c.name for c in spark.catalog.listColumns(log) if c.isPartition]
    broken = _marked(spark, state)
    if broken:
        rows = current(spark, log).where(F.col(part) == broken)
        _merge_history(rows, state, key, watch, block_size, at)
        _mark(spark, state, "")
    elif current(spark, state).isEmpty():
        _merge_history(current(spark, log), state, key, watch, block_size, at)


def _merge_history(
    rows: DataFrame, state: str, key: str, watch: Sequence[str], block_size: int, at: str
) -> None:
    (part,) = [c.name for c in rows.sparkSession.catalog.listColumns(state) if c.isPartition]
    block = F.coalesce(F.floor(F.col(key) / block_size), F.lit(-1))
    merge_latest(state, rows.withColumn(part, block), [part, key], history_order(at, watch))


_MARK = "ledgerloom.run_under_way"


def _mark(spark: SparkSession, table: str, run: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{_MARK}' = '{run}')")


def _marked(spark: SparkSession, table: str) -> str:
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == _MARK).collect()
    return found[0]["value"] if found else ""


def merge_latest(table: str, rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> int:
    """Keep, in a table partitioned by a column that follows from the keys, the first row per key in
    `order`, of the rows it has and of `rows`; returns how many rows came.

    Only the partitions that `rows` falls into are read and rewritten.  Rows that come again, after a
    replay or with every reading of a folder, change nothing.
    """
    spark = rows.sparkSession
    target = current(spark, table)
    (part,) = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    counts = {"rows": F.count(F.lit(1)), "low": F.min(part), "high": F.max(part)}
    batch, seen = materialise(conform(rows, table), f"rows-{table}", **counts)
    if not seen["rows"]:
        return 0
    places = batch.select(part).distinct()
    touched = _in_partitions(target, places, part, seen["low"], seen["high"])
    state = first_per_key(touched.unionByName(batch), keys, order)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        conform(state, table).write.insertInto(table, overwrite=True)
    return seen["rows"]


def append(df: DataFrame, table: str) -> None:
    """Add rows to an existing table."""
    conform(df, table).write.insertInto(table)


def overwrite_from(df: DataFrame, table: str, year_column: str, first: int) -> None:
    """M9 on a table partitioned by year: the years from `first` on are replaced, others kept.

    Dynamic overwrite replaces the years that have rows; a year the table has and the batch lacks
    is dropped, so that it does not keep its old rows.  Which years have rows is observed during the
    write, for the years the table lists.
    """
    spark = df.sparkSession
    years = sorted(y for y in _partitions(spark, table) if y >= first)
    seen = Observation()
    counts = [F.count_if(F.col(year_column) == y).alias(str(y)) for y in years]
    batch = conform(df.where(F.col(year_column) >= first), table)
    batch = batch.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        batch.write.insertInto(table, overwrite=True)
    for year in years:
        if not seen.get[str(year)]:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({year_column} = {year})")


def refresh_partials(
    spark: SparkSession, table: str, fact: str, since: int, partial_of: Callable[[DataFrame], DataFrame]
) -> list[int]:
    """Bring a table of partial sums up to its fact; returns the partitions that were summed again.

    Both are partitioned by the same whole number.  Partitions of the fact from `since` on may have
    changed; they and those the table lacks are read again, all others keep their sums.  `partial_of` sums
    the rows of a partition, so that its sums add up over partitions.
    """
    (part,) = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    there, known = _partitions(spark, fact), _partitions(spark, table)
    again = sorted(p for p in there if p >= since or p not in known)
    if again:
        target = current(spark, fact)
        names = [c.name for c in spark.catalog.listColumns(table) if not c.isPartition]
        sums = [partial_of(target.where(F.col(part) == p)).withColumn(part, F.lit(p)) for p in again]
        every = sums[0]
        for more in sums[1:]:
            every = every.unionByName(more)
        with setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            conform(every.select(*names, part), table).write.insertInto(table, overwrite=True)
    for gone in known - there:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({part} = {gone})")
    return again


def _partitions(spark: SparkSession, table: str) -> set[int]:
    listed = [r[0].partition("=")[2] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return {int(p) for p in listed if p.lstrip("-").isdigit()}


def drop_old_versions(spark: SparkSession, table: str, base: str, keep: int = 2) -> list[str]:
    """Delete superseded versions of a table, but for the `keep` written last; returns what went.

    The version the catalog points at always stays, however old it is: a table that no run has
    rewritten lately still lives in an old folder.  Call it when no reader holds an older state.
    """
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(
        (F.trim("col_name") == "Location") | F.lower(F.trim("col_name")).startswith("location")
    )
    live = {r["data_type"].rstrip("/").rpartition("/")[2] for r in described.collect()}
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/{table}")
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = sorted(
        ((s.getModificationTime(), s.getPath()) for s in files.listStatus(root)),
        key=lambda s: (s[0], s[1].getName()),
    )
    old = [path for _, path in found if path.getName() not in live]
    gone = old[: max(0, len(old) - keep)]
    for path in gone:
        files.delete(path, True)
    return [path.getName() for path in gone]


def _write_version(df: DataFrame, table: str, base: str, version: str) -> str:
    """Write a state beside the others.  A location of its own: a retry never meets old files."""
    location = f"{base}/{table}/{version}-{uuid.uuid4().hex[:8]}"
    df.write.parquet(location)
    return location


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for one write; `insertInto` takes this one from the session only."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _point(spark: SparkSession, table: str, location: str) -> None:
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{location}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=location, source="parquet")
