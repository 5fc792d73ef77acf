"""Table publishing, landing folders, streaming intake, report sinks and the run log."""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
from decimal import Decimal

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from ledgerloom import exports
from ledgerloom.checks.standins import Tables
from ledgerloom.operators import audit
from ledgerloom.operators import maintenance as m
from ledgerloom.operators.maintenance import Update
from ledgerloom.plans import aggregates, records
from ledgerloom.sources import landing, reports, tables
from ledgerloom.streaming.intake import add_new, add_purchases, intake
from ledgerloom.streaming.purchases import purchase_intake


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def land(folder, name, *rows):
    folder.mkdir(exist_ok=True)
    page = json.dumps({"response": {"results": list(rows)}})
    (folder / name).write_text(page + "\n")


def test_publish_reads_and_replaces_itself(spark, frame, values, table, tmp_path):
    tables.publish(frame("k long, v string", (1, "a")), table, str(tmp_path), "v1")
    current = spark.table(table)
    tables.publish(current.withColumn("k", F.col("k") + 1), table, str(tmp_path), "v2")
    assert values(spark.table(table)) == [(2, "a")]
    tables.append(frame("v string, k long", ("b", 5)), table)
    assert values(spark.table(table)) == [(2, "a"), (5, "b")]


def test_failed_publish_leaves_the_old_table(spark, frame, values, table, tmp_path):
    tables.publish(frame("k long", (1,)), table, str(tmp_path), "v1")
    broken = spark.table(table).select(F.raise_error(F.lit("boom")).cast("long").alias("k"))
    with pytest.raises(Exception, match="boom"):
        tables.publish(broken, table, str(tmp_path), "v2")
    assert values(spark.table(table)) == [(1,)]


def test_publish_if_filled(spark, frame, values, table, tmp_path):
    rows = frame("k long, total long", (1, 5))
    assert tables.publish_if_filled(rows, table, str(tmp_path), "v1")
    assert not tables.publish_if_filled(rows.where("false"), table, str(tmp_path), "v2")
    nulls = rows.where("false").agg(F.max("k").alias("k"), F.sum("total").alias("total"))
    assert not tables.publish_if_filled(nulls, table, str(tmp_path), "v3", guard="k")
    assert values(spark.table(table)) == [(1, 5)]
    assert tables.publish_if_filled(frame("k long, total long", (2, 6)), table, str(tmp_path), "v4")
    assert values(spark.table(table)) == [(2, 6)]


def test_overwrite_years_clears_a_year_without_rows(spark, frame, values, table):
    spark.sql(f"CREATE TABLE {table} (v STRING, y INT) USING parquet PARTITIONED BY (y)")
    tables.append(frame("v string, y int", ("a", 2023), ("b", 2024), ("c", 2025), ("d", 2026)), table)
    batch = frame("v string, y int", ("new", 2024), ("later", 2026), ("next", 2027), ("early", 2022))
    for _ in range(2):
        tables.overwrite_from(batch, table, "y", 2024)
        assert values(spark.table(table)) == [
            ("a", 2023), ("later", 2026), ("new", 2024), ("next", 2027),
        ]


def test_update_rewrites_only_the_partitions_that_change(spark, frame, values, table, tmp_path):
    spark.sql(f"CREATE TABLE {table} (k BIGINT, w STRING, s STRING, part INT) USING parquet PARTITIONED BY (part)")
    rows = [(k, "a", "s", k // 10) for k in range(40)] + [(None, "a", "s", None)]
    tables.append(frame("k long, w string, s string, part int", *rows), table)
    source = frame("k long, w string", *[(k, "b" if k == 15 else "a") for k in range(50)])
    before = set(spark.table(table).inputFiles())
    assert tables.update(table, Update(("k",), ("w",)), source, str(tmp_path), "v1") == 1
    now = tables.current(spark, table)
    after = set(now.inputFiles())
    assert {f.split("part=")[1].split("/")[0] for f in before - after} == {"1"}
    assert values(now.where("w = 'b'")) == [(15, "b", "s", 1)]
    assert now.count() == 41 and now.where("part = 1").count() == 10
    assert tables.update(table, Update(("k",), ("w",)), source, str(tmp_path), "v2") == 0
    assert set(tables.current(spark, table).inputFiles()) == after
    with pytest.raises(ValueError, match="partition"):
        tables.update(table, Update(("k",), ("part",)), source, str(tmp_path), "v3")


def test_update_of_a_plain_table(spark, frame, values, table, tmp_path):
    tables.publish(frame("k long, w string, s string", (1, "a", "s"), (2, "a", "s")), table, str(tmp_path), "v1")
    source = frame("k long, w string", (1, "b"), (3, "b"))
    assert tables.update(table, Update(("k",), ("w",)), source, str(tmp_path), "v2") == 1
    assert values(spark.table(table)) == [(1, "b", "s"), (2, "a", "s")]
    files = spark.table(table).inputFiles()
    assert tables.update(table, Update(("k",), ("w",)), source, str(tmp_path), "v3") == 0
    assert spark.table(table).inputFiles() == files


def test_old_versions_go_and_the_live_one_stays(spark, frame, values, table, tmp_path):
    base = str(tmp_path)
    for n in range(4):
        tables.publish(frame("k long, w string", (1, str(n))), table, base, f"v{n}")
    # an update that changes nothing leaves the table in its last version
    same = frame("k long, w string", (1, "3"))
    assert tables.update(table, Update(("k",), ("w",)), same, base, "v9") == 0
    gone = tables.drop_old_versions(spark, table, base, keep=1)
    assert [name[:2] for name in gone] == ["v0", "v1"]
    assert sorted(p.name[:2] for p in (tmp_path / table).iterdir()) == ["v2", "v3"]
    assert len(tables.drop_old_versions(spark, table, base, keep=0)) == 1
    assert values(tables.current(spark, table)) == [(1, "3")]


def test_landing_reads_every_page(spark, tmp_path, values):
    folder = tmp_path / "pages"
    land(folder, "1.json", {"_id": "a", "value": 1, "Created Date": "2025-02-01T00:00:00.000Z"})
    land(folder, "2.json", {"_id": "b", "value": "2.5", "Created Date": "2024-02-01T00:00:00.000Z"},
         {"_id": "c", "type": "in"})
    pages = landing.read_pages(spark, str(folder))
    rows = records.transfers_source(pages)
    assert values(rows, "kft_id", "tipo") == [("a", None), ("b", None), ("c", "in")]
    (folder / "2.json").write_text(json.dumps(json.loads((folder / "2.json").read_text()), indent=2))
    whole = records.transfers_source(landing.read_pages(spark, str(folder), whole_files=True))
    assert values(whole, "kft_id") == [("a",), ("b",), ("c",)]
    land(folder, "2.json", {"_id": "b", "value": "2.5", "Created Date": "2024-02-01T00:00:00.000Z"})
    every = landing.records(pages, "_id string, value string, `Created Date` string")
    span = dt.datetime(2025, 1, 1), dt.datetime(2026, 1, 1)
    assert values(landing.created_between(every, *span), "_id") == [("a",)]
    assert values(landing.created_between(every, *span, filled="value"), "_id") == [("a",)]


def test_a_record_landed_twice_is_one_insert_and_one_update(spark, tmp_path, values):
    folder = tmp_path / "pages"
    land(folder, "1.json", {"_id": "r1", "id_compra": "CP1", "status": "open"})
    pages = landing.read_pages(spark, str(folder))
    empty = records.purchases_source(pages).limit(0)
    fact = records.json_purchases_new(pages, empty)
    assert values(fact, "id_compra", "status") == [(1, "open")]
    fact = spark.createDataFrame(fact.collect(), fact.schema)
    # again in the same file, and in a later one
    land(folder, "2.json", {"_id": "r1", "id_compra": "CP1", "status": "sent"},
         {"_id": "r1", "id_compra": "CP1", "status": "paid"}, {"_id": "r2", "id_compra": "CP2"})
    os.utime(folder / "1.json", (1, 1))
    pages = landing.read_pages(spark, str(folder))
    assert values(records.json_purchases_new(pages, fact), "id_compra") == [(2,)]
    assert values(records.json_purchases_new(pages, empty), "id_compra", "status") == [
        (1, "paid"), (2, None),
    ]
    changed = records.json_purchases_changed(pages, fact)
    assert values(changed, "id_compra", "status") == [(1, "paid")]
    # the number of an id is that of the record that landed last
    land(folder, "3.json", {"_id": "r1", "id_compra": "CP0"})
    numbers = records.record_numbers(landing.read_pages(spark, str(folder)))
    assert values(numbers) == [("r1", 0), ("r2", 2)]


def test_filters_act_on_the_last_version(spark, tmp_path, values):
    folder, span = tmp_path / "pages", (dt.datetime(2025, 1, 1), dt.datetime(2050, 1, 1))
    day = {"Created Date": "2025-02-01T00:00:00.000Z"}
    land(folder, "1.json", {"_id": "r1", "id_compra": "CP1", "status": "paid", "Fecha_pago": "2025-02-02", **day},
         {"_id": "r2", "id_compra": "CP2", "status": "paid", "Fecha_pago": "2025-02-02", **day})
    os.utime(folder / "1.json", (1, 1))
    land(folder, "2.json", {"_id": "r1", "id_compra": "CP1", "status": "refunded", "Fecha_pago": "", **day})
    pages = landing.read_pages(spark, str(folder))
    assert values(records.typed_purchases(pages), "id_compra", "status") == [(1, "refunded"), (2, "paid")]
    assert values(records.typed_purchases(pages, span), "id_compra", "status") == [(2, "paid")]
    empty = records.purchases_source(pages).limit(0)
    assert values(records.json_purchases_new(pages, empty, span=span), "id_compra") == [(2,)]
    # a payout that moved out of the span; one without an id is nobody's version
    folder = tmp_path / "payouts"
    land(folder, "1.json", {"id_pago": "PA1", "status": "open", **day}, {"id_pago": "PA2", **day}, {"id_pago": "", **day})
    os.utime(folder / "1.json", (1, 1))
    land(folder, "2.json", {"id_pago": "PA1", "status": "done", "Created Date": "2024-02-01T00:00:00.000Z"})
    pages = landing.read_pages(spark, str(folder))
    assert values(records.payouts_source(pages, span), "pago_tx") == [(2,)]
    assert values(records.payouts_update_source(pages, span), "pago_tx") == [(2,)]


def test_a_page_is_parsed_once(spark, tmp_path):
    folder = tmp_path / "pages"
    land(folder, "1.json", {"_id": "a", "id_compra": "CP1"})
    pages = landing.read_pages(spark, str(folder))

    def parses(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("from_json")

    for allow in (False, True):
        assert parses(landing.records(pages, landing.PURCHASE_RECORD, allow_unread=allow)) == 1
        assert parses(landing.wallet_records(pages, allow_unread=allow)) == 1
    assert parses(landing.unread_pages(pages)) == 1
    assert parses(records.transfers_source(pages)) == 1
    span = dt.datetime(2025, 1, 1), dt.datetime(2026, 1, 1)
    typed = records.typed_purchases(pages, span)
    assert parses(typed) == 1
    # the created time and the payment time, each cut into tokens once
    assert typed._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 2


def test_last_versions_are_kept_block_by_block(spark, frame, values, table):
    spark.sql(f"CREATE TABLE {table} (k STRING, v STRING, at INT, part BIGINT) USING parquet PARTITIONED BY (part)")

    def merge(*rows):
        batch = frame("k string, v string, at int, part long", *rows)
        return tables.merge_latest(table, batch, ["k"], [F.desc("at")])

    assert merge(("a", "old", 1, 0), ("b", "only", 1, 1), ("c", "x", 1, -1), ("a", "mid", 2, 0)) == 4
    before = set(tables.current(spark, table).inputFiles())
    assert merge(("a", "new", 3, 0), ("d", "late", 1, 0)) == 2
    assert merge(("a", "stale", 1, 0)) == 1
    after = set(tables.current(spark, table).inputFiles())
    assert {f.split("part=")[1].split("/")[0] for f in before - after} == {"0"}
    assert values(tables.current(spark, table), "k", "v") == [
        ("a", "new"), ("b", "only"), ("c", "x"), ("d", "late"),
    ]
    assert merge() == 0


def test_an_insert_reads_only_the_blocks_of_its_batch(spark, frame, values, table):
    spark.sql(f"CREATE TABLE {table} (k BIGINT, v STRING, part BIGINT) USING parquet PARTITIONED BY (part)")

    def rows(*keys):
        found = [(k, "v", None if k is None else k // 10) for k in keys]
        return frame("k long, v string, part long", *found)

    assert tables.insert_new(table, rows(*range(40), None), ["k"]) == 41
    # a block that cannot be read any more: an insert elsewhere does not notice
    for broken in {f for f in spark.table(table).inputFiles() if "part=2/" in f}:
        with open(broken.removeprefix("file:"), "wb") as f:
            f.write(b"no table")
    assert tables.insert_new(table, rows(5, 7, 100, 100, 35, 36), ["k"]) == 2
    assert tables.insert_new(table, rows(None), ["k"]) == 0
    assert tables.insert_new(table, rows(), ["k"]) == 0
    with pytest.raises(Exception, match="(?i)parquet"):
        tables.insert_new(table, rows(25), ["k"])
    now = tables.current(spark, table).where("part IS NULL OR part <> 2")
    assert now.count() == 33 and now.where("k = 100").count() == 2


def test_history_and_its_last_records_move_together(spark, frame, values, table, monkeypatch):
    log, state = f"{table}_log", f"{table}_state"
    spark.sql(f"CREATE TABLE {log} (k BIGINT, v STRING, at TIMESTAMP, run STRING) USING parquet PARTITIONED BY (run)")
    spark.sql(f"CREATE TABLE {state} (k BIGINT, v STRING, at TIMESTAMP, part BIGINT) USING parquet PARTITIONED BY (part)")
    moments = [dt.datetime(2030, 1, day) for day in range(1, 10)]
    read = []
    current = tables.current
    monkeypatch.setattr(tables, "current", lambda spark, name: read.append(name) or current(spark, name))

    def run(day, *rows):
        now, ts = frame("k long, v string", *rows), F.lit(moments[day - 1])
        read.clear()
        return tables.append_history(
            spark, log, state, lambda last: m.changes_since(now, last, "k", ["v"], ts, "at"),
            "k", ["v"], f"r{day}", 10, "at",
        )

    first = [(1, "a"), (2, "b"), (15, "c")]
    assert run(1, *first) == 3
    assert run(2, *first) == 0
    assert run(3, (1, "x"), *first[1:], (40, None)) == 2
    assert log not in read  # the history is written, not read
    before = {f for f in current(spark, state).inputFiles() if "part=1/" in f}
    # a run that breaks off between the log and the last records
    with monkeypatch.context() as broken:
        broken.setattr(tables, "merge_latest", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(4, (2, "y"))
    assert run(5, (2, "y")) == 0  # its rows are in the log once, and known now
    assert run(6, (2, "z")) == 1
    assert {f for f in current(spark, state).inputFiles() if "part=1/" in f} == before
    history = current(spark, log).drop("run")
    assert values(history, "k", "v") == [
        (1, "a"), (1, "x"), (15, "c"), (2, "b"), (2, "y"), (2, "z"), (40, None),
    ]
    last = m.latest_per_key(history, ["k"], "at", ["v"])
    assert values(last) == values(current(spark, state).drop("part"))
    # a log that is older than the table of last records
    spark.sql(f"TRUNCATE TABLE {state}")
    assert run(7, (2, "z"), (1, "x")) == 0
    assert values(last) == values(current(spark, state).drop("part"))
    for name in (log, state):
        spark.sql(f"DROP TABLE {name}")


def test_sums_of_unchanged_partitions_are_kept(spark, frame, values, table):
    fact, sums = f"{table}_fact", f"{table}_sums"
    spark.sql(f"CREATE TABLE {fact} (id_producto BIGINT, fecha_compra TIMESTAMP, precio DECIMAL(19,2), anio INT) USING parquet PARTITIONED BY (anio)")
    spark.sql(f"CREATE TABLE {sums} (id_producto BIGINT, fecha DATE, n BIGINT, valor DECIMAL(38,2), anio INT) USING parquet PARTITIONED BY (anio)")

    def sale(product, year, price):
        return (product, dt.datetime(year, 3, 1, 10), Decimal(price), year)

    def add(*rows):
        tables.append(frame("id_producto long, fecha_compra timestamp, precio decimal(19,2), anio int", *rows), fact)

    def refreshed(since):
        return tables.refresh_partials(spark, sums, fact, since, aggregates.sales_partials)

    catalogue = frame("id_producto long, nombre string", (1, "Plan select"), (2, "zzz"))

    def same(partials, whole):
        kept = aggregates.buckets_of_partials(partials, catalogue)
        assert values(kept) == values(aggregates.plan_buckets(whole, catalogue))

    add(sale(1, 2023, "1.50"), sale(2, 2023, "2"), sale(1, 2024, "3"), sale(1, 2025, "4"))
    assert refreshed(2025) == [2023, 2024, 2025]  # all of them at first
    same(spark.table(sums), spark.table(fact))
    add(sale(2, 2025, "5"), sale(2, 2025, "6"), sale(9, 2026, "7"))
    whole = spark.createDataFrame(spark.table(fact).collect(), spark.table(fact).schema)
    for old in {f for f in spark.table(fact).inputFiles() if "anio=2023/" in f or "anio=2024/" in f}:
        with open(old.removeprefix("file:"), "wb") as f:
            f.write(b"not read again")
    assert refreshed(2025) == [2025, 2026]
    same(tables.current(spark, sums), whole)
    # a year the fact no longer has
    spark.sql(f"ALTER TABLE {fact} DROP PARTITION (anio = 2024)")
    assert refreshed(2027) == []
    same(tables.current(spark, sums), whole.where("anio <> 2024"))
    for name in (fact, sums):
        spark.sql(f"DROP TABLE {name}")


def test_pages_that_are_not_understood(spark, tmp_path, values):
    folder = tmp_path / "pages"
    land(folder, "1.json", {"_id": "a", "id_compra": "CP1", "Fecha_pago": "soon"})
    (folder / "2.json").write_text('{"response": {"results": [{"_id": "b"\n\n  \n')
    (folder / "3.json").write_text('{"error": "try again"}\n')
    pages = landing.read_pages(spark, str(folder))
    for read in (records.transfers_source, records.purchase_records, records.payout_records):
        with pytest.raises(Exception, match="page not understood"):
            read(pages).collect()
        assert read(pages, allow_unread=True).count() == 1
    assert landing.unread_pages(pages).count() == 2
    assert values(records.unread_times(records.purchase_records(pages, True)), "_id") == [("a",)]


def test_streaming_purchases_are_idempotent_and_know_old_records(spark, tmp_path, values, table):
    folder, numbers, waiting = tmp_path / "pages", f"{table}_numbers", f"{table}_waiting"
    empty = records.purchases_source(spark.createDataFrame([], "payload string"))
    tables.publish(empty, table, str(tmp_path / "base"), "v1")
    spark.sql(f"CREATE TABLE {numbers} (_id STRING, numero BIGINT) USING parquet")
    spark.sql(f"CREATE TABLE {waiting} (id_compra BIGINT, referido STRING) USING parquet")

    def run(checkpoint):
        load = add_purchases(table, numbers, waiting, str(tmp_path / "base"))
        intake(spark, str(folder), str(tmp_path / checkpoint), load).awaitTermination()
        return values(tables.current(spark, table), "id_compra", "complemento_de")

    land(folder, "1.json", {"_id": "r1", "id_compra": "CP1"}, {"_id": "r2", "id_compra": "CP2"})
    assert run("c1") == [(1, None), (2, None)]
    land(folder, "2.json", {"_id": "r3", "id_compra": "CP3", "complemento_de": "r1"},
         {"_id": "r2", "id_compra": "CP2"})
    want = [(1, None), (2, None), (3, 1)]
    assert run("c1") == want
    assert run("c2") == want  # a lost checkpoint replays every page and inserts nothing
    assert values(tables.current(spark, numbers)) == [("r1", 1), ("r2", 2), ("r3", 3)]
    # a complement that lands after the record that names it
    land(folder, "3.json", {"_id": "r4", "id_compra": "CP4", "complemento_de": "r5"})
    assert run("c1") == [*want, (4, None)]
    land(folder, "4.json", {"_id": "r5", "id_compra": "CP5"})
    assert run("c1") == [*want, (4, 5), (5, None)]
    batch = records.purchases_source(landing.read_pages(spark, str(folder)))
    assert values(batch, "id_compra", "complemento_de") == run("c3")
    spark.sql(f"DROP TABLE {numbers}")
    spark.sql(f"DROP TABLE {waiting}")


@pytest.mark.parametrize("blocked", [False, True])
def test_streaming_purchases_with_keyed_state(spark, tmp_path, values, table, blocked):
    folder, base = tmp_path / "pages", str(tmp_path / "base")
    parts = ", part BIGINT) USING parquet PARTITIONED BY (part)" if blocked else ") USING parquet"
    empty = records.purchases_source(spark.createDataFrame([], "payload string"))
    fields = ", ".join(f"{n} {k}" for n, k in empty.dtypes)
    spark.sql(f"CREATE TABLE {table} ({fields}{parts}")
    queries = []

    def run(checkpoint):
        where = {"block": "part", "block_size": 3} if blocked else {}
        query = purchase_intake(spark, str(folder), str(tmp_path / checkpoint), table, base, **where)
        query.awaitTermination()
        queries.append(query)
        return values(tables.current(spark, table), "id_compra", "complemento_de")

    land(folder, "1.json", {"_id": "r1", "id_compra": "CP1", "status": "paid", "USD": "2.5"}, {"_id": "r2", "id_compra": "CP2"})
    assert run("c1") == [(1, None), (2, None)]
    assert values(tables.current(spark, table), "id_compra", "status", "usd")[0][1] == "paid"
    land(folder, "2.json", {"_id": "r3", "id_compra": "CP3", "complemento_de": "r1"},
         {"_id": "r2", "id_compra": "CP2"})
    want = [(1, None), (2, None), (3, 1)]
    assert run("c1") == want
    assert run("c2") == want  # a lost checkpoint replays every page and inserts nothing
    # a complement that lands after the records that name it, by text and as an object
    land(folder, "3.json", {"_id": "r4", "id_compra": "CP4", "complemento_de": "r5"},
         {"_id": "r6", "id_compra": "CP6", "complemento_de": {"_id": "r5"}})
    assert run("c1") == [*want, (4, None), (6, None)]
    land(folder, "4.json", {"_id": "r5", "id_compra": "CP5"})
    full = [*want, (4, 5), (5, None), (6, 5)]
    assert run("c1") == full
    # only the state of the ids of this batch was touched: its record's own, which two waited for
    progress = [p for p in queries[-1].recentProgress if p["numInputRows"]]
    state = progress[-1]["stateOperators"][0]
    assert state["numRowsUpdated"] == 1 and state["numRowsTotal"] >= 6
    # several versions in one file: the last line counts, for the number and for the fact
    (folder / "5.json").write_text(
        "\n".join(
            json.dumps({"response": {"results": [r]}})
            for r in (
                {"_id": "r7", "id_compra": "CP8", "status": "old"}, {"_id": "r7", "id_compra": "CP7", "status": "new"},
                {"_id": "r9", "id_compra": "CP9", "complemento_de": "r7"}, {"_id": "r9", "id_compra": "CP9", "status": "x"},
            )
        )
    )
    got = run("c1")
    assert [r for r in got if r[0] in (7, 8)] == [(7, None), (8, None)]
    batch = records.purchases_source(landing.read_pages(spark, str(folder)))
    assert values(batch, "id_compra", "complemento_de")[:6] == full
    assert run("c3") == got


def test_streaming_transfers(spark, tmp_path, values, table):
    folder = tmp_path / "pages"
    spark.sql(
        f"CREATE TABLE {table} (wallet_id STRING, tipo STRING, moneda STRING, monto DECIMAL(38,9), kft_id STRING)"
    )
    load = add_new(table, records.transfers_source, ["kft_id"])
    for name, rows in (("1.json", ["a", "b"]), ("2.json", ["b", "c"])):
        land(folder, name, *[{"_id": i, "value": 1} for i in rows])
        intake(spark, str(folder), str(tmp_path / "c"), load).awaitTermination()
    assert values(tables.current(spark, table), "kft_id") == [("a",), ("b",), ("c",)]


def test_report_sink(spark, frame, tmp_path, values):
    rows = frame("a long, b string", (1, "x, y"), (2, None))
    reports.write_report(rows, str(tmp_path / "csv"))
    back = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert back.columns == ["a", "b"] and values(back) == [("1", "x, y"), ("2", None)]
    reports.write_report(rows, str(tmp_path / "parquet"), "parquet")
    assert values(spark.read.parquet(str(tmp_path / "parquet"))) == values(rows)
    with pytest.raises(ValueError):
        reports.write_report(rows, str(tmp_path / "x"), "xlsx")


def test_every_report_is_exported(spark, tmp_path):
    t = Tables(spark, SF_SMALL)
    names = (
        "socios compras prospectos learning_compras learning_curso pagos pagos_transacciones socio_productos"
    ).split()
    sources = {name: t(name) for name in names} | {"enum": t("enumeracion")}
    exports.export(sources, str(tmp_path), "parquet", excluded_partners=[0])
    assert len(exports.REPORTS) == 14
    for name in exports.REPORTS:
        back = spark.read.parquet(f"{tmp_path}/{name}")
        assert back.columns == exports.REPORTS[name](sources).columns
    assert spark.read.parquet(f"{tmp_path}/active_partners").where("socio = 0").isEmpty()
    exports.export(sources, str(tmp_path / "text"), names=["inflows"])
    assert spark.read.option("header", True).csv(str(tmp_path / "text/inflows")).count() > 0


def test_run_log(spark, frame, tmp_path, values):
    moment = dt.datetime(2030, 1, 1)
    rows = frame("k long", (1,), (2,), (3,))

    def work(counter):
        audit.counted(rows, counter).write.parquet(str(tmp_path / "out"))

    done = audit.run_step(spark, "t", "insert", work, moment)
    failed = audit.run_step(spark, "t", "insert", work, moment)  # the folder exists now
    told = audit.run_step(spark, "t", "update", lambda _: 7, moment)
    assert told.first().registros_insertados == 7
    assert values(done) == [("success", "t", "insert", 3, "No error", moment)]
    row = failed.first()
    assert (row.estatus, row.registros_insertados) == ("failed", 0) and "exist" in row.error_text.lower()
    assert done.columns == list(audit.LOG_COLUMNS)
