"""Documents take little room on their way, and what is loaded group by group is what is loaded at once."""

import glob
import os
import threading
from datetime import datetime

import pytest

from tillwork import session
from tillwork.plans import incremental, ingest
from tillwork.registry import lake, streams
from tillwork.sources import raw_zone, star_schema, tables

ORDERS = ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
          "o_orderpriority string")
LINES = ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
         "l_extendedprice double, l_discount double, l_shipdate timestamp")


@pytest.fixture
def star(spark, tmp_path):
    days = [datetime(1996, m, 1 + d) for m in (4, 5, 6) for d in range(4)]
    orders = [(k, k % 7, "FOP"[k % 3], 1000.0 * k, days[k % 12], "5-LOW") for k in range(120)]
    orders += [(500, None, None, None, None, None), (7, 0, "F", 7000.0, days[7], "5-LOW"), (None, 1, "F", 1.0, days[0], "5-LOW")]
    lines = [(k, k % 5, k % 3, n, float(n), 10.5 * k, 0.1, days[0])
             for k in range(100) for n in range(1, 2 + k % 4)]
    lines += [(500, 1, 1, 1, 2.0, 5.0, 0.0, None), (None, 1, 1, 1, 1.0, 1.0, 0.0, None), (3, 3, 0, 1, 0.5, 9.0, 0.1, days[0])]
    tables = {
        "orders": (orders, ORDERS), "lineitem": (lines, LINES),
        "customer": ([(k, k, "BUILDING", 0.5) for k in range(7)],
                     "c_custkey bigint, c_nationkey int, c_mktsegment string, c_acctbal double"),
        "part": ([(k, f"part {k}", "B", "PROMO", k, 3.0 + k) for k in range(5)],
                 "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    }
    for name, (made, schema) in tables.items():
        spark.createDataFrame(made, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return star_schema.StarSchema(spark, str(tmp_path))


def test_documents_are_zipped_and_loaded_ones_are_gone(spark, star, rows):
    root = lake._land_orders(star).removeprefix("file://")
    landed = glob.glob(f"{root}/orders/*/part-*")
    text = sum(len(r[0]) + 1 for r in spark.read.text(f"{root}/orders").select("value").collect())
    assert all(f.endswith(".json.gz") for f in landed)
    assert sum(map(os.path.getsize, landed)) < text / 3
    shared = session.shared_dir(spark).removeprefix("file://")
    before = set(glob.glob(f"{shared}/raw-*/orders/*/part-*") + glob.glob(f"{shared}/kept-*"))
    for query in (lake.json_items, lake.daily_job_rejected, lake.backfill_withdrawn, streams.stream_rejected):
        query(star).collect()
    assert set(glob.glob(f"{shared}/raw-*/orders/*/part-*") + glob.glob(f"{shared}/kept-*")) <= before


@pytest.mark.parametrize("query", [
    lake.json_orders, lake.json_items, lake.json_items_keep_empty, lake.backfill_counts, lake.daily_job_rejected,
    lake.daily_job_revenue, lake.daily_job_incremental, streams.stream_ingest, streams.stream_rejected])
def test_groups_change_nothing(spark, star, rows, monkeypatch, query):
    whole = rows(query(star))
    stored = sum(session.stored_bytes(spark, f"{star.folder}/{t}.parquet") for t in ("orders", "lineitem"))
    for place, name, value in ((star_schema, "SLICE_BYTES", stored // 2 + 1), (raw_zone, "LOAD_BYTES", 1),
                               (raw_zone, "FILE_DOCUMENTS", 20), (incremental, "FACT_BYTES", 1),
                               (streams, "SLICE_BYTES", 10_000)):
        monkeypatch.setattr(place, name, value)
    assert star_schema.order_slices(star) > 1
    assert rows(query(star)) == whole


def test_a_repeated_load_keeps_one_group_of_documents(spark, star, monkeypatch):
    monkeypatch.setattr(raw_zone, "LOAD_BYTES", 1)
    there, ingested = [], lake.ingest.ingest

    def ingest(spark, root, *args, **kwargs):
        there.append(set(raw_zone.order_days(spark, root)))
        return ingested(spark, root, *args, **kwargs)

    monkeypatch.setattr(lake.ingest, "ingest", ingest)
    found = {(r.table_name, str(r.day)): r.n for r in lake.backfill_counts(star).collect()}
    # each day comes twice in a row and is gone before the next; products come last
    assert there[::2] == there[1::2]
    assert [len(days) for days in there[::2]] == [4, 3, 2, 1, 0]
    assert found[("stg_products", "2001-08-01")] == 10 and ("stg_orders", "None") in found


def test_weekly_marts_are_built_some_weeks_at_a_time(spark, star, monkeypatch):
    monkeypatch.setattr(incremental, "FACT_BYTES", 1)
    built, mart = [], incremental.marts.mart_weekly_revenue

    def weekly(fact):
        built.append(sorted({str(r.order_date)[:7] for r in fact.select("order_date").collect()}))
        return mart(fact)

    monkeypatch.setattr(incremental.marts, "mart_weekly_revenue", weekly)
    lake.daily_job_revenue(star)
    whole = len(built)
    assert whole >= 3 and all(len(months) <= 1 for months in built)
    lake._load(star, lambda documents: documents, session.scratch_path(spark, "lake"))
    assert len(built) == 2 * whole and all(len(months) <= 1 for months in built)


def test_jobs_leave_no_scratch_tables(spark, star):
    shared = session.shared_dir(spark).removeprefix("file://")
    before = set(glob.glob(f"{shared}/kept-*"))
    lake.daily_job_report(star).collect()
    lake._load(star, lambda documents: documents, session.scratch_path(spark, "lake"))
    assert set(glob.glob(f"{shared}/kept-*")) <= before


def test_days_that_no_load_takes_go_slice_by_slice(spark, star, monkeypatch):
    stored = sum(session.stored_bytes(spark, f"{star.folder}/{t}.parquet") for t in ("orders", "lineitem"))
    monkeypatch.setattr(star_schema, "SLICE_BYTES", stored // 4 + 1)
    root = lake._land_orders(star, wanted=lake.RELOADED)
    whole = lake._land_orders(star)

    def per_day(path):
        return {str(r.date): r["count"] for r in spark.read.option("basePath", f"{path}/orders").json(
            f"{path}/orders").groupBy("date").count().collect()}

    some, every = per_day(root), per_day(whole)
    assert all(some[day] == every[day] for day in lake.RELOADED)
    assert some["1996-04-01"] < every["1996-04-01"]


def test_tables_of_a_group_are_written_at_once(spark, star):
    root = lake._land_orders(star)
    met, begun = [], threading.Barrier(len(ingest.ORDER_TABLES), timeout=60)

    def write(name, rows):
        begun.wait()  # breaks where one is written after the other
        met.append((name, rows.count()))

    ingest.load_orders(spark, root, None, None, True, ingest.this_moment(), write, consume=False)
    assert sorted(n for n, _ in met) == sorted(ingest.ORDER_TABLES) and min(n for t, n in met if t != "rejected") > 100


def test_next_copy_is_written_while_one_is_used(spark):
    second = threading.Event()

    def made(number):
        if number == 2:
            second.set()
        return spark.range(number)

    copies = session.kept_ahead(spark, [lambda n=n: made(n) for n in (1, 2, 3)])
    first = next(copies)
    assert second.wait(60) and first.count() == 1
    assert [c.count() for c in copies] == [2, 3]
    assert not os.path.exists(first.inputFiles()[0].removeprefix("file://"))


def test_two_loads_run_at_once(spark, star, monkeypatch):
    monkeypatch.setattr(raw_zone, "LOAD_BYTES", 1)
    begun, flatten = threading.Barrier(2, timeout=60), lake.ingest.flatten_orders

    def both(documents):
        begun.wait()  # breaks where one load ends before the next
        return flatten(documents)

    assert lake._flat(star, both).count() > 100


def test_only_named_days_are_listed(spark, tmp_path):
    spark.range(6).selectExpr("id", "id % 3 as day").write.partitionBy("day").parquet(f"{tmp_path}/t")
    assert set(tables.day_files(spark, f"{tmp_path}/t", "day", ["1", "7"])) == {"1"}
    assert set(tables.day_files(spark, f"{tmp_path}/t", "day")) == {"0", "1", "2"}
