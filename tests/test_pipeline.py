import json
import os
import shutil
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tillwork import session
from tillwork.plans import check_suite, ingest, job, marts, staging, warehouse
from tillwork.sources import raw_zone
from tillwork.streaming import landing


def item(number, product, quantity=1, price=10.0, discount=0.0):
    return {"line_item_id": f"LI-{number}", "product_id": product, "sku": "s",
            "product_name": "on the line", "brand": "b", "category": "Face", "subcategory": "c",
            "quantity": quantity, "original_price": price, "sale_price": price,
            "discount_pct": discount, "cost_price": 4.5, "currency": "EUR"}


def order(day, number, items, status="completed", customer="C1", tier="gold"):
    return {"order_id": f"ORD-{day.replace('-', '')}-{number:05d}",
            "created_at": f"{day}T14:05:09Z", "channel": " Web", "order_status": status,
            "shipping_country": "nl ",
            "customer": {"customer_id": customer, "country_code": "NL", "country": "Netherlands",
                         "city": "Utrecht", "age_group": "25-34", "gender": "f",
                         "loyalty_tier": tier, "signup_date": "2025-01-02"},
            "items": items}


DAYS = {
    "2026-01-03": [  # a Saturday
        order("2026-01-03", 1, [item("1-1", "P1", 2, 10.0, 0.1), item("1-2", "P2", 1, 5.0)]),
        order("2026-01-03", 2, [], customer="C2"),
        order("2026-01-03", 3, [item("3-1", "P1")], status="returned", tier="basic"),
    ],
    "2026-01-04": [  # the Sunday after it
        order("2026-01-04", 1, [item("1-1", "P1", 3, 9.99), item("1-3", "P9", 1, 1.0)],
              customer="C2", tier="basic"),
        order("2026-01-04", 2, [item("2-1", "P2", 0), {**item("2-2", "P2"), "sale_price": 0}]),
    ],
}


@pytest.fixture
def raw(tmp_path):
    root = tmp_path / "raw"
    for day, documents in DAYS.items():
        folder = root / "orders" / f"date={day}"
        folder.mkdir(parents=True)
        (folder / "orders.json").write_text(json.dumps(documents, indent=1))
        folder = root / "products" / f"snapshot_date={day}"
        folder.mkdir(parents=True)
        (folder / "products.json").write_text(json.dumps({
            "snapshot_date": day, "source": "shop", "products": [
                {"product_id": p, "product_name": f"{p} {day}", "brand": "B", "category": c,
                 "subcategory": "s", "unit_price": 20.0, "cost_price": 4.5, "sku": "K",
                 "is_active": True, "updated_at": day, "currency": "EUR"}
                for p, c in (("P1", "Face"), ("P2", "Hair"))]}))
    return str(root)


def test_flatten_orders(spark, raw):
    orders = ingest.flatten_orders(raw_zone.read_orders(spark, raw, "2026-01-03"))
    assert orders.columns == [
        "order_id", "order_timestamp", "order_date", "channel", "order_status",
        "shipping_country", "customer_id", "customer_country_code", "customer_country",
        "customer_city", "customer_age_group", "customer_gender", "customer_loyalty_tier",
        "customer_signup_date", "_ingestion_date", "_ingested_at"]
    first = orders.orderBy("order_id").first()
    assert orders.count() == 3
    assert first["order_timestamp"] == datetime(2026, 1, 3, 14, 5, 9)
    assert first["customer_signup_date"] == date(2025, 1, 2)
    assert first["_ingestion_date"] == date(2026, 1, 3)


def test_explode_items(spark, raw):
    read = raw_zone.read_orders(spark, raw, "2026-01-03")
    items = ingest.explode_items(read)
    assert items.count() == 3
    line = items.filter("line_item_id = 'LI-1-1'").first()
    assert float(line["line_total"]) == 20.0 and float(line["line_cost"]) == 9.0
    assert ingest.explode_items(read, keep_empty=True).count() == 4


def test_read_picks_day_folders(spark, raw):
    read = raw_zone.read_orders(spark, raw, "2026-01-04")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert read.count() == 2
    assert raw_zone.read_orders(spark, raw, "2026-01-01", "2026-01-31").count() == 5


def test_bad_input_is_null_or_rejected_and_never_fatal(spark, tmp_path):
    folder = tmp_path / "orders" / "date=2026-02-01"
    folder.mkdir(parents=True)
    good = order("2026-02-01", 1, [item("1-1", "P1")])
    late = {**order("2026-02-01", 2, []), "created_at": "yesterday"}
    broken = {**order("2026-02-01", 3, [{**item("3-1", "P1"), "quantity": "many"}])}
    (folder / "orders.json").write_text("\n".join(json.dumps(d) for d in (good, late, broken)))
    read = raw_zone.read_orders(spark, str(tmp_path), "2026-02-01", json_lines=True)
    flat = ingest.flatten_orders(read)
    assert flat.filter("order_timestamp is null").count() == 1
    parsed = session.materialise(raw_zone.read_orders(
        spark, str(tmp_path), "2026-02-01", json_lines=True, corrupt=True))
    rejected = ingest.rejected_documents(parsed)
    assert [json.loads(r["_corrupt_record"])["order_id"] for r in rejected.collect()] == [
        "ORD-20260201-00003"]


def test_ingest_twice_is_ingest_once(spark, raw, tmp_path, rows):
    target = str(tmp_path / "ingested")
    first = ingest.ingest(spark, raw, target, "2026-01-03", "2026-01-04")
    assert first == {"stg_orders": 5, "stg_order_items": 7, "stg_products": 4, "rejected": 0}
    before = rows(spark.read.parquet(f"{target}/stg_order_items").drop("_ingested_at"))
    assert ingest.ingest(spark, raw, target, "2026-01-04")["stg_orders"] == 2
    assert rows(spark.read.parquet(f"{target}/stg_order_items").drop("_ingested_at")) == before


def test_a_day_that_comes_back_empty_is_empty(spark, raw, tmp_path):
    target = str(tmp_path / "ingested")
    ingest.ingest(spark, raw, target, "2026-01-03", "2026-01-04")
    again = tmp_path / "again" / "orders" / "date=2026-01-04"
    again.mkdir(parents=True)
    (again / "orders.json").write_text("[]")
    shutil.copytree(os.path.join(raw, "products"), str(tmp_path / "again" / "products"))
    ingest.ingest(spark, str(tmp_path / "again"), target, "2026-01-04")
    for name in ("stg_orders", "stg_order_items"):
        days = spark.read.parquet(f"{target}/{name}").select("_ingestion_date").distinct()
        assert [str(r[0]) for r in days.collect()] == ["2026-01-03"]


def test_broken_documents_are_counted_and_unkeyed_lines_stay(spark, raw, tmp_path):
    folder = tmp_path / "orders" / "date=2026-02-01"
    folder.mkdir(parents=True)
    unkeyed = {k: v for k, v in item("1-1", "P1").items() if k != "line_item_id"}
    good = order("2026-02-01", 1, [unkeyed, unkeyed, item("1-2", "P1"), item("1-2", "P1")])
    (folder / "orders.json").write_text("\n".join([json.dumps(good), *['{"order_id": "x'] * 3]))
    shutil.copytree(os.path.join(raw, "products"), str(tmp_path / "products"))
    target = str(tmp_path / "ingested")
    written = ingest.ingest(spark, str(tmp_path), target, "2026-02-01", json_lines=True)
    assert (written["rejected"], written["stg_orders"], written["stg_order_items"]) == (3, 1, 3)
    assert spark.read.parquet(f"{target}/stg_order_items").filter("line_item_id is null").count() == 2


def test_appended_copies_are_settled_in_staging(spark, raw, tmp_path, rows):
    target = str(tmp_path / "ingested")
    for _ in range(2):
        ingest.ingest(spark, raw, target, "2026-01-03", append=True)
    items = spark.read.parquet(f"{target}/stg_order_items")
    assert items.count() == 6
    assert staging.stg_order_items(items).count() == 3


def test_staging_normalises_and_drops_invalid_lines(spark, raw):
    read = raw_zone.read_orders(spark, raw, "2026-01-03", "2026-01-04")
    first = staging.stg_orders(ingest.flatten_orders(read)).orderBy("order_id").first()
    assert (first["channel"], first["shipping_country"]) == ("web", "NL")
    assert (first["year_week"], first["order_week"]) == ("2026-W00", 0)
    items = staging.stg_order_items(ingest.explode_items(read))
    assert items.count() == 5
    assert {r["is_discounted"] for r in items.collect()} == {True, False}


def test_newest_delivery_counts_even_if_it_is_invalid(spark):
    schema = ("line_item_id string, order_id string, order_date date, product_id string, "
              "sku string, product_name string, brand string, category string, "
              "subcategory string, quantity int, original_price double, sale_price double, "
              "discount_pct double, cost_price double, line_total double, line_cost double, "
              "_ingestion_date date, _ingested_at timestamp")
    day = date(2026, 1, 3)
    text = ("P", "s", "n", "b", "c", "d")
    old = ("L", "O", day, *text, 1, 5.0, 5.0, None, 1.0, 5.0, 1.0, day, datetime(2026, 1, 4))
    new = ("L", "O", day, *text, 0, 5.0, 5.0, None, 1.0, 0.0, 0.0, day, datetime(2026, 1, 5))
    assert staging.stg_order_items(spark.createDataFrame([old], schema)).first()[
        "is_discounted"] is False
    assert staging.stg_order_items(spark.createDataFrame([old, new], schema)).count() == 0


def test_job_from_documents_to_marts(spark, raw, tmp_path, rows):
    models, report = job.run(
        spark, raw, str(tmp_path / "in"), str(tmp_path / "out"), "2026-01-03", "2026-01-04",
        source_checks=check_suite.source_checks(channels=[" Web"]))
    fact = models["fact_order_items"]
    assert fact.count() == 4
    unknown = fact.filter("product_id = 'P9'").first()
    assert unknown["product_name"] is None and unknown["category"] is None
    assert fact.filter("product_id = 'P1'").first()["product_name"] == "P1 2026-01-04"

    weekly = rows(models["mart_weekly_revenue"].select(
        "order_week", "year_week", "category", "total_revenue", "units_sold", "total_orders",
        "total_line_items"))
    # one Monday week, cut in two by the Sunday
    assert set(weekly) == {(0, "2026-W00", "Face", 20.0, 2, 1, 1), (0, "2026-W00", "Hair", 5.0, 1, 1, 1),
                           (1, "2026-W00", "Face", 29.97, 3, 1, 1), (1, "2026-W00", None, 1.0, 1, 1, 1)}
    top = rows(models["mart_top_products"].select(
        "rank_by_units", "product_id", "order_week", "rank_by_revenue"))
    assert top == [(1, "P1", 1, 1), (2, "P1", 0, 2), (3, "P2", 0, 3), (4, "P9", 1, 4)]

    listed = marts.in_order(models["mart_top_products"]).select("rank_by_units").collect()
    assert [r[0] for r in listed] == [1, 2, 3, 4]

    buyers = {r["customer_id"]: r for r in models["dim_customers"].collect()}
    assert buyers["C1"]["loyalty_tier"] == "gold" and buyers["C1"]["total_orders"] == 2
    assert buyers["C2"]["loyalty_tier"] == "basic" and buyers["C2"]["total_orders"] == 1
    value = {r["customer_id"]: r["lifetime_revenue"] for r in models["mart_customer_ltv"].collect()}
    assert value == {"C1": 25.0, "C2": 30.97}

    status = {r["check_name"]: r["status"] for r in report.collect()}
    assert len(status) == 29 and status["not_null_mart_weekly_revenue_category"] == "error"
    assert sum(s == "error" for s in status.values()) == 1
    assert spark.read.parquet(str(tmp_path / "out" / "check_report")).count() == 29
    margin = models["dim_products"].first()
    assert float(margin["unit_margin"]) == 15.5 and margin["margin_pct"] == 77.5


def test_job_from_the_command_line(spark, raw, tmp_path, capsys):
    job.main(["--raw", raw, "--ingested", str(tmp_path / "in"), "--target", str(tmp_path / "out"),
              "--date", "2026-01-03", "--end", "2026-01-04"])
    assert "accepted_values_stg_orders_channel" in capsys.readouterr().out
    assert spark.read.parquet(str(tmp_path / "out" / "mart_weekly_revenue")).count() == 4


def test_dim_customers_history(spark, raw):
    read = raw_zone.read_orders(spark, raw, "2026-01-03", "2026-01-04")
    orders = staging.stg_orders(ingest.flatten_orders(read))
    whole = {r["customer_id"]: r["total_orders"]
             for r in warehouse.dim_customers(orders, "all").collect()}
    assert whole == {"C1": 3, "C2": 2}
    with pytest.raises(ValueError):
        warehouse.dim_customers(orders, "some")


def test_iso_calendar_keeps_a_week_whole(spark, raw):
    read = raw_zone.read_orders(spark, raw, "2026-01-03", "2026-01-04")
    items = staging.stg_order_items(ingest.explode_items(read), "iso")
    orders = staging.stg_orders(ingest.flatten_orders(read))
    lines = warehouse.fact_order_lines(items, orders).withColumn("category", F.lit("any"))
    weekly = marts.mart_weekly_revenue(lines).collect()
    assert [(r["year_week"], r["units_sold"]) for r in weekly] == [("2026-W01", 7)]


def test_ranked_products_by_limit(spark, raw, rows):
    read = raw_zone.read_orders(spark, raw, "2026-01-03", "2026-01-04")
    lines = warehouse.fact_order_lines(
        staging.stg_order_items(ingest.explode_items(read)),
        staging.stg_orders(ingest.flatten_orders(read)))
    best = marts.top_products_per_week(lines, 2)
    assert len(rows(best)) == 2
    # groups are cut before they are shuffled, for limits above Spark's threshold too
    for limit in (2, 5000):
        plan = marts.top_products_per_week(lines, limit)._jdf.queryExecution().executedPlan().toString()
        assert f"{limit}, Partial" in plan and f"{limit}, Final" in plan


def test_stream_takes_each_file_once(spark, raw, tmp_path, rows):
    target, checkpoint = str(tmp_path / "tables"), str(tmp_path / "checkpoint")
    landing.ingest_new_files(spark, raw, target, checkpoint, json_lines=False, max_files=1)
    landing.ingest_new_files(spark, raw, target, checkpoint, json_lines=False, max_files=1)
    orders = spark.read.parquet(f"{target}/stg_orders")
    assert orders.count() == 5 and orders.select(landing.BATCH).distinct().count() == 2
    batch = ingest.explode_items(raw_zone.read_orders(spark, raw, "2026-01-03", "2026-01-04"))
    stream = spark.read.parquet(f"{target}/stg_order_items").drop(landing.BATCH)
    assert rows(stream.drop("_ingested_at")) == rows(batch.drop("_ingested_at"))


def test_stream_keeps_the_text_of_broken_documents(spark, tmp_path):
    folder = tmp_path / "orders" / "date=2026-02-01"
    folder.mkdir(parents=True)
    good = order("2026-02-01", 1, [item("1-1", "P1")])
    half = {**order("2026-02-01", 2, [{**item("2-1", "P1"), "quantity": "many"}])}
    broken = '{"order_id": "x'
    (folder / "orders.json").write_text("\n".join([json.dumps(good), broken, json.dumps(half), broken]))
    target, checkpoint = str(tmp_path / "tables"), str(tmp_path / "checkpoint")
    landing.ingest_new_files(spark, str(tmp_path), target, checkpoint)
    rejected = spark.read.parquet(f"{target}/rejected")
    assert sorted(r["_corrupt_record"] for r in rejected.collect()) == sorted([broken, broken, json.dumps(half)])
    assert spark.read.parquet(f"{target}/stg_orders").filter("order_id is null").count() == 0
    assert spark.read.parquet(f"{target}/stg_orders").count() == 2
