import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from tests.test_pipeline import item, order, raw  # noqa: F401 - raw is a fixture
from tillwork.plans import check_suite, incremental, job
from tillwork.sources import releases

CHECKS = {"source_checks": check_suite.source_checks(channels=[" Web"]),
          "model_checks": [c for c in check_suite.model_checks()
                           if c.label != "not_null_mart_weekly_revenue_category"]}


def put(root, day, documents, products=None):
    """Replace a day of the raw zone."""
    folder = os.path.join(root, "orders", f"date={day}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "orders.json"), "w") as out:
        json.dump(documents, out)
    folder = os.path.join(root, "products", f"snapshot_date={day}")
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, "products.json"), "w") as out:
        json.dump({"source": "shop", "products": [
            {"product_id": p, "product_name": n, "brand": "B", "category": c, "subcategory": "s", "unit_price": 20.0,
             "cost_price": 4.5, "sku": "K", "is_active": True, "updated_at": day, "currency": "EUR"}
            for p, n, c in products or []]}, out)


def files(release, table):
    """Names of the files of each part."""
    return {p: sorted(n for n in os.listdir(f"{release.root}/{f}") if n.endswith(".parquet"))
            for p, f in release.parts(table).items()}


def same_as_full(spark, raw_root, outcome, tmp_path, rows, name):
    models, _ = job.run(spark, raw_root, str(tmp_path / f"{name}-in"), str(tmp_path / f"{name}-out"), "2000-01-01", "2100-01-01",
                        **CHECKS)
    for table, full in models.items():
        columns = [c for c in full.columns if c != "_ingested_at"]
        assert rows(outcome.release.read(table).select(*columns)) == rows(full.select(*columns)), table


def test_loads_equal_a_full_rebuild_and_leave_other_parts_alone(spark, raw, tmp_path, rows):  # noqa: F811
    put(raw, "2026-03-31", [
        order("2026-03-31", 1, [item("m-1", "P1"), item("m-2", "P2", 4)], customer="C7"),
        order("2026-03-31", 2, [item("m-3", "P9")], customer="C1")])
    put(raw, "2026-04-01", [order("2026-04-01", 1, [item("a-1", "P2")], customer="C8")])
    lake = str(tmp_path / "lake")
    first = incremental.load(spark, raw, lake, "2026-01-01", "2026-04-30", **CHECKS)
    assert first.published and first.release.number == 1
    assert list(first.months) == ["2026-01", "2026-03", "2026-04"]

    # the last day of March again: an order gone, one of another customer, one cancelled
    put(raw, "2026-03-31", [
        order("2026-03-31", 1, [item("m-1", "P1", 9)], customer="C9"),
        order("2026-03-31", 3, [item("m-4", "P1")], status="cancelled", customer="C7")])
    second = incremental.load(spark, raw, lake, "2026-03-31", **CHECKS)
    assert second.published and list(second.months) == ["2026-03"] and list(second.weeks) == ["2026-03-30"]
    for table, touched in (("fact_order_items", {"2026-03"}), ("mart_weekly_revenue", {"2026-03-30"}),
                           ("mart_top_products", {"2026-03-30"}), ("stg_orders", {"2026-03-31"})):
        before, after = files(first.release, table), files(second.release, table)
        assert before.keys() == after.keys()
        assert {p for p in before if before[p] != after[p]} == touched
    assert rows(first.release.read("mart_customer_ltv").select("customer_id")) != rows(
        second.release.read("mart_customer_ltv").select("customer_id"))

    # a redelivery on a later day moves an order to another month; a product gets another name
    put(raw, "2026-04-02", [{**order("2026-04-02", 1, [item("a-1", "P2", 5)], customer="C8"),
                             "order_id": "ORD-20260401-00001"}], [("P9", "found", "Lips")])
    third = incremental.load(spark, raw, lake, "2026-04-02", **CHECKS)
    assert third.published
    same_as_full(spark, raw, third, tmp_path, rows, "three")

    # a day that comes back empty
    put(raw, "2026-03-31", [])
    fourth = incremental.load(spark, raw, lake, "2026-03-31", **CHECKS)
    assert "2026-03" not in fourth.release.parts("fact_order_items")
    same_as_full(spark, raw, fourth, tmp_path, rows, "four")


def test_a_failing_load_is_held_back(spark, raw, tmp_path, rows):  # noqa: F811
    lake = str(tmp_path / "lake")
    first = incremental.load(spark, raw, lake, "2026-01-03", **CHECKS)
    opened = releases.latest(spark, lake).read("mart_weekly_revenue")
    before = rows(opened)
    wrong = shutil.copytree(raw, str(tmp_path / "wrong"))
    put(wrong, "2026-01-04", [order("2026-01-04", 1, [item("9", "P1")], status="lost in the post")])
    held = incremental.load(spark, wrong, lake, "2026-01-04", **CHECKS)
    assert not held.published and held.report.filter("status = 'error'").count() == 1
    assert releases.latest(spark, lake).number == first.release.number == 1
    assert rows(releases.latest(spark, lake).read("mart_weekly_revenue")) == before
    assert rows(opened) == before


def test_drafts(spark, tmp_path, rows):
    root = str(tmp_path / "lake")
    nothing = releases.latest(spark, root)
    assert nothing.number == 0 and nothing.parts("t") == {}
    with pytest.raises(LookupError):
        nothing.read("t")
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "x int, p string")
    draft = releases.Draft(nothing)
    draft.replace("t", df, F.col("p"))
    draft.replace("u", df.limit(0))
    one = draft.publish()
    assert set(one.parts("t")) == {"a", "b", releases.NO_PART}
    assert rows(one.read("t", ["a", releases.NO_PART, "z"])) == [(1, "a"), (3, None)]
    assert one.read("u").columns == ["x", "p"] and one.read("u").count() == 0
    assert one.read("t", []).count() == 0

    mine, theirs = releases.Draft(one), releases.Draft(one)
    with pytest.raises(ValueError):
        mine.replace("t", df, F.col("p"), lambda part: part == "a")
    mine.replace("t", df.filter("x = 1").withColumn("x", F.lit(9)), F.col("p"), lambda part: part == "a")
    theirs.replace("t", df)
    mine.publish()
    with pytest.raises(releases.PublishedMeanwhile):
        theirs.publish()
    two = releases.latest(spark, root)
    assert rows(two.read("t")) == [(2, "b"), (3, None), (9, "a")] and rows(one.read("t", ["a"])) == [(1, "a")]
    assert rows(releases.latest(spark, root, 1).read("t", ["a"])) == [(1, "a")]
    # the build of release 1 still holds parts of release 2; the refused and the unpublished one go
    assert releases.clean(spark, root, keep=1) == 2
    assert rows(two.read("t")) == [(2, "b"), (3, None), (9, "a")]
    with pytest.raises(LookupError):
        releases.latest(spark, root, 1)


def test_command_line(spark, raw, tmp_path, capsys):  # noqa: F811
    job.main(["--raw", raw, "--target", str(tmp_path / "lake"), "--date", "2026-01-03", "--releases"])
    assert "held back" in capsys.readouterr().out  # its channels are not the shop's
    with pytest.raises(SystemExit):
        job.main(["--raw", raw, "--target", str(tmp_path / "lake")])
