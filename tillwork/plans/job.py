"""The whole daily job: documents in, checked marts out."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, timedelta
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tillwork import session
from tillwork.plans import check_suite, incremental, ingest, marts, staging, warehouse
from tillwork.sources.tables import as_views, write_table


def build_models(
    spark: SparkSession, ingested: str, target: str, calendar: str = "split"
) -> dict[str, DataFrame]:
    """Staging views over the ingested tables, then dimensions, fact and marts as tables.

    The fact is written once and the marts read it back.
    """
    session.tune(spark)
    with session.shuffles_freed(spark):
        return _build_models(spark, ingested, target, calendar)


def _write_fact(
    raw_items: DataFrame, orders: DataFrame, dim_products: DataFrame, calendar: str, target: str, stored: int,
) -> DataFrame:
    """The fact, some months of lines at a time."""
    path = f"{target}/fact_order_items"
    month = incremental.month()
    mode = "overwrite"
    with session.kept(warehouse.order_context(orders)) as context:
        for group in incremental.part_groups(incremental.parts(raw_items, month), stored):
            items = staging.stg_order_items(incremental.within(raw_items, month, group, 31), calendar)
            fact = warehouse.fact_order_items(items, context, dim_products)
            fact.sortWithinPartitions(*warehouse.FACT_ORDER).write.mode(mode).option(
                "compression", "zstd").parquet(path)
            mode = "append"
    return raw_items.sparkSession.read.parquet(path)


def _write_weekly(fact: DataFrame, dim_products: DataFrame, target: str) -> dict[str, DataFrame]:
    """The weekly marts, some weeks of the fact at a time."""
    spark, week = fact.sparkSession, incremental.week()
    weeks = incremental.parts(fact, week)
    mode = "overwrite"

    def write(name: str, lines: DataFrame, mode: str) -> None:
        with session.scratch_freed(spark):
            mart = incremental.weekly_mart(name, lines, dim_products)
            mart.write.mode(mode).option("compression", "zstd").parquet(f"{target}/{name}")

    for group in incremental.part_groups(weeks, session.stored_bytes(spark, f"{target}/fact_order_items")):
        lines = incremental.within(fact, week, group, 6)
        session.together(*[partial(write, name, lines, mode) for name in incremental.WEEKLY_MARTS])
        mode = "append"
    return {name: spark.read.parquet(f"{target}/{name}") for name in incremental.WEEKLY_MARTS}


def _build_models(spark: SparkSession, ingested: str, target: str, calendar: str) -> dict[str, DataFrame]:
    source, target = ingested.rstrip("/"), target.rstrip("/")

    def raw(name: str) -> DataFrame:
        return spark.read.parquet(f"{source}/{name}")

    orders = staging.stg_orders(raw("stg_orders"), calendar)
    items = staging.stg_order_items(raw("stg_order_items"), calendar)
    products = staging.stg_products(raw("stg_products"))
    as_views({"stg_orders": orders, "stg_order_items": items, "stg_products": products})

    def keep(name: str, df: DataFrame) -> DataFrame:
        return write_table(df, f"{target}/{name}")

    dim_products = keep("dim_products", warehouse.dim_products(products))
    dim_customers, fact = session.together(
        lambda: keep("dim_customers", warehouse.dim_customers(orders)),
        lambda: _write_fact(raw("stg_order_items"), orders, dim_products, calendar, target, session.stored_bytes(
            spark, f"{source}/stg_order_items")))
    lines = fact.drop(*warehouse.PRODUCT_TEXT)
    weekly, ltv = session.together(
        lambda: _write_weekly(fact, dim_products, target),
        lambda: keep("mart_customer_ltv", marts.mart_customer_ltv(lines)))
    return {
        "dim_products": dim_products,
        "dim_customers": dim_customers,
        "fact_order_items": fact,
        **weekly,
        "mart_customer_ltv": ltv,
    }


def run(
    spark: SparkSession, raw_root: str, ingested: str, target: str, start: str | None = None,
    end: str | None = None, json_lines: bool = False,
    source_checks: Sequence[check_suite.Check] | None = None,
    model_checks: Sequence[check_suite.Check] | None = None, consume: bool = False,
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Ingest the days, rebuild the models, check everything.

    Returns the model tables and the check report, which is written to
    ``<target>/check_report`` too. A failed check does not undo the build. ``consume`` removes
    a day's order documents once they are loaded.
    """
    ingest.ingest(spark, raw_root, ingested, start, end, json_lines, consume=consume)
    models = build_models(spark, ingested, target)
    sources = {
        s.name: spark.read.parquet(f"{ingested.rstrip('/')}/{s.name}")
        for s in check_suite.sources()
    }
    wanted = [
        *(check_suite.source_checks() if source_checks is None else source_checks),
        *(check_suite.model_checks() if model_checks is None else model_checks),
    ]
    report = check_suite.run_checks({**sources, **models}, wanted)
    return models, write_table(report, f"{target.rstrip('/')}/check_report")


def main(argv: Sequence[str] | None = None) -> None:
    yesterday = str(date.today() - timedelta(days=1))
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--raw", required=True, help="folder of the raw documents")
    parser.add_argument("--ingested", help="folder of the staging tables, not with --releases")
    parser.add_argument("--target", required=True, help="folder of dimensions, fact and marts")
    parser.add_argument("--date", default=yesterday, help="first day, default yesterday")
    parser.add_argument("--end", help="last day of a backfill, default the first day")
    parser.add_argument("--json-lines", action="store_true", help="one document per line")
    parser.add_argument("--releases", action="store_true",
                        help="keep all tables as releases below the target: rebuild only what the days touch, "
                             "publish only if no check fails")
    args = parser.parse_args(argv)
    if not args.releases and not args.ingested:
        parser.error("--ingested is needed without --releases")
    spark = session.build("daily-job")
    if args.releases:
        outcome = incremental.load(spark, args.raw, args.target, args.date, args.end, args.json_lines)
        report = outcome.report
        print(f"release {outcome.release.number}",
              "published" if outcome.published else "stays, the load was held back")
    else:
        _, report = run(spark, args.raw, args.ingested, args.target, args.date, args.end,
                        args.json_lines)
    for row in report.orderBy("check_name").toLocalIterator():
        print(*row, sep="\t")


if __name__ == "__main__":
    main()
