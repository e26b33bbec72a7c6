"""Nested JSON documents in one folder per day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tillwork import session
from tillwork.sources import schemas

ORDERS, ORDERS_DAY = "orders", "date"
PRODUCTS, PRODUCTS_DAY = "products", "snapshot_date"

#: A zipped file cannot be split, so it holds no more documents than one task reads with ease.
FILE_DOCUMENTS = 100_000
#: Text of the documents that one job loads; a day that has more is a job of its own.
LOAD_BYTES = 2 << 30
#: Shuffled bytes that one task makes into documents.
TASK_BYTES = "8m"
#: Bytes of text in a byte of a zipped file, about.
ZIPPED = 16


def _read(
    spark: SparkSession, root: str, kind: str, day: str, schema: T.StructType,
    start: str | None, end: str | None, json_lines: bool, corrupt: bool,
    folders: Sequence[str] | None = None,
) -> DataFrame:
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(schemas.CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).option("multiLine", not json_lines)
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", schemas.CORRUPT)
    # the whole zone is named and the day filter picks its folders
    zone = f"{root.rstrip('/')}/{kind}"
    if folders is None:
        documents = reader.json(zone)
    else:
        documents = reader.option("basePath", zone).json([f"{zone}/{name}" for name in folders])
    if start is None:
        return documents
    return documents.filter(
        F.col(day).between(F.lit(start).cast("date"), F.lit(end or start).cast("date"))
    )


def read_orders(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None,
    json_lines: bool = False, corrupt: bool = False, folders: Sequence[str] | None = None,
) -> DataFrame:
    """Order documents of the days ``start`` to ``end``, both included; of all days without ``start``.

    A file with one JSON array is one task, however large; ``json_lines`` files
    are split unless they are zipped. ``corrupt`` adds the text of documents that do not fit the schema.
    ``folders`` names the day folders to look in.
    """
    return _read(spark, root, ORDERS, ORDERS_DAY, schemas.ORDER_DOCUMENT,
                 start, end, json_lines, corrupt, folders)


def order_loads(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None,
) -> list[list[str] | None]:
    """Day folders of the orders from ``start`` to ``end`` in groups, each for one job.

    What a job shuffles and keeps is then bounded by ``LOAD_BYTES`` or by its one day, however many days there are.
    """
    return day_groups(spark, f"{root.rstrip('/')}/{ORDERS}", start, end)


def day_groups(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None,
) -> list[list[str] | None]:
    """Folders ``date=...`` below ``path`` in groups of at most ``LOAD_BYTES`` of text; None: there are none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in store.listStatus(folder)] if store.exists(folder) else []
    prefix = f"{ORDERS_DAY}="
    loads, filled = [], LOAD_BYTES
    for name in sorted(n for n in names if n.startswith(prefix)):
        if start is not None and not start <= name.removeprefix(prefix) <= (end or start):
            continue
        size = 0
        for f in store.listStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, name)):
            size += f.getLen() * (ZIPPED if f.getPath().getName().endswith((".gz", ".parquet")) else 1)
        if filled + size > LOAD_BYTES:
            loads.append([])
            filled = 0
        loads[-1].append(name)
        filled += size
    return loads or [None]


def loads(spark: SparkSession, root: str) -> list[list[str]]:
    """All delivery days of orders and products in groups, each for one job; see ``order_loads``."""
    prefix = len(ORDERS_DAY) + 1
    groups = [[name[prefix:] for name in names] for names in order_loads(spark, root) if names]
    rest = set(product_days(spark, root)).difference(*groups)
    return [*groups, sorted(rest)] if rest else groups


def _days(spark: SparkSession, path: str, day: str) -> list[str]:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in store.listStatus(folder)] if store.exists(folder) else []
    return sorted(n.removeprefix(f"{day}=") for n in names if n.startswith(f"{day}="))


def order_days(spark: SparkSession, root: str) -> list[str]:
    return _days(spark, f"{root.rstrip('/')}/{ORDERS}", ORDERS_DAY)


def product_days(spark: SparkSession, root: str) -> list[str]:
    return _days(spark, f"{root.rstrip('/')}/{PRODUCTS}", PRODUCTS_DAY)


def drop_orders(spark: SparkSession, root: str, folders: Sequence[str] | None) -> None:
    """Remove day folders of orders that are loaded."""
    for name in folders or []:
        session.drop_path(spark, f"{root.rstrip('/')}/{ORDERS}/{name}")


def read_products(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None,
    json_lines: bool = False, corrupt: bool = False, folders: Sequence[str] | None = None,
) -> DataFrame:
    """Product snapshot documents of the days ``start`` to ``end``; of all days without ``start``.

    ``folders`` names the day folders to look in.
    """
    return _read(spark, root, PRODUCTS, PRODUCTS_DAY, schemas.PRODUCT_DOCUMENT,
                 start, end, json_lines, corrupt, folders)


def write_documents(documents: DataFrame, root: str, kind: str, day: str, dealt: bool = False) -> None:
    """Documents as zipped JSON Lines in day folders; a heavy day gets several files, one task each for readers.

    Documents that were ``dealt`` out by their day before they were put together are not shuffled again.
    """
    rows = documents if dealt else documents.hint("rebalance", day)
    # documents take many times the room of the narrow rows they are made from, so tasks take fewer of those
    with session.setting(documents.sparkSession, "spark.sql.adaptive.advisoryPartitionSizeInBytes", TASK_BYTES):
        rows.write.partitionBy(day).mode("append").option("compression", "gzip").option(
            "maxRecordsPerFile", FILE_DOCUMENTS).json(f"{root.rstrip('/')}/{kind}")
