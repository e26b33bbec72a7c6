"""What several operators need: reading tables, bounded slices of a batch, running totals over a sort."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tillwork import session

#: Characters of text that Python works on at once. A single longer text is taken alone.
SLICE_CHARS = 2_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the session's Python workers, once per session."""
    context = spark.sparkContext
    if not any(os.path.basename(f).startswith("tillwork-") for f in context.listFiles):
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = os.path.join(tempfile.mkdtemp(), f"tillwork-{uuid.uuid4().hex[:8]}.zip")
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in os.walk(os.path.join(top, "tillwork")):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, top))
        context.addPyFile(archive)
    return spark


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted`` if no column of ``df`` is called so in any case, else a name nobody has."""
    taken = {c.lower() for c in df.columns}
    return wanted if wanted.lower() not in taken else f"{wanted}_{uuid.uuid4().hex[:8]}"


def cut_batches(batches: Iterable[pa.RecordBatch], text: str = "text",
                limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of a slice have about ``limit`` bytes at most."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def slices(batches: Iterable[pa.RecordBatch], text: str = "text",
           limit: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """The same with the texts of each slice."""
    for batch in cut_batches(batches, text, limit):
        yield batch, batch.column(batch.schema.get_field_index(text)).to_pylist()


def running_total(df: DataFrame, order: list[str], value: str, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows that sort before this one.

    The rows are sorted into ranges, each range is summed as it is written, and
    the ranges pass on one number each, so no task sees more than its range.
    ``order`` must decide between rows whose places matter.
    """
    spark = df.sparkSession
    part, within = free_name(df, "range_no"), free_name(df, "range_before")
    ranged = df.repartitionByRange(session.shuffle_partitions(spark), *order)
    schema = T.StructType([*df.schema.fields, T.StructField(part, T.IntegerType()),
                           T.StructField(within, T.LongType())])

    def add(batches):
        no, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = np.asarray(batch.column(batch.schema.get_field_index(value)), dtype=np.int64)
            ends = before + np.cumsum(n)
            columns = [*batch.columns, pa.array(np.full(len(n), no, np.int32)), pa.array(ends - n)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, part, within])
            before = int(ends[-1]) if len(n) else before

    kept = session.materialise(ranged.sortWithinPartitions(*order).mapInArrow(add, schema))
    # one row per range: the number of ranges is the number of shuffle partitions
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    base = kept.groupBy(part).agg(F.sum(value).alias("n")).select(
        part, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return (kept.join(F.broadcast(base), part)
            .withColumn(out, F.col("base") + F.col(within)).drop(part, within, "base"))
