"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor, wait
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar, copy_context
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings results or plans rely on. All of them can be changed on a running session.
RUNTIME_SETTINGS = {
    # order timestamps carry a literal Z and Monday weeks are cut in UTC
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # split the hot side of a join even where a later aggregate must then shuffle again
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # streaming state lives off heap and spills to disk
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build(app: str = "tillwork", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings above to a session somebody else made."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    A missing setting is an error, because files in it must outlive executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        current = sc.getCheckpointDir()
        if current:
            return current
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


#: Where ``materialise`` notes what it writes, if somebody wants that removed.
_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder, cut its lineage and read it back.

    As a Parquet table each later use reads only its columns.
    """
    path = scratch_path(df.sparkSession, "kept")
    if _noted.get() is not None:
        _noted.get().append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_freed(spark: SparkSession) -> Iterator[None]:
    """What ``materialise`` writes in here is removed at the end, so all that is made of it must have been written."""
    made: list[str] = []
    before = _noted.set(made)
    try:
        yield
    finally:
        _noted.reset(before)
        for path in made:
            drop_path(spark, path)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """What a file or folder takes in its store."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    return named.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(named).getLength()


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package made and nobody reads any more."""
    named = spark._jvm.org.apache.hadoop.fs.Path(path)
    named.getFileSystem(spark._jsc.hadoopConfiguration()).delete(named, True)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as ``materialise`` gives it back, removed at the end."""
    path = scratch_path(df.sparkSession, "kept")
    df.write.option("compression", "zstd").parquet(path)
    try:
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        drop_path(df.sparkSession, path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session in here."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """Each job in here removes its shuffle files when it ends, not when the driver collects its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def kept_ahead(spark: SparkSession, made: Iterable[Callable[[], DataFrame]]) -> Iterator[DataFrame]:
    """What each of ``made`` gives, as ``kept`` does; the next one is written while the caller uses this one."""
    def write(make: Callable[[], DataFrame], path: str) -> DataFrame:
        df = make()
        # zstd finds what repeats, so that dictionaries would cost time and save nothing
        df.write.options(**{"compression": "zstd", "parquet.enable.dictionary": "false"}).parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    ahead: list[tuple[Future, str]] = []

    def begin(pool: ThreadPoolExecutor, make: Callable[[], DataFrame]) -> None:
        path = scratch_path(spark, "kept")
        ahead.append((beside(pool, lambda: write(make, path)), path))

    with ThreadPoolExecutor(1) as pool:
        try:
            for make in made:
                begin(pool, make)
                if len(ahead) > 1:
                    yield ahead[0][0].result()
                    drop_path(spark, ahead.pop(0)[1])
            while ahead:
                yield ahead[0][0].result()
                drop_path(spark, ahead.pop(0)[1])
        finally:
            for running, path in ahead:
                wait([running])
                drop_path(spark, path)


def beside(pool: ThreadPoolExecutor, step: Callable) -> Future:
    """Run a step in a thread of the pool, with the settings of this one."""
    return pool.submit(copy_context().run, inheritable_thread_target(SparkSession.active())(step))


def together(*steps: Callable[[], Any]) -> list[Any]:
    """What steps give that do not need each other, run at once, so that the last tasks of one do not leave cores idle."""
    with ThreadPoolExecutor(len(steps)) as pool:
        return [running.result() for running in [beside(pool, step) for step in steps]]


def raise_group_limit(spark: SparkSession, limit: int) -> None:
    """Let filters on the first ``limit`` rows of a group cut groups before they are shuffled."""
    name = "spark.sql.optimizer.windowGroupLimitThreshold"
    if int(spark.conf.get(name)) < limit:
        spark.conf.set(name, str(limit))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
