"""Session settings, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from functools import partial
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

T = TypeVar("T")
# Rows a lookup table may have before it is no longer pinned for broadcast.
PIN_ROWS = 100_000
# Bytes of given files for each partition of a shuffle; those that turn out small are put together when it is read.
SHUFFLE_BYTES = 4 << 20
# Tasks a core gets of fits that run at once. A table with more fills the cores and the memory by itself: one fit at a time.
TASKS_PER_CORE = 4
# Bytes that a fit of Spark ML keeps of a row in the executors' storage from pass to pass: its binned point, residuals and predictions.
FIT_ROW_BYTES = 256
_inner_home: ContextVar[str | None] = ContextVar("inner_home", default=None)  # of the ``settled`` step under way


def build_session(app: str = "bidlens", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators assume (UTC, ANSI, AQE with skew splitting)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A temporary folder stands in only for a local master; on a cluster the
    setting has to be there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bidlens-"))
    return spark.conf.get("spark.checkpoint.dir")


def _stage_home(spark: SparkSession) -> str:
    return _inner_home.get() or f"{shared_dir(spark)}/bidlens/{spark.sparkContext.applicationId}"


def stage_path(spark: SparkSession, label: str) -> str:
    return f"{_stage_home(spark)}/{label}-{uuid.uuid4().hex}"


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_stages(spark: SparkSession) -> None:
    """Remove the stages written by this application, once its results are saved."""
    _drop(spark, _stage_home(spark))


def settled(spark: SparkSession, build: Callable[[], DataFrame], label: str = "result") -> DataFrame:
    """The frame that ``build`` returns as a written table; the stages written on the way are removed."""
    target, inner = stage_path(spark, label), stage_path(spark, f"{label}-steps")
    before = _inner_home.set(inner)
    try:
        return cut_lineage(build(), path=target)
    finally:
        _inner_home.reset(before)
        _drop(spark, inner)


def size_shuffles(spark: SparkSession, folder: str) -> None:
    """Cut the session's shuffles finely enough for the files in ``folder``.

    Adaptive execution puts neighbouring partitions together up to its advisory size but cuts none, so with a fixed
    number a task's sorts and hash tables grow with the input.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sum(f.getLen() if f.isFile() else files.getContentSummary(f.getPath()).getLength() for f in files.listStatus(path))
    least, key = int(spark.conf.get("spark.sql.shuffle.partitions")), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if found > least * SHUFFLE_BYTES:
        spark.conf.set(key, str(-(-found // SHUFFLE_BYTES)))
    else:
        spark.conf.unset(key)


@contextmanager
def sorted_groups(spark: SparkSession) -> Iterator[None]:
    """Group rows that lie in order of their keys run by run and at once, in the queries started inside."""
    key = "spark.sql.execution.replaceHashWithSortAgg"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _storage_bytes(spark: SparkSession) -> int:
    """What the executors can keep in memory; with several, the smallest entry is left out, as one is the driver's."""
    status = spark.sparkContext._jsc.sc().getExecutorMemoryStatus().values().iterator()
    sizes = []
    while status.hasNext():
        sizes.append(status.next()._1())
    return sum(sorted(sizes)[1:] or sizes)


def side_by_side(table: DataFrame, jobs: Sequence[Callable[[], T]]) -> list[T]:
    """What ``jobs`` that fit on ``table`` return, in their order.

    As many run at once as leave no core idle, in threads as in Spark ML's cross-validation, and as the executors can
    keep the rows of: fits that push each other's rows out to disk wait for that in every pass.
    """
    spark = table.sparkSession
    at_once = TASKS_PER_CORE * spark.sparkContext.defaultParallelism // max(1, table.rdd.getNumPartitions())
    if min(at_once, len(jobs)) > 1:
        at_once = min(at_once, _storage_bytes(spark) // max(1, FIT_ROW_BYTES * table.count()))
    # Each gets its own copy of the local properties, as queries set theirs in them.
    started = [inheritable_thread_target(spark)(partial(copy_context().run, job)) for job in jobs]
    with ThreadPool(max(1, min(at_once, len(started)))) as pool:
        return pool.map(lambda job: job(), started, chunksize=1)


def cut_lineage(df: DataFrame, label: str = "stage", path: str | None = None, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and continue from the written table.

    Unlike an in-memory copy this survives the loss of executors, and the reader
    keeps column pruning and file-size statistics. Loops pass ``path`` to reuse
    a fixed pair of folders. A filter on column ``by`` reads only the files of its values.
    """
    spark = df.sparkSession
    target = path or stage_path(spark, label)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(target)
    written = spark.read.schema(df.schema).parquet(target)
    return written.select(*df.columns) if by else written


def pin_small(df: DataFrame, max_rows: int = PIN_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast after proving that it has at most ``max_rows`` rows.

    The rows read for the proof become the broadcast table, so the input is
    evaluated once. A larger table comes back unchanged and is joined by shuffle,
    where adaptive execution splits hot keys.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
