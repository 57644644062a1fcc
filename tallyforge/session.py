"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "tallyforge",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings the jobs are planned for.

    ``master`` stays unset on a cluster (spark-submit gives it).
    ``shuffle_partitions`` is the *initial* number for batch work, which adaptive
    execution coalesces; aim at 100-200 MB of shuffle data per partition. For a
    streaming query it is final: state is laid out by it at the first start.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield spark
    finally:
        spark.conf.set(key, old)


def shuffle_partitions(spark: SparkSession, n: int):
    """Run the enclosed actions with ``n`` shuffle partitions, then put the old value back."""
    return _setting(spark, "spark.sql.shuffle.partitions", str(n))


def arrow_rows(spark: SparkSession, n: int):
    """Run the enclosed actions with at most ``n`` rows in each Arrow batch handed to Python,
    then put the old value back. Whole texts are held twice per batch, here and there."""
    return _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(n))


def rocksdb_state(spark: SparkSession):
    """Start the enclosed streams with their state in RocksDB, then put the old value back.
    A running stream keeps what it was started with. Processors with timers and maps need it,
    also in a session that somebody else has built."""
    return _setting(
        spark, "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it gets a folder of its own.
    On a cluster a machine-local folder would be lost with its machine, so a
    missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyforge-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, one per call, so re-runs never mix."""
    return f"{checkpoint_root(spark)}/tallyforge/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the checkpoint folder and read from there.

    Cuts the lineage, and with it the size that Spark estimates for the plan: a table read
    from files has the size of its files. (``DataFrame.checkpoint`` keeps the estimate, and
    joins multiply estimates, so in a loop their digits double from round to round.)

    What was shuffled on the way is read by nothing else and goes from the executors' disks
    with the write, not only when the driver happens to collect its garbage.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "table")
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discarded(table: DataFrame) -> None:
    """Deletes the files of a table made by :func:`checkpointed` that nothing reads any more, in
    loops that write one after another."""
    jvm = table.sparkSession._jvm
    for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
        if "/tallyforge/table-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


@contextmanager
def persisted(df: DataFrame, per_task: int | None = None):
    """``df`` kept in memory and on disk while the enclosed actions pass over it many times.

    Its partitions stay as they are, whatever the number of rows or cores, since what Spark
    draws at random depends on them. With ``per_task`` a pass takes one task for so many rows,
    or one per core if that is more, each over some of the partitions: every task of every pass
    sends its few KB to the driver. Fewer partitions than that stay as they are here too.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rows = kept.count()
        yield kept.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task))) if per_task else kept
    finally:
        kept.unpersist()


def in_parallel(spark: SparkSession, fn: Callable, items: Iterable, threads: int) -> list:
    """Results of ``fn`` for each item, in order. Up to ``threads`` calls submit their jobs at
    a time, so that the short stages of one fill the gaps of another."""
    items = list(items)
    pool = ThreadPool(max(1, min(threads, len(items))))
    try:
        return pool.map(inheritable_thread_target(spark)(fn), items, chunksize=1)
    finally:
        pool.close()
