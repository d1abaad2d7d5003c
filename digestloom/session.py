"""Session, scratch folder and input balance."""

from __future__ import annotations

import functools
import gc
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "digestloom", **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the submitter's session is used."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        # Plans are read whole by tests; names grow longer with every expression of a session.
        .config("spark.sql.maxMetadataStringLength", "1000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="digestloom-")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the folder all executors share.

    Only a local session without that setting gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch_released(spark: SparkSession) -> Iterator[None]:
    """Remove what ``materialise`` writes inside the block, once the block has ended well.

    Nothing lazy that reads it may leave the block. After a failure the folders stay, for a
    look at them.
    """
    mark = _scratch.set([])
    try:
        yield
        for path in _scratch.get():
            _remove(spark, path)
        free_shuffles(spark)
    finally:
        _scratch.reset(mark)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the values are fixed from here on."""
    spark = df.sparkSession
    path = work_dir(spark, name)
    if _scratch.get() is not None:
        _scratch.get().append(path)
    df.write.mode("errorifexists").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    written.scratch_path = path
    return written


def release(written: DataFrame) -> None:
    """Remove what ``materialise`` wrote for this table; nothing may read it any more."""
    _remove(written.sparkSession, written.scratch_path)
    free_shuffles(written.sparkSession)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of tables that nothing refers to any more.

    It does so when the driver collects its garbage, which may be long after a large step.
    """
    gc.collect()
    spark._jvm.System.gc()


def _remove(spark: SparkSession, path: str) -> None:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


# Narrow rows of one shuffle that a task sorts: some 100 MB.
TASK_ROWS = 1 << 20


@contextmanager
def shuffled_by_size(spark: SparkSession, rows: int, task_rows: int | None = None) -> Iterator[None]:
    """Shuffle what runs inside the block in as many parts as ``rows`` need, at least the session's own number.

    Nothing lazy may leave the block: write results down inside it.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), -(-rows // (task_rows or TASK_ROWS)))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def balanced(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan that arrives in too few partitions to occupy the cluster.

    Row-local work has no shuffle of its own, so one small file would keep one core busy.
    Inputs with enough splits, which is every large one, are left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= 2 * cores:
        return df
    return df.repartition(4 * cores, key)


_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@functools.cache
def _zipped() -> str:
    path = os.path.join(tempfile.mkdtemp(prefix="digestloom-"), "digestloom.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in os.walk(os.path.join(_ROOT, "digestloom")):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, _ROOT))
    return path


_shipped = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, whose Python need not have it; once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        context.addPyFile(_zipped())
        _shipped.add(context.applicationId)
