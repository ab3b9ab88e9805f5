"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}
#: The tables that the innermost ``temporary`` block has to delete.
_TEMPORARY: ContextVar[list[DataFrame] | None] = ContextVar("temporary", default=None)
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "pairloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution on; ``conf`` wins over both."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # a join side measured at run time to be small per partition is hashed, not sorted
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names for durable intermediate data.

    Only a local master may fall back to a folder of its own: on a cluster a
    machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="pairloom-")
    return _LOCAL_DIRS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/pairloom/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str, *, partition_by: tuple[str, ...] = (), compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a reader of the table.

    Cuts lineage like a checkpoint, but the result is columnar: readers prune
    columns and partitions and push filters down. The shuffle files of the write are
    deleted when it ends, as nothing reads them again.
    """
    return store_parts([df], name, partition_by=partition_by, compression=compression)


def store_parts(parts: Iterable[DataFrame], name: str, *, partition_by: tuple[str, ...] = (), compression: str | None = None) -> DataFrame:
    """``store`` for a table that is worked out in several parts, written one after another, so that their shuffle files are never there at once."""
    path = None
    for df in parts:
        spark = df.sparkSession
        path = path or new_path(spark, name)
        writer = df.write.mode("append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if compression:
            writer = writer.option("compression", compression)
        before = spark.conf.get(_CLEANUP, None)
        spark.conf.set(_CLEANUP, "true")
        try:
            writer.parquet(path)
        finally:
            spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_path = path
    if (own := _TEMPORARY.get()) is not None:
        own.append(out)
    return out


def release(*tables: DataFrame) -> None:
    """Delete the files of tables that ``store`` wrote, once what was made of them is written itself. Nothing that still has to run may read them."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._stored_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def temporary(*keep: str) -> Iterator[None]:
    """Tables that ``store`` writes inside are deleted at the end, but for those of the names ``keep``, which an outer block deletes. What is
    handed on must be written by then or read from those kept."""
    outer, own = _TEMPORARY.get(), []
    token = _TEMPORARY.set(own)
    try:
        yield
    finally:
        _TEMPORARY.reset(token)
        kept = [t for t in own if t._stored_path.rsplit("/", 1)[1].rsplit("-", 1)[0] in keep]
        release(*[t for t in own if t not in kept])
        if outer is not None:
            outer += kept


def fill_cores(df: DataFrame) -> DataFrame:
    """Cut an input with fewer splits than cores into one part per core.

    A small table in one file would run its whole per-row work in one task. A
    table with enough splits is returned as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
