"""Writing of intermediate frames that a plan reads more than once."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
_WAREHOUSE_DIR = "spark.sql.warehouse.dir"
#: Paths that the scopes around the running code will remove, innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("staging_scopes", default=())


def shared_dir(spark: SparkSession) -> str:
    """A folder that all executors share, for intermediate data.

    The folder that the setting ``spark.checkpoint.dir`` or ``setCheckpointDir`` names.
    Without one only a session in a single process goes on, in its warehouse folder;
    on a cluster that could be one machine's own folder, so it is refused.
    """
    named = spark.conf.get(_CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return spark.conf.get(_WAREHOUSE_DIR)
    raise ValueError(f"{_CHECKPOINT_DIR} must name a folder that all executors share")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses; scopes around the call remove it."""
    path = f"{shared_dir(spark).rstrip('/')}/larder/{label}-{uuid.uuid4().hex}"
    for paths in _SCOPES.get()[-1:]:
        paths.append(path)
    return path


def _file_system(spark: SparkSession, path: str) -> tuple:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the frame as Parquet to the shared folder and read it back.

    Runs a job. The result has a short lineage that survives the loss of
    executors, real size statistics, and lets readers prune columns. Its files go
    with ``unstage``, with the ``scope`` around the call, or when the driver's process ends.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    files, hadoop = _file_system(spark, path)
    files.deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def stage_parts(df: DataFrame, label: str, by: str, n: int) -> list[DataFrame]:
    """Stage the frame once, in parts that ``unstage`` removes one by one.

    Part k holds the rows, without the column ``by``, in which that column is k, of 0 .. ``n`` - 1.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.partitionBy(by).parquet(path)
    files, hadoop = _file_system(spark, path)
    files.deleteOnExit(hadoop)
    rest = df.drop(by)

    def part(k: int) -> DataFrame:
        _, folder = _file_system(spark, f"{path}/{by}={k}")
        return spark.read.schema(rest.schema).parquet(f"{path}/{by}={k}") if files.exists(folder) else spark.createDataFrame([], rest.schema)

    return [part(k) for k in range(n)]


def unstage(*frames: DataFrame) -> None:
    """Remove the files of staged frames that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        mine = f"{shared_dir(spark).rstrip('/')}/larder/"
        folders = {file.rpartition("/")[0] for file in df.inputFiles()}
        for folder in folders:
            files, path = _file_system(spark, folder)
            if mine.removeprefix("file://") in f"{path.toUri().getPath()}/":
                files.delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffles of frames that were written out and that nothing refers to any more.

    It does so for what the driver has collected as garbage, and a driver with memory to spare collects
    late; until then the shuffles of all steps lie on the executors' disks.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes at its end, also after an error, everything staged inside.

    Results of plans are lazy and read staged files, so write them inside the scope::

        with scope(spark):
            recipe_pool(tables).write.parquet("...")

    Scopes nest: each removes its own.
    """
    paths: list[str] = []
    token = _SCOPES.set((*_SCOPES.get(), paths))
    try:
        yield
    finally:
        _SCOPES.reset(token)
        for path in paths:
            files, hadoop = _file_system(spark, path)
            files.delete(hadoop, True)
