"""Written intermediates in the folder the cluster shares.

A staged frame is computed once, survives the loss of any executor, is read
back column by column, and has a size the planner knows: whether a join side is
broadcast is then decided on its measured bytes against
``spark.sql.autoBroadcastJoinThreshold``, never on a guess or a hint.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The session's checkpoint folder; a private one only on a local master."""
    context = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="rankloom-"))
        root = context.getCheckpointDir()
    return root.rstrip("/")


def _filesystem(spark: SparkSession, path: str) -> tuple:
    """Hadoop's handle for `path` and the path as it wants it."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def marked(spark: SparkSession, folder: str, root: str, marker: str) -> bool:
    """Whether a file of this name is in `folder` or in one above it, below `root`."""
    filesystem, place = _filesystem(spark, folder)
    top = filesystem.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(root)).toString()
    place = filesystem.makeQualified(place)
    while True:
        if filesystem.exists(spark._jvm.org.apache.hadoop.fs.Path(place, marker)):
            return True
        place = place.getParent()
        if place is None or not place.toString().startswith(top + "/"):
            return False


def read_whole(spark: SparkSession, path: str) -> str:
    """A small text file, from any store Spark reaches."""
    return spark.read.text(path, wholetext=True).first().value


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path of its own for this use, dropped when the driver's JVM ends."""
    path = f"{shared_root(spark)}/{label}-{uuid4().hex}"
    filesystem, hadoop_path = _filesystem(spark, path)
    filesystem.mkdirs(hadoop_path)
    filesystem.deleteOnExit(hadoop_path)
    return path


def _written(df: DataFrame, folder: str, *by: str) -> DataFrame:
    df.write.partitionBy(*by).parquet(f"{folder}/data")
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/data").select(*df.columns)


def stage(df: DataFrame, label: str = "stage", by: str | None = None) -> DataFrame:
    """Write `df` once, partitioned where a column is given, and continue from the written table."""
    return _written(df, fresh_folder(df.sparkSession, label), *([by] if by else []))


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A `stage` whose tables go when the block ends, for jobs that run again and again."""
    folders: list[str] = []

    def keep(df: DataFrame, label: str) -> DataFrame:
        folders.append(fresh_folder(spark, label))
        return _written(df, folders[-1])

    try:
        yield keep
    finally:
        for folder in folders:
            filesystem, hadoop_path = _filesystem(spark, folder)
            filesystem.delete(hadoop_path, True)
