"""The shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


@functools.cache
def _local_dir() -> str:
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session that names none, where driver and tasks share one machine, uses a temporary folder, which
    goes when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_dir()


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def written_to(df: DataFrame, name: str) -> tuple[str, DataFrame]:
    """The path and the table written to the shared folder and read back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return path, df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read back: later passes neither recompute nor depend on executors."""
    return written_to(df, name)[1]


def release(spark: SparkSession) -> int:
    """Delete every intermediate table this process has made, once results that read them are written elsewhere."""
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    gone = 0
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        gone += bool(path.getFileSystem(conf).delete(path, True))
    return gone
