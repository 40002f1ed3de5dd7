"""Folders of a run: whether they are there, emptied before a run, and PDFs that aren't kept."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library from where the driver did."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    return spark


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _hadoop(spark, path)
    return store.exists(where)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which driver and executors share, deleted when the driver ends.

    Only a local master, whose executors are the driver, may do without that setting.
    """
    sc = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = getattr(sc, "_folioflow_scratch", None)
        if not shared:
            shared = sc._folioflow_scratch = "file://" + tempfile.mkdtemp(prefix="folioflow-")
    path = f"{shared.rstrip('/')}/folioflow/{name}-{uuid.uuid4().hex}"
    store, where = _hadoop(spark, path)
    store.mkdirs(where.getParent())
    store.deleteOnExit(where)
    return path


#: Bytes of a source that a bucket of ``bucketed`` stands for, and the least number of buckets.
BUCKET_BYTES, LEAST_BUCKETS = 4 << 20, 8


def buckets_of(spark: SparkSession, path: str) -> int:
    """How many buckets the rows of the file or folder ``path`` are worth."""
    return max(LEAST_BUCKETS, -(-signature(spark, path)[1] // BUCKET_BYTES))


def bucketed(df: DataFrame, name: str, buckets: int, key: str) -> DataFrame:
    """``df``, which lies in ``buckets`` partitions by ``key``, stored: windows and groups of a key's rows, and joins with them, move none of them."""
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    path = scratch(spark, name)
    df.write.bucketBy(buckets, key).option("path", path).format("parquet").saveAsTable(table)
    out = spark.table(table)
    out._folioflow_table = table, path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of ``bucketed`` that nothing will read again."""
    table, path = df._folioflow_table
    df.sparkSession.sql(f"DROP TABLE {table}")
    store, where = _hadoop(df.sparkSession, path)
    store.delete(where, True)


def signature(spark: SparkSession, path: str) -> tuple:
    """What tells one state of a file or folder from another: path, bytes, files and time."""
    store, where = _hadoop(spark, path)
    held = store.getContentSummary(where)
    return path, held.getLength(), held.getFileCount(), store.getFileStatus(where).getModificationTime()


def prepared_folder(spark: SparkSession, folder: str, clean: bool = False) -> str:
    """``folder``, made if it isn't there; with ``clean`` what it held is deleted first."""
    store, where = _hadoop(spark, folder)
    if clean:
        store.delete(where, True)
    store.mkdirs(where)
    return folder


def without_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """(path, gone): the files of ``paths`` are deleted by the tasks that hold their names; one that isn't there is not gone."""
    name = paths.select(F.col(path).cast("string").alias("path"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            gone = []
            for uri in frame["path"]:
                store, where = fs.FileSystem.from_uri(uri)
                try:
                    store.delete_file(where)
                    gone.append(True)
                except FileNotFoundError:
                    gone.append(False)
            yield frame.assign(gone=gone)

    return name.mapInPandas(run, "path string, gone boolean")


def without_pdfs(spark: SparkSession, paths: Iterable[str], keep: bool = False) -> int:
    """Delete PDFs that a finished batch no longer needs, unless they are to be kept; how many are gone."""
    gone = 0
    for path in () if keep else paths:
        store, where = _hadoop(spark, path)
        gone += bool(store.delete(where, False))
    return gone


def write_summary(summary: DataFrame, folder: str) -> None:
    """The run's summary, a row a paper, as one JSON file that replaces the one before."""
    summary.repartition(1).write.mode("overwrite").json(folder)
