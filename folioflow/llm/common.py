"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Arrow batches between Spark and Python workers have so many bytes at most (or one row), unless the session says otherwise.
BATCH_BYTES, _BATCH_CONF = "8m", "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this library from where the driver imported it, and bound what they hold at once."""
    if spark.conf.get(_BATCH_CONF).rstrip("b") == str(64 << 20):  # the default
        spark.conf.set(_BATCH_CONF, BATCH_BYTES)
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(":"):
        env["PYTHONPATH"] = ":".join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)
    return spark


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Only where that setting is absent and driver and executors are one process (master local, as in tests) a
    temporary folder takes its place; on a cluster its absence is an error.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = getattr(sc, "_folioflow_shared", None)
        if not found:
            found = sc._folioflow_shared = "file://" + tempfile.mkdtemp(prefix="folioflow-")
            sc.setCheckpointDir(found)
    return found.rstrip("/")


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for ``path``."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/folioflow/{name}-{uuid.uuid4().hex}"
    store, where = _hadoop(spark, path)
    store.mkdirs(where.getParent())
    store.deleteOnExit(where)
    return path


#: Rows that one task writes, where their number is known, and the least number of tasks.
ROWS_A_TASK, LEAST_TASKS = 200_000, 8


def stored(df: DataFrame, name: str, rows: int | None = None, **options) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and no lost executor can undo it.

    ``rows``: how many there are at most, if that is known; as many tasks as they are worth then write them. ``options`` are the writer's.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    (df if rows is None else df.coalesce(max(LEAST_TASKS, rows // ROWS_A_TASK))).write.options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folioflow_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote and that nothing will read again."""
    for df in tables:
        path = getattr(df, "_folioflow_path", None)
        if path:
            store, where = _hadoop(df.sparkSession, path)
            store.delete(where, True)


def private(names, *wanted: str) -> list[str]:
    """The ``wanted`` column names, changed so that none is among ``names`` (case ignored)."""
    taken, out = {n.lower() for n in names}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def schema_text(df: DataFrame) -> str:
    """The columns of ``df`` as a schema string."""
    return ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)


def replaced(df: DataFrame, names) -> DataFrame:
    """``df`` without the columns that an operator is about to add (an operator's own columns win)."""
    own = {n.lower() for n in names}
    return df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in own])


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def remainder(key: str, modulus: int):
    """crc32 of the key's decimal text, modulo ``modulus``; a null key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


_CACHES: dict = {}
_OWNER = ""


def claim(owner: str, forget=lambda: None) -> None:
    """Called where an operator starts in a Python worker: what other operators remember there is forgotten.

    Workers outlive stages, and a pipeline's stages would else add up their caches. What is free then goes back to the
    system, as far as the allocators can.
    """
    global _OWNER
    _CACHES.setdefault(owner, forget)
    if owner != _OWNER:
        _OWNER = owner
        for name, other in _CACHES.items():
            if name != owner:
                other()
        gc.collect()
    give_back()


def give_back() -> None:
    """Return free memory of this Python worker to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library is glibc
        ctypes.CDLL(None).malloc_trim(0)


def lean(owner: str, forget=lambda: None):
    """Decorator of a function for mapInArrow: it ``claim``s its worker first and leaves it with no memory to spare."""

    def wrap(run):
        def inner(batches):
            claim(owner, forget)
            try:
                yield from run(batches)
            finally:
                give_back()

        return inner

    return wrap


#: A hot key has at least this many rows and at least 1/HOT_SHARE of all rows.
HOT_ROWS, HOT_SHARE = 256, 4096


def attach_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, spread: str) -> DataFrame:
    """Inner join of ``rows`` with one row per group on ``key``, safe for groups of any size.

    A group is hot from ``max(HOT_ROWS, total / HOT_SHARE)`` rows on, so there are at most HOT_SHARE hot groups:
    that fixed number of rows is broadcast. The rows of hot groups then go through the shuffle join under keys of
    their own (``spread`` deals them out evenly), the rows of all others meet their group there.
    """
    least = max(HOT_ROWS, total // HOT_SHARE)
    extra = [c for c in groups.columns if c != key]
    hk, hot_, ck, cs, cold_, s, g = private([*rows.columns, *groups.columns], "_hk", "_hot", "_ck", "_cs", "_cold", "_s", "_g")
    hot = groups.filter(F.col(size) >= least).select(F.col(key).alias(hk), F.struct(*extra).alias(hot_))
    # least(size, 0) is always 0, but not foldable: it stays a join key, and so the rows of hot groups are dealt out.
    cold = groups.filter(F.col(size) < least).select(F.col(key).alias(ck), F.least(F.col(size), F.lit(0)).cast("long").alias(cs), F.struct(*extra).alias(cold_))
    found = rows.join(F.broadcast(hot), F.col(key) == F.col(hk), "left")
    away = F.pmod(F.xxhash64(F.col(spread)), F.lit(1 << 30)) + F.lit(1)
    found = found.withColumn(s, F.when(F.col(hot_).isNull(), F.lit(0).cast("long")).otherwise(away))
    found = found.join(cold, (F.col(key) == F.col(ck)) & (F.col(s) == F.col(cs)), "left").withColumn(g, F.coalesce(hot_, cold_))
    return found.filter(F.col(g).isNotNull()).select(*[F.col(quoted(c)) for c in rows.columns], *[F.col(g)[c].alias(c) for c in extra])
