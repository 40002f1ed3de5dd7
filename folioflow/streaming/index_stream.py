"""An index that grows with a stream of papers, one version a batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioflow.functions import index
from folioflow.sources.lifecycle import exists, prepared_folder

CHUNKS = "paper string, chunk_ix long, text string, gone boolean"


def latest(spark: SparkSession, folder: str) -> index.Index | None:
    """The newest whole version below ``folder``."""
    if not exists(spark, f"{folder}/versions"):
        return None
    number = spark.read.schema("version long").option("recursiveFileLookup", True).json(f"{folder}/versions").agg(F.max("version")).first()[0]
    return index.open_index(spark, f"{folder}/version={number}")


def grow_stream(spark: SparkSession, source: str, folder: str, checkpoint: str, files: int = 1_000) -> StreamingQuery:
    """Start a query over Parquet files of CHUNKS: papers of a batch replace their older selves, rows with ``gone`` take theirs out.

    A batch makes the version of its number from the one before; run again after a failure it replaces what it had
    written. Versions count once their number is recorded, which is the last thing a batch does.
    """

    def grow(batch: DataFrame, number: int) -> None:
        last = None
        if number and exists(spark, f"{folder}/versions/{number - 1}"):
            last = index.open_index(spark, f"{folder}/version={number - 1}")
        where = prepared_folder(spark, f"{folder}/version={number}", clean=True)
        fresh, gone = batch.filter("not coalesce(gone, false)").drop("gone"), batch.filter("gone").select("paper")
        index.grown(last, fresh, gone, where)
        spark.createDataFrame([(number,)], "version long").write.mode("overwrite").json(f"{folder}/versions/{number}")

    rows = spark.readStream.schema(CHUNKS).option("maxFilesPerTrigger", files).parquet(source)
    return rows.writeStream.foreachBatch(grow).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
