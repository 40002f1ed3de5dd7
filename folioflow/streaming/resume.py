"""Incremental analysis: items arrive as files, each micro-batch is analysed and appended, a checkpoint replaces markers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def analyse_stream(spark: SparkSession, source: str, schema, work: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str) -> StreamingQuery:
    """Start a query over Parquet files in ``source``; ``work`` maps a batch of items to results, appended to ``sink``.

    A batch that is run again after a failure is written under the same batch number and replaces itself.
    """

    def store(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{sink}/batch={number}")

    items = spark.readStream.schema(schema).parquet(source)
    return items.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
