"""Refresh as a file stream: each micro-batch adds only changed pages to the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from venturelens.plans.refresh import refresh_store

PAGES = "company string, source string, file_path string, text string"


def page_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def start_refresh(spark: SparkSession, pages: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Processes what is there and stops. The store's hashes are the state, so none is kept in memory.

    A batch is written under its number, so one replayed after a lost driver replaces itself.
    """

    def add(batch: DataFrame, number: int) -> None:
        refresh_store(batch.sparkSession, batch, store, f"{number:012d}")

    return (
        pages.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
