"""Running a stream over what is there now, with sinks that scale with the output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomwork.operators.panel import keep_last
from loomwork.session import fresh_path


def file_stream(spark: SparkSession, folder: str, glob: str, schema, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream, as they arrive."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def append_now(stream: DataFrame, path: str | None = None) -> DataFrame:
    """Process all available input in append mode into Parquet; returns the table."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, "stream")
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    query = writer.option("checkpointLocation", fresh_path(spark, "progress")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def upsert_now(stream: DataFrame, keys: Sequence[str], path: str | None = None) -> DataFrame:
    """Process all available input in update mode; of rows with equal keys the one of the last batch counts."""
    spark = stream.sparkSession
    path = path or fresh_path(spark, "stream")

    def store(batch: DataFrame, number: int) -> None:
        # the batch number is part of the folder name, so a repeated batch replaces itself
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = stream.writeStream.outputMode("update").foreachBatch(store)
    query = writer.option("checkpointLocation", fresh_path(spark, "progress")).trigger(availableNow=True).start()
    query.awaitTermination()
    stored = spark.read.parquet(path)
    return keep_last(stored, list(keys), ["batch"]).drop("batch")
