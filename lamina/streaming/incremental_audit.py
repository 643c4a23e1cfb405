"""Extension: the audit of key uniqueness as a stream over arriving files.

Each micro-batch is counted by key and appended under its number, so a repeated batch overwrites its own part and
totals stay exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def start(spark: SparkSession, source: str, schema: str, keys: list[str], target: str, checkpoint: str):
    """Read the Parquet files that are there and count their rows by key."""

    def count(batch: DataFrame, number: int) -> None:
        batch.groupBy(*keys).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def repeated_keys(spark: SparkSession, target: str, keys: list[str]) -> DataFrame:
    """Keys that more than one row has so far."""
    return spark.read.parquet(target).groupBy(*keys).agg(F.sum("n").alias("n")).where("n > 1")
