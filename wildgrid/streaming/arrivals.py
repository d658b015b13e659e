"""Files that arrive in a folder, as Parquet."""

from __future__ import annotations

from pyspark.sql import SparkSession


def csv_to_parquet(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, per_trigger: int = 1000, **options) -> None:
    """Every CSV file below ``source`` that the checkpoint hasn't seen goes to ``target`` once; returns when all are done."""
    arrived = spark.readStream.schema(schema).options(header=True, maxFilesPerTrigger=per_trigger, **options).csv(source)
    query = arrived.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)
    query.awaitTermination()
