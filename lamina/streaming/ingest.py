"""Incremental cleaning: new files are cleaned as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lamina.functions import artifacts


def clean_stream(spark: SparkSession, source: str, schema: str, text: str = "text", on: artifacts.Switches = artifacts.Switches(), files_per_trigger: int = 100) -> DataFrame:
    """A streaming DataFrame of Parquet rows with the cleaned text; the chain is
    stateless, so it runs per row."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(source)
    return artifacts.clean(rows, text, "clean_text", on)


def run_available(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Write everything that is there, exactly once, and stop."""
    q = stream.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def run_batches(spark: SparkSession, source: str, schema: str, handle, checkpoint: str) -> None:
    """Give each micro-batch of new rows to ``handle(df, epoch)``, for plans
    that need whole documents such as the extraction."""
    rows = spark.readStream.schema(schema).parquet(source)
    q = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
