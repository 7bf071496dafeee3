"""Writing a stream batch by batch so that a repeated batch replaces itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

# Fixed value: the partition column that says which batch wrote a row.
BATCH = "batch_id"


def replace_batch(rows: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """Write a batch's rows as the partition ``batch_id=<number>`` of a table, in place of what an earlier try left."""
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/{BATCH}={batch_id}")


def triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """``None`` handles what is there now and then ends."""
    return writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
