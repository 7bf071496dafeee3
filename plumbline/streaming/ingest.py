"""Continuous ingest: payload stream in, minute-partitioned append table out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators.payload import parse_events
from plumbline.session import ensure_checkpoint_dir
from plumbline.sources.log import append_batch
from plumbline.sources.tables import reused
from plumbline.streaming.batches import triggered

# Fixed value: how often the continuous job writes a batch.
TRIGGER_INTERVAL = "15 seconds"
# Rows of a file of the batch sink.
ROWS_PER_FILE = 1_000_000


def spread_minutes(bronze: DataFrame, files_per_minute: int) -> DataFrame:
    """Gather each minute into at most ``files_per_minute`` tasks before it is written.

    Without it every task writes a file for every minute it holds.  The second key deals the
    rows of one minute out, so that a minute holding much of a batch is not one task, be its
    rows copies of each other or not; seeded, a repeated task deals them out alike.  The number
    of tasks is named, because a batch of few bytes may still be many files.
    """
    tasks = int(bronze.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = bronze.withColumn("_turn", F.floor(F.rand(17) * files_per_minute))
    return dealt.repartition(tasks, "event_minute", "_turn").drop("_turn")


def start_ingest(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    *,
    sink_format: str = "parquet",
    interval: str | None = TRIGGER_INTERVAL,
    files_per_minute: int | None = None,
) -> StreamingQuery:
    """Start the append stream; ``interval=None`` handles what is there now and then ends.

    Offsets and the sink's file log live in ``checkpoint`` and ``path``, so a restart neither
    loses nor repeats rows.
    """
    bronze = parse_events(raw)
    if files_per_minute is not None:
        bronze = spread_minutes(bronze, files_per_minute)
    writer = (
        bronze.writeStream.format(sink_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .partitionBy("event_minute")
    )
    if interval is None:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=interval)
    return writer.start(path)


def deal_files(bronze: DataFrame, rows_per_file: int) -> DataFrame:
    """Rows dealt out so that each task writes one file of about ``rows_per_file`` rows, sorted by minute.

    The rows of each minute are counted first.  Neighbouring minutes of few rows share a file; a minute of many has
    several files to itself, over which its rows are dealt whether they are copies of each other or not.
    """
    bronze = bronze.withColumn("_minute", F.coalesce("event_minute", F.lit("")))
    counts = bronze.groupBy("_minute").agg(F.count(F.lit(1)).alias("n"))
    large = F.col("n") > rows_per_file
    line = Window.orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)  # a row per minute of the batch
    before = counts.select(
        "_minute",
        F.when(large, F.ceil(F.col("n") / rows_per_file)).otherwise(0).alias("own"),
        F.coalesce(F.sum(F.when(~large, F.col("n"))).over(line), F.lit(0)).alias("small"),
        F.coalesce(F.sum(F.when(large, F.ceil(F.col("n") / rows_per_file))).over(line), F.lit(0)).alias("taken"),
    )
    # files of small minutes are numbered from 0, those of large ones after them
    shared = F.floor(F.col("small") / rows_per_file)
    placed = before.select("_minute", "own", F.when(F.col("own") == 0, shared).alias("shared"), "taken").checkpoint()
    ends = placed.agg((F.coalesce(F.max("shared"), F.lit(-1)) + 1).alias("shared"), F.coalesce(F.sum("own"), F.lit(0)).alias("own")).first()
    if ends.shared + ends.own == 0:
        return bronze.drop("_minute")
    number = F.when(F.col("own") == 0, F.col("shared")).otherwise(ends.shared + F.col("taken") + F.floor(F.rand(17) * F.col("own")))
    dealt = bronze.join(placed, "_minute").withColumn("_file", number.cast("int"))
    by_file = dealt.repartitionById(int(ends.shared + ends.own), F.col("_file")).sortWithinPartitions("event_minute")
    return by_file.drop("_minute", "own", "shared", "taken", "_file")


def start_batch_ingest(raw: DataFrame, path: str, checkpoint: str, *, interval: str | None = TRIGGER_INTERVAL, rows_per_file: int = ROWS_PER_FILE) -> StreamingQuery:
    """Start the append stream into a table with versions: each batch is one append, under the batch's number.

    A batch that is repeated after a failure replaces what it left, and counts only when it is whole.  Files hold ranges
    of minutes, by which scans skip them; ``start_ingest`` makes a folder per minute instead.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        ensure_checkpoint_dir(batch.sparkSession)
        with reused(parse_events(batch)) as bronze:
            append_batch(deal_files(bronze, rows_per_file), path, batch_id)

    return triggered(raw.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint), interval).start()


def block_on(query: StreamingQuery, timeout_seconds: float | None = None) -> bool:
    """Wait for the stream to end; with a timeout, say whether it did."""
    if timeout_seconds is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(timeout_seconds))
