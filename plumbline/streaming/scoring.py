"""Continuous scoring: requests in; predictions and rejected requests out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from plumbline.sources.tables import reused
from plumbline.streaming.batches import replace_batch, triggered


def start_scoring(
    requests: DataFrame,
    parts: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    output: str,
    rejected: str,
    checkpoint: str,
    interval: str | None,
) -> StreamingQuery:
    """Start the stream; ``parts`` gives a batch's predictions and what could not be scored.

    Both are written under the batch's number, so a batch that is repeated after a failure replaces what it left.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        with reused(batch) as held:
            good, bad = parts(held)
            replace_batch(good, output, batch_id)
            replace_batch(bad, rejected, batch_id)

    return triggered(requests.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint), interval).start()
