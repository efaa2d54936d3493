"""The same filters and the same catalogue over streams of files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lakelens.functions.predicates import where
from lakelens.operators.catalog import append_entries


def write_filtered(
    stream: DataFrame, conditions: Iterable | None, target: str, checkpoint: str, columns: list[str] | None = None
) -> StreamingQuery:
    """Appends the matching rows of a stream to a Parquet folder until the input at hand is used up."""
    rows = where(stream, conditions)
    rows = rows.select(*columns) if columns else rows
    writer = rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(target)


def write_catalog(entries: DataFrame, index: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream of catalogue entries to the catalogue.

    A batch replayed after a failure adds the same entries again, which resolve to one per path.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        append_entries(batch, index)

    writer = entries.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
