"""The same masks on a stream: they are stateless, so no watermark is needed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from lakeveil.operators.governed import ColumnAction, govern


def write_governed(
    stream: DataFrame,
    actions: dict[str, ColumnAction],
    path: str,
    checkpoint: str,
    columns: list[str] | None = None,
    unknown: str = "allow",
) -> StreamingQuery:
    """Append the governed view of ``stream`` to Parquet, everything available now.

    The file sink's log and the checkpoint make a restarted run write each row once.
    """
    return (
        govern(stream, actions, columns, unknown)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
