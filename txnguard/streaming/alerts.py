"""Live alert feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from txnguard.operators.features import alert_json


def alert_stream(scored: DataFrame, *keys: str) -> DataFrame:
    """Alerts of a scored stream as JSON in ``value``; stateless, append mode."""
    return alert_json(scored, *keys)


def start_append(
    stream: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", every: str | None = None
) -> StreamingQuery:
    """Append a stream to files exactly once (the sink logs committed batches)."""
    writer = stream.writeStream.outputMode("append").format(fmt).option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
