"""Per-row operators over streams.

Harvesting, validation, chat examples and prompt sizes are row expressions, so the batch functions take
a streaming frame as it is. This module only wires the usual flow: responses in, checked records out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gristmill.operators.validate import harvest_valid


def harvest_stream(
    responses: DataFrame, batch: str, raw: str, fields: dict, out: str, checkpoint: str
) -> StreamingQuery:
    """Append the valid records of all responses that have arrived to a Parquet table, then stop.

    The checkpoint makes every response count exactly once over restarts.
    """
    records = harvest_valid(responses, batch, raw, fields)
    writer = records.writeStream.format("parquet").outputMode("append")
    return writer.option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
