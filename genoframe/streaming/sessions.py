"""Sessions of events, of a table or as they come in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def sessions(events: DataFrame, keys: list[str], at: str = "ts", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """keys, first, last (times without a zone), n: runs of events of the keys of which none lies more than the gap after the one before.

    Of a stream, a session is held as state until the watermark, the latest time seen less `late`, has passed its end by the gap; then it is emitted once and
    its state goes. Events that come later than that are left out; of a table none is late. Events without a time are left out.
    """
    time = F.col(at).cast("timestamp")
    rows = events.where(F.col(at).isNotNull()).select(*keys, time.alias("_at")).withWatermark("_at", late)
    found = rows.groupBy(*keys, F.session_window("_at", gap).alias("_w")).agg(F.min("_at").alias("first"), F.max("_at").alias("last"), F.count("*").alias("n"))
    return found.select(*keys, *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("first", "last")], "n")


def write_sessions(found: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Add the streamed sessions that are over to a Parquet table; a query that starts again on the same checkpoint goes on where it stopped."""
    writer = found.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
