"""Top-up as a stream: new documents arrive as files, each micro-batch is loaded once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.functions.identity import with_defaults
from plumbline.functions.values import envelope, epoch_millis
from plumbline.plans.load import load_chunk
from plumbline.schema import DOCUMENT
from plumbline.sources.live_table import LiveTable


def documents(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """A stream of documents (schema.DOCUMENT); max_files bounds a batch, which is the stream's backpressure."""
    return spark.readStream.schema(DOCUMENT).option("maxFilesPerTrigger", max_files).parquet(path)


def top_up(stream: DataFrame, table: LiveTable, identity: DataFrame, prefix: str, checkpoint: str, bound: Callable[[], int | None] = lambda: None, letters: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Load what has arrived and stop.

    A batch that is run again has the same number, so its staging folder is replaced, and promotion by pairs leaves
    one copy. The bound is read anew for each batch: documents at or after it are left out.
    """

    def load(batch: DataFrame, number: int) -> None:
        docs, limit = with_defaults(batch, identity, prefix), bound()
        if limit is not None:
            cd = epoch_millis(envelope(F.col("cd")))
            docs = docs.filter(cd.isNull() | (cd < limit))
        _, bad = load_chunk(table, docs, f"topup-{number}")
        if letters:
            letters(bad, number)

    return stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def arrivals(stream: DataFrame, late: str = "10 minutes", window: str = "1 minute") -> DataFrame:
    """Documents a window by event time, late ones up to the watermark included: rows (cd timestamp, collection)."""
    return stream.withWatermark("cd", late).groupBy(F.window("cd", window), "collection").count()


def arrivals_to(stream: DataFrame, path: str, checkpoint: str, late: str = "10 minutes", window: str = "1 minute") -> StreamingQuery:
    """Windows that the watermark has closed, appended to Parquet; what is still open stays in the stream's state."""
    closed = arrivals(stream, late, window).select(F.col("window.start").alias("start"), "collection", "count")
    return closed.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
