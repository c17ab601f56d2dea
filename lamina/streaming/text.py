"""The text layer and the counts of orphan references as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import blocks as bl
from ..operators import orphans as orp
from ..operators import segments as sg
from ..sources.texts import safe_id, stem


def texts(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """A stream of (doc_id, source_path, text), one row per new file."""
    raw = spark.readStream.format("text").option("wholetext", True).option("pathGlobFilter", pattern).load(folder)
    return raw.select(safe_id(stem(F.url_decode(F.col("_metadata.file_path")))).alias("doc_id"), F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("text"))


def into_tables(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch of texts becomes rows of ``target``/documents, blocks and segments.

    A batch overwrites its own folder, so a batch that is run again after a failure leaves one copy.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        blks = bl.blocks(batch)
        for name, df in (("documents", bl.documents(batch)), ("blocks", blks), ("segments", sg.segments(blks))):
            df.write.mode("overwrite").parquet(f"{target}/{name}/batch={batch_id}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def orphan_changes(changes: DataFrame, table: orp.Table, log: orp.Log, checkpoint: str) -> StreamingQuery:
    """Add the changes of one table to the log of signed counts; the report is ``orphans.failing(log.state(tables))``.

    Every table has a stream of its own. Batch n reads only what is before it, so a batch that runs again gives the same state.
    """
    return changes.writeStream.foreachBatch(lambda batch, n: log.apply(table, batch, n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, key: str, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per window and key, final once the watermark passes."""
    return events.withWatermark(time, late).groupBy(F.window(time, size), key).agg(F.count("*").alias("events"))


def to_memory(df: DataFrame, name: str, mode: str = "append") -> StreamingQuery:
    return df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
