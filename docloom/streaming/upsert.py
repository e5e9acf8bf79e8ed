"""Keep an index up to date from a stream of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.index import Index


def stream_upserts(docs: DataFrame, index: Index, to_rows: Callable[[DataFrame], DataFrame], checkpoint: str, order: str = "ts") -> StreamingQuery:
    """Start a query that replaces each micro-batch's files in the index, the last version of a file by `order`.

    A batch that is run again after a failure writes the same rows: replacing by file is idempotent.
    """

    def batch(df: DataFrame, _: int) -> None:
        w = Window.partitionBy("filename").orderBy(F.col(order).desc())
        last = df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
        index.upsert(last.select("filename"), to_rows(last))

    return docs.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "1 hour") -> DataFrame:
    """Events by type and hour, closed when the watermark passes."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
