"""Starting streaming queries."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import shared_dir
from ..sinks.batches import write_batch
from ..sources.tables import EVENTS_DDL, with_event_time

Handler = Callable[[DataFrame, int], None]


def watermarked(rows: DataFrame, late: str = "1 day", ts: str = "timestamp") -> DataFrame:
    """Accept rows up to ``late`` behind the newest one."""
    return rows.withWatermark(ts, late)


def run(
    result: DataFrame,
    handler: Handler,
    *,
    name: str,
    checkpoint: str,
    final_only: bool,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Pass each micro-batch of results to ``handler(rows, batch_id)``.

    ``final_only`` waits for a window to close and passes its result once, all
    keys of the window in one batch. Otherwise every batch passes the current
    value of what changed in it. Input counts as consumed only after the handler
    returned, and a batch is passed again, under its number, after a failure.
    Batches start ``every`` so often, or, with ``"0 seconds"``, whenever there is
    input. Without ``every`` the query stops when it has caught up.
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        result.writeStream.queryName(name)
        .outputMode("append" if final_only else "update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .foreachBatch(handler)
        .start()
    )


def to_batches(path: str, reshape: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Handler:
    """Handler that stores each reshaped micro-batch under its number."""
    return lambda rows, batch_id: write_batch(reshape(rows), batch_id, path)


def fresh_checkpoint(spark: SparkSession, name: str) -> str:
    """A new checkpoint folder: the query starts over with empty state."""
    return shared_dir(spark, f"checkpoint-{name}")


def table_stream(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """A parquet table, one file or a folder of files, as a stream.

    A plain path has to be a folder, so it is given as a pattern that only it
    matches.
    """
    *parents, name = path.rstrip("/").split("/")
    plain = next(i for i, c in enumerate(name) if c.isalnum())
    marked = [re.sub(r"([*?\[\]{}\\])", r"\\\1", part) for part in ("/".join(parents), name[:plain], name[plain + 1:])]
    return spark.readStream.schema(ddl).parquet(f"{marked[0]}/{marked[1]}[{name[plain]}]{marked[2]}")


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """Events as a stream."""
    return with_event_time(table_stream(spark, path, EVENTS_DDL))


def closing_event(spark: SparkSession, at: str = "9000-01-01") -> str:
    """Write one event in the far future, so a finite stream closes all windows.

    The watermark only moves on newer events that pass a job's filters; this one
    moves it past the end. Its own window stays open and gives no result. Use it
    only for a stream that is not to go on from its checkpoint.
    """
    path = shared_dir(spark, "closing-event")
    spark.range(1, numPartitions=1).select(
        F.lit(-1).cast("long").alias("event_id"),
        F.lit(at).cast("timestamp_ntz").alias("ts"),
        F.lit(-1).cast("long").alias("user_id"),
        F.lit("click").alias("event_type"),
        F.lit(0.0).alias("value"),
        F.lit('{"k": -1}').alias("props"),
    ).write.parquet(path)
    return path
