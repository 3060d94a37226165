"""The plans as finite streams over the event and document files.

Each query streams a whole table through the job, stores the micro-batches and
reads them back. Sources here are files, since a topic needs a broker.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import projections, windows
from ..plans import labelled_counts, rank_events, search_words, top_pages, word_count
from ..session import pin_utc, shared_dir, stream_session
from ..sinks.batches import read_batches
from ..sinks.rank_table import read_rank_table
from ..sources import tables
from ..streaming import run as streaming
from ..streaming.latest import latest
from ..streaming.state import stored_state
from ..streaming.keyed import (
    current_sessions, heartbeat, live_hopping_count, live_lists, live_session_changes, table_changes,
)
from ..streaming.snapshot import periodic_snapshot
from .batch import MARKER, UPDATE_DATE, bounds

DELAY = "1 day"


def session_for(spark: SparkSession) -> SparkSession:
    """These tables are small, and every micro-batch touches each state partition."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return stream_session(spark, min(partitions, 2 * spark.sparkContext.defaultParallelism))


def finish(spark: SparkSession, result: DataFrame, handler: streaming.Handler, name: str, final_only: bool) -> None:
    query = streaming.run(
        result, handler, name=name, checkpoint=streaming.fresh_checkpoint(spark, name),
        final_only=final_only, every=None,
    )
    query.awaitTermination()


def closed_events(spark: SparkSession, sf_dir: str) -> tuple[SparkSession, DataFrame]:
    """Events as a stream that ends by closing every window, and its session."""
    path = f"{sf_dir}/events.parquet"
    session = session_for(spark)
    closing = streaming.closing_event(pin_utc(spark))
    stream = streaming.event_stream(session, path).union(streaming.event_stream(session, closing))
    return session, streaming.watermarked(stream, DELAY)


def finals(
    spark: SparkSession, sf_dir: str, name: str, job: Callable[[DataFrame], DataFrame],
    handler: Callable[[str], streaming.Handler] = streaming.to_batches,
) -> str:
    """Run a job over the closed events, storing final results; gives their path."""
    path = shared_dir(spark, name)
    _, stream = closed_events(spark, sf_dir)
    finish(spark, job(stream), handler(path), name, final_only=True)
    return path


def stream_top_pages(spark, sf_dir):
    path = finals(
        spark, sf_dir, "stream-top-pages",
        lambda events: top_pages.page_counts(tables.as_page_views(events), MARKER),
        top_pages.store_top_pages,
    )
    return bounds(read_batches(spark, path).drop("batch_id"))


def stream_rank_1m(spark, sf_dir):
    path = finals(
        spark, sf_dir, "stream-rank",
        lambda events: rank_events.rank_counts(tables.as_behaviour_json(events)),
    )
    counts = rank_events.with_rank_json(read_batches(spark, path).drop("batch_id"))
    return bounds(counts.withColumnRenamed("count", "rank_value"), end=True)


def stream_search_words(spark, sf_dir):
    path = finals(
        spark, sf_dir, "stream-search-words",
        lambda events: search_words.search_word_counts(tables.as_behaviour_json(events)),
    )
    return bounds(read_batches(spark, path).drop("batch_id"), end=True)


def stream_hot_words(spark, sf_dir):
    path = finals(
        spark, sf_dir, "stream-hot-words",
        lambda events: labelled_counts.hot_words(events, "event_type", final_only=True),
    )
    return read_batches(spark, path).drop("batch_id")


def stream_sessions(spark, sf_dir):
    path = finals(
        spark, sf_dir, "stream-sessions",
        lambda events: labelled_counts.play_sessions(events, "user_id"),
    )
    return read_batches(spark, path).drop("batch_id")


def stream_rank_table(spark, sf_dir):
    path = finals(
        spark, sf_dir, "stream-rank-table",
        lambda events: rank_events.rank_counts(tables.as_behaviour_json(events)),
        lambda path: rank_events.store_rank_counts(path, F.lit(UPDATE_DATE)),
    )
    return read_rank_table(spark, path)


def stream_snapshot(spark, sf_dir):
    path = finals(
        spark, sf_dir, "stream-snapshot", lambda events: periodic_snapshot(events, "event_type")
    )
    return read_batches(spark, path).drop("batch_id")


def in_parts(
    spark: SparkSession, sf_dir: str, name: str, job: Callable[[DataFrame], DataFrame], parts: int = 4,
) -> DataFrame:
    """All that ``job`` has passed on, with its ``batch_id``, while the events came part by part.

    Each part follows the one before it in time. The query stops when it has caught up
    and starts again from its checkpoint for the next one; the last part is an event
    that closes every window.
    """
    rows = pin_utc(spark).read.parquet(f"{sf_dir}/events.parquet")
    source, path = shared_dir(spark, f"{name}-source"), shared_dir(spark, name)
    session, checkpoint = session_for(spark), streaming.fresh_checkpoint(spark, name)
    at = F.floor((F.dayofmonth("ts") - 1) / F.lit(31 // parts + 1))
    given = [rows.where(at == part if part < parts - 1 else at >= part) for part in range(parts)]
    for part in [*given, spark.read.parquet(streaming.closing_event(spark, "2200-01-01"))]:
        part.select(*rows.columns).write.mode("append").parquet(source)
        stream = tables.with_event_time(session.readStream.schema(tables.EVENTS_DDL).parquet(source))
        streaming.run(
            job(stream), streaming.to_batches(path), name=name, checkpoint=checkpoint, final_only=True, every=None,
        ).awaitTermination()
    return read_batches(spark, path)


def stream_top_pages_live(spark, sf_dir):
    """Lists of open hours after every micro-batch; the last one of each is its final list."""
    lists = in_parts(
        spark, sf_dir, "live-pages", lambda events: top_pages.live_top_pages(tables.as_page_views(events.where("user_id >= 0")), MARKER))
    return bounds(latest(lists, top_pages.GROUP))


def stream_sessions_live(spark, sf_dir):
    """Every change of a session over several micro-batches; what stands at the end."""
    changes = in_parts(spark, sf_dir, "live-sessions", lambda events: live_session_changes(events, "user_id"))
    return labelled_counts.labelled(current_sessions(changes.where("user_id >= 0"), ["user_id"]), "user_id")


def stream_hopping_live(spark, sf_dir):
    """Every change of an overlapping window; the last count of each."""
    changes = in_parts(
        spark, sf_dir, "live-hopping",
        lambda events: live_hopping_count(events.where("user_id >= 0"), "event_type", "5 minutes", "1 minute"))
    return labelled_counts.labelled(latest(changes, ["event_type", "window"]), "event_type")


def stream_heartbeat(spark, sf_dir):
    """The total of every live user at every hour, until six hours after the last event."""
    reports = in_parts(
        spark, sf_dir, "heartbeat", lambda events: heartbeat(events, "user_id", "1 hour", "6 hours"))
    return reports.where("key <> '-1'").select("key", "tick_ms", "value")


def stream_regrouped_lists(spark, sf_dir):
    """Users by the type of their newest event, the busiest 20 of each; users change their group."""
    def job(events: DataFrame) -> DataFrame:
        updates = events.where("user_id >= 0").select(
            "user_id", F.unix_micros("timestamp").alias("at"), F.col("event_id").alias("tie"),
            F.col("event_type").alias("grp"), F.lit(1).cast("long").alias("amount"))
        changes = table_changes(updates, "user_id").withColumn("slot", F.lit(0).cast("long"))
        return live_lists(changes, 20)

    lists = latest(in_parts(spark, sf_dir, "regrouped-lists", job), ["grp"])
    return lists.select(
        "grp", F.array_join("items", ",").alias("users"),
        F.array_join(F.transform("amounts", lambda a: a.cast("string")), ",").alias("amounts"))


def stream_changes(spark, sf_dir):
    """Counts in update mode: every change is stored, the last per key is the table."""
    path = shared_dir(spark, "stream-changes")
    session = session_for(spark)
    stream = streaming.watermarked(
        streaming.event_stream(session, f"{sf_dir}/events.parquet"), DELAY
    )
    counts = windows.tumbling_count(stream, ["event_type"], "1 hour")
    finish(spark, counts, streaming.to_batches(path), "stream-changes", final_only=False)
    return bounds(latest(read_batches(spark, path), ["event_type", "window"]), end=True)


def stored_window_counts(spark, sf_dir):
    """The windowed counts as they lie in a stream's state, read from its checkpoint."""
    session, checkpoint = session_for(spark), streaming.fresh_checkpoint(spark, "stored-counts")
    stream = streaming.watermarked(streaming.event_stream(session, f"{sf_dir}/events.parquet"), "100 days")
    counts = windows.tumbling_count(stream, ["event_type"], "1 hour")
    streaming.run(
        counts, lambda rows, batch_id: rows.write.format("noop").mode("overwrite").save(), name="stored-counts", checkpoint=checkpoint, final_only=False, every=None,
    ).awaitTermination()
    return bounds(stored_state(spark, checkpoint).select("event_type", "window", "count"), end=True)


def stream_word_count(spark, sf_dir):
    path = shared_dir(spark, "stream-words")
    session = session_for(spark)
    documents = streaming.table_stream(session, f"{sf_dir}/documents.parquet", "text string")
    counts = word_count.word_count(projections.lines(documents))
    finish(spark, counts, streaming.to_batches(path), "stream-words", final_only=False)
    return latest(read_batches(spark, path), ["word"])


def batched_commit_scan(spark, sf_dir):
    """Each batch is processed before it counts as consumed."""
    path = shared_dir(spark, "commit-scan")
    session = session_for(spark)
    records = tables.as_behaviour_json(
        streaming.event_stream(session, f"{sf_dir}/events.parquet")
    )
    finish(spark, records, streaming.to_batches(path), "commit-scan", final_only=True)
    return read_batches(spark, path).select("event_id", "value")


STREAMED = {
    "batched_commit_scan": batched_commit_scan,
    "stream_tumbling_count_1h": stream_changes,
    "stream_top_pages_per_industry_hour": stream_top_pages,
    "stream_rank_1m": stream_rank_1m,
    "stream_search_word_rank_30s": stream_search_words,
    "stream_hopping_count_labelled": stream_hot_words,
    "stream_session_count_labelled": stream_sessions,
    "stream_word_count": stream_word_count,
    "stream_state_snapshot": stream_snapshot,
    "stream_rank_table": stream_rank_table,
    "stream_top_pages_live": stream_top_pages_live,
    "stream_sessions_live": stream_sessions_live,
    "stream_hopping_live": stream_hopping_live,
    "stream_heartbeat": stream_heartbeat,
    "stored_window_counts": stored_window_counts,
    "stream_regrouped_lists": stream_regrouped_lists,
}
