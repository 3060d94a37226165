"""The jobs from topic to topic.

A job decodes topic records, counts them as a stream, and encodes each
micro-batch of results as topic records. Reading and writing are passed in, so
a job runs the same between topics, files or tests. To run one between topics::

    spark-submit --packages <Kafka connector> --py-files streamrank.zip run_job.py \\
        rank-events --servers host:9092 --source events --target ranks \\
        --checkpoint hdfs:///checkpoints/ranks
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .operators.filters import without_nulls
from .operators.projections import with_uuid
from .plans import labelled_counts, rank_events, search_words, top_pages, word_count
from .schemas import PAGE_VIEW
from .session import stream_session
from .sinks.landing import dated, land_stream
from .sinks.topics import keyed_text, sink_options, write_topic
from .sources.avro import avro_values
from .sources.topics import earliest, topic_stream, typed
from .streaming.keyed import heartbeat, live_hopping_count, live_session_changes
from .streaming.run import Handler, run, watermarked
from .streaming.snapshot import periodic_snapshot

Step = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Job:
    """Jobs that are not ``final_only`` report every change. Those that are report a window
    once, when it has closed, unless their state handlers pass changes on themselves."""

    decode: Step
    result: Step
    encode: Step
    final_only: bool = False
    late: str | None = "1 day"


def text_values(records: DataFrame) -> DataFrame:
    return typed(records)


def keyed_values(value: str) -> Step:
    """Text keys with values of some type; records missing either do not count."""
    return lambda records: without_nulls(typed(records, "string", value), "key", "value")


def jobs(
    late: str = "1 day", width: str | None = None, advance: str = "1 minute", gap: str = "30 minutes",
    marker: str = "ARTICLE", n: int = top_pages.TOP_N, schema_id: int | None = None, idle: str = "1 hour",
) -> dict[str, Job]:
    """The jobs by name, with their parameters; ``width`` is a job's own by default."""
    wide = {"width": width} if width else {}

    def page_views(records: DataFrame) -> DataFrame:
        return avro_values(records, "PageView", PAGE_VIEW, schema_id=schema_id)

    def page_counts(views: DataFrame) -> DataFrame:
        return top_pages.page_counts(views, marker, **wide)

    return {
        "top-pages": Job(
            page_views, page_counts,
            lambda counts: top_pages.as_topic_records(top_pages.top_pages(counts, n)),
            final_only=True, late=late,
        ),
        "top-pages-live": Job(
            page_views, lambda views: top_pages.live_top_pages(views, marker, n, late=late, **wide),
            top_pages.as_topic_records, final_only=True, late=None,
        ),
        "rank-events": Job(
            text_values, lambda rows: rank_events.rank_counts(rows, **wide), rank_events.as_topic_records, late=late),
        "search-words": Job(
            text_values, lambda rows: search_words.search_word_counts(rows, **wide), search_words.as_topic_records,
            late=late),
        "hot-words": Job(
            keyed_values("long"), lambda rows: labelled_counts.hot_words(rows, advance=advance, **wide),
            labelled_counts.as_topic_records, late=late),
        "play-sessions": Job(
            keyed_values("bytes"), lambda rows: labelled_counts.play_sessions(rows, gap=gap),
            labelled_counts.as_topic_records, final_only=True, late=late,
        ),
        "play-sessions-live": Job(
            keyed_values("bytes"), lambda rows: live_session_changes(rows, gap=gap, late=late),
            labelled_counts.changes_as_topic_records, final_only=True, late=None,
        ),
        "hot-words-live": Job(
            keyed_values("long"),
            lambda rows: labelled_counts.labelled(
                live_hopping_count(rows, "key", width or "5 minutes", advance, late), "key"),
            labelled_counts.as_topic_records, final_only=True, late=None,
        ),
        "word-count": Job(text_values, word_count.word_count, word_count.as_topic_records, late=None),
        "heartbeat": Job(
            keyed_values("string"), lambda rows: heartbeat(rows, "key", width or "1 second", idle, late),
            lambda reports: keyed_text(reports, F.col("key"), F.col("value")), final_only=True, late=None,
        ),
        "snapshots": Job(
            keyed_values("string"),
            lambda rows: periodic_snapshot(rows, "key", **({"every": width} if width else {})),
            lambda reports: keyed_text(reports, F.col("key"), F.col("value")),
            final_only=True, late=late,
        ),
    }


JOBS = jobs()


def start_job(
    job: Job,
    records: DataFrame,
    write: Handler,
    *,
    name: str,
    checkpoint: str,
    every: str | None = "10 seconds",
) -> StreamingQuery:
    """Run a job over a stream of topic records, passing encoded results to ``write``."""
    rows = job.decode(records)
    result = job.result(watermarked(rows, job.late) if job.late else rows)

    def send(batch: DataFrame, batch_id: int) -> None:
        write(job.encode(batch), batch_id)

    return run(result, send, name=name, checkpoint=checkpoint, final_only=job.final_only, every=every)


def start_landing(
    records: DataFrame, target: str, checkpoint: str, *, uuid: bool = False, roll: str | None = "30 seconds"
) -> StreamingQuery:
    """Land topic records, with a unique id in their headers if asked for."""
    return land_stream(dated(with_uuid(records) if uuid else records), target, checkpoint, roll)


def start_rank_table(
    records: DataFrame, target: str, checkpoint: str, *, late: str = "1 day", width: str = "1 minute",
    every: str | None = "2 seconds",
) -> StreamingQuery:
    """Add the final counts of each window to the rank table."""
    counts = rank_events.rank_counts(watermarked(text_values(records), late), width)
    return run(
        counts, rank_events.store_rank_counts(target), name="rank-table", checkpoint=checkpoint,
        final_only=True, every=every,
    )


def to_topic(topic: str, servers: str) -> Handler:
    """Handler that writes each micro-batch to a topic."""
    return lambda records, batch_id: write_topic(records, topic, sink_options(servers))


def to_console(rows: int) -> Handler:
    """Handler that prints up to ``rows`` rows of each micro-batch, and how many it leaves out."""
    def show(records: DataFrame, batch_id: int) -> None:
        kept = records.persist()
        try:
            print(f"batch {batch_id}")
            kept.show(rows, truncate=False)
            more = kept.count() - rows
            if more > 0:
                print(f"{more} more rows are not shown")
        finally:
            kept.unpersist()

    return show


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one streaming job between topics.")
    parser.add_argument("job", choices=[*JOBS, "landing", "rank-table"])
    parser.add_argument("--rows", type=int, help="print so many rows of each micro-batch instead of writing them")
    parser.add_argument("--late", default="1 day", help="how late rows may be")
    parser.add_argument("--every", help="time between micro-batches, or between files of landing")
    parser.add_argument("--width", help="width of windows, or time between snapshots; each job has its own")
    parser.add_argument("--advance", default="1 minute", help="time between overlapping windows")
    parser.add_argument("--gap", default="30 minutes", help="silence that ends a session")
    parser.add_argument("--idle", default="1 hour", help="silence after which heartbeat forgets a key")
    parser.add_argument("--marker", default="ARTICLE", help="text in the flags of page views that count")
    parser.add_argument("--n", type=int, default=top_pages.TOP_N, help="length of top lists")
    parser.add_argument("--max-offsets", type=int, help="most records of a micro-batch; no limit by default")
    parser.add_argument("--schema-id", type=int, help="the only schema id that Avro records may carry")
    parser.add_argument("--uuid", action="store_true", help="land records with a unique id in their headers")
    parser.add_argument("--servers", default="localhost:9092")
    parser.add_argument("--source", required=True, help="topics to read, separated by commas")
    parser.add_argument("--target", help="topic to write, or the folder for landing and rank-table")
    parser.add_argument("--checkpoint", required=True, help="folder that all executors share")
    given = parser.parse_args(argv)
    to_folder = given.job in ("landing", "rank-table")
    if to_folder and not given.target:
        parser.error(f"{given.job} needs a folder as --target")
    if not to_folder and not given.target and given.rows is None:
        parser.error("give a topic as --target, or --rows to print some of the results")

    session = stream_session(SparkSession.builder.appName(given.job).getOrCreate())
    options = earliest(given.servers, max_offsets_per_trigger=given.max_offsets)
    records = topic_stream(session, given.source, options, headers=given.uuid)
    if given.job == "landing":
        query = start_landing(
            records, given.target, given.checkpoint, uuid=given.uuid, roll=given.every or "30 seconds")
    elif given.job == "rank-table":
        query = start_rank_table(
            records, given.target, given.checkpoint, late=given.late, width=given.width or "1 minute",
            every=given.every or "2 seconds")
    else:
        job = jobs(
            given.late, given.width, given.advance, given.gap, given.marker, given.n, given.schema_id,
            given.idle)[given.job]
        write = to_topic(given.target, given.servers) if given.target else to_console(given.rows)
        query = start_job(
            job, records, write, name=given.job, checkpoint=given.checkpoint, every=given.every or "10 seconds")
    query.awaitTermination()
