"""Searches and product views per minute, and their accumulation in the rank table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.filters import behaviour_events
from ..operators.projections import common_rank_rows, json_value, rank_records
from ..operators.windows import tumbling_count
from ..sinks.rank_table import add_counts
from ..sinks.topics import windowed_text
from ..streaming.run import Handler

RANKED_EVENTS = ("searchProduct", "viewProduct")
RECORD = ("rank_type", "rank_id", "user_project", "rank_channel")


def rank_counts(
    records: DataFrame, width: str = "1 minute", ts: str = "timestamp", value: str = "value"
) -> DataFrame:
    """Events per rank record and window, from JSON messages."""
    events = rank_records(behaviour_events(records, RANKED_EVENTS, value), ts)
    return tumbling_count(events, RECORD, width, ts, null_parts=True)


def with_rank_json(counts: DataFrame) -> DataFrame:
    """``key``: the record as JSON; ``value``: the same with its ``rank_value``."""
    return counts.withColumns({
        "key": json_value(*RECORD),
        "value": F.to_json(F.struct(*RECORD, F.col("count").alias("rank_value"))),
    })


def as_topic_records(counts: DataFrame) -> DataFrame:
    return windowed_text(with_rank_json(counts), F.col("key"), F.col("value"))


def store_rank_counts(path: str, now_ms: Column | None = None) -> Handler:
    """Handler for a stream of final rank counts: add them to the rank table."""

    def handler(counts: DataFrame, batch_id: int) -> None:
        add_counts(common_rank_rows(counts, now_ms), batch_id, path)

    return handler
