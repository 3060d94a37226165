"""Search words per project, counted every 30 seconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.filters import behaviour_events, without_nulls
from ..operators.projections import json_value, search_word_pairs
from ..operators.windows import tumbling_count
from ..sinks.topics import windowed_text

PAIR = ("project", "search_word")


def search_word_counts(
    records: DataFrame, width: str = "30 seconds", ts: str = "timestamp", value: str = "value"
) -> DataFrame:
    """Searches per project, word and window, with JSON ``key`` and ``value``.

    A group holds exactly one word here, so its counted record is also its
    first and no further grouping is needed.
    """
    pairs = search_word_pairs(behaviour_events(records, ["searchProduct"], value), ts)
    counts = tumbling_count(pairs, PAIR, width, ts, null_parts=True)
    records = counts.withColumns({
        "key": json_value(*PAIR), "value": json_value(*PAIR, "count"),
    })
    return without_nulls(records, "key", "value")


def as_topic_records(counts: DataFrame) -> DataFrame:
    return windowed_text(counts, F.col("key"), F.col("value"))
