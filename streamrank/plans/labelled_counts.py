"""Hot words over hopping windows and plays per session, with readable keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import window_label, windowed_key_line
from ..operators.windows import hopping_count, session_count
from ..sinks.topics import keyed_longs


def labelled(counts: DataFrame, key: str) -> DataFrame:
    """``label`` (``key@startMs->endMs``) and ``count``."""
    label = window_label(F.col(key), F.col("window.start"), F.col("window.end"))
    return counts.select(label.alias("label"), "count")


def hot_words(
    rows: DataFrame, key: str = "key", width: str = "5 minutes", advance: str = "1 minute",
    ts: str = "timestamp", *, final_only: bool = False,
) -> DataFrame:
    return labelled(hopping_count(rows, [key], width, advance, ts, final_only=final_only), key)


def play_sessions(
    plays: DataFrame, key: str = "key", gap: str = "30 minutes", ts: str = "timestamp"
) -> DataFrame:
    return labelled(session_count(plays, [key], gap, ts), key)


def printed(counts: DataFrame, key: str) -> DataFrame:
    """``line``: each windowed count as ``key>startMs=count``."""
    line = windowed_key_line(F.col(key), F.col("window.start"), F.col("count"))
    return counts.select(line.alias("line"))


def changes_as_topic_records(changes: DataFrame, key: str = "key") -> DataFrame:
    """Every change of a session; one that has become part of another has a null value."""
    label = window_label(F.col(key), F.col("window.start"), F.col("window.end"))
    return keyed_longs(changes, label, F.when(~F.col("replaced"), F.col("count")))


def as_topic_records(labelled_counts: DataFrame) -> DataFrame:
    return keyed_longs(labelled_counts, F.col("label"), F.col("count"))
