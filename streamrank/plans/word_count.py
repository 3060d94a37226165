"""How often each word occurred so far."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.projections import words
from ..operators.windows import running_count
from ..sinks.topics import keyed_longs


def word_count(records: DataFrame, value: str = "value") -> DataFrame:
    """``word`` and ``count`` over lines of text; a stream keeps every word for good."""
    return running_count(words(records, value), ["word"])


def as_topic_records(counts: DataFrame) -> DataFrame:
    return keyed_longs(counts, F.col("word"), F.col("count"))
