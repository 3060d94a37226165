"""The most viewed pages of every industry and hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.labels import lines_of
from ..operators.filters import flagged_views
from ..operators.projections import rekey_views
from ..operators.ranking import listed, top_n
from ..operators.windows import tumbling_count
from ..sinks.topics import windowed_text
from ..streaming.keyed import live_top
from ..streaming.run import Handler, to_batches

GROUP = ("industry", "window")
TOP_N = 100


def most_viewed() -> list[Column]:
    """Larger counts first; pages with equal counts by name."""
    return [F.desc("count"), F.asc("page")]


def page_counts(
    views: DataFrame, marker: str = "ARTICLE", width: str = "1 hour", ts: str = "timestamp"
) -> DataFrame:
    """Views per page, industry and window; for batches and streams."""
    kept = rekey_views(flagged_views(views, marker), ts)
    return tumbling_count(kept, ["page", "industry"], width, ts, null_parts=True)


def top_pages(counts: DataFrame, n: int = TOP_N) -> DataFrame:
    """``pages``: the names of the first ``n``, one per line, per industry and window.

    Takes page counts as a batch. A stream of final counts closes a window in
    one micro-batch, so there this applies to each micro-batch on its own.
    """
    return listed(top_n(counts, GROUP, most_viewed(), n), GROUP, "page", "pages")


def live_top_pages(
    views: DataFrame, marker: str = "ARTICLE", n: int = TOP_N, width: str = "1 hour", late: str = "1 day",
    ts: str = "timestamp",
) -> DataFrame:
    """``pages`` of the industries and open windows that a micro-batch of a stream changes.

    Views without a page or an industry do not count.
    """
    kept = rekey_views(flagged_views(views, marker), ts)
    lists = live_top(kept, "industry", "page", n, width, late, ts)
    return lists.select(*GROUP, lines_of(F.col("items")).alias("pages"))


def store_top_pages(path: str, n: int = TOP_N) -> Handler:
    """Handler for a stream of final page counts."""
    return to_batches(path, lambda counts: top_pages(counts, n))


def as_topic_records(top: DataFrame) -> DataFrame:
    return windowed_text(top, F.col("industry"), F.col("pages"))
