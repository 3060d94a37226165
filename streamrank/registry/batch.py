"""Queries that run as plain batch DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.wire import bytes_to_windowed_key
from ..operators import changelog, filters, offsets, projections, ranking, windows
from ..plans import labelled_counts, rank_events, search_words, state_snapshot, top_pages, word_count
from ..schemas import PAGE_VIEW
from ..sinks import landing
from ..sinks.topics import keyed_longs
from ..sources import tables
from ..sources.topics import subscribed, typed

# The marker the stand-in views carry: part of the types "click" and "purchase".
MARKER = "c"
# Fixed so that results can be compared; users leave it to the clock.
UPDATE_DATE = 1_706_745_600_000


def bounds(rows: DataFrame, end: bool = False) -> DataFrame:
    """Window bounds as plain numbers, in epoch milliseconds."""
    rows = rows.withColumn("window_start", F.unix_millis("window.start"))
    if end:
        rows = rows.withColumn("window_end", F.unix_millis("window.end"))
    return rows.drop("window")


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.as_page_views(tables.events(spark, sf_dir))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.as_behaviour_json(tables.events(spark, sf_dir))


def page_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_pages.page_counts(page_views(spark, sf_dir), MARKER)


def micros_of(column: str = "timestamp") -> Column:
    return F.unix_micros(column).alias("ts_us")


def source_typed_kv(spark, sf_dir):
    sent = keyed_longs(tables.events(spark, sf_dir), F.col("event_type"), F.col("event_id") - 5000)
    return typed(sent, "string", "long")


def source_pageviews(spark, sf_dir):
    views = page_views(spark, sf_dir)
    return views.select(*PAGE_VIEW.fieldNames(), micros_of())


SUBSCRIBED = ("click", "purchase", "view")


def multi_topic_scan(spark, sf_dir):
    records = tables.as_topic_records(tables.events(spark, sf_dir))
    return subscribed(records, SUBSCRIBED).select(
        "topic", "partition", "offset", "key", "value", micros_of()
    )


def next_offset_per_partition(spark, sf_dir):
    return offsets.next_offsets(tables.as_topic_records(tables.events(spark, sf_dir)))


def filter_article_views(spark, sf_dir):
    kept = filters.flagged_views(page_views(spark, sf_dir), MARKER)
    return kept.select(*PAGE_VIEW.fieldNames(), micros_of())


def rekey_article_views(spark, sf_dir):
    kept = filters.flagged_views(page_views(spark, sf_dir), MARKER)
    return projections.rekey_views(kept)


def json_shape_guard(spark, sf_dir):
    records = messages(spark, sf_dir)
    return records.filter(filters.json_shaped(F.col("value"))).select("event_id", "value")


def json_event_search_only(spark, sf_dir):
    kept = filters.behaviour_events(messages(spark, sf_dir), ["searchProduct"])
    return kept.select("event_id", F.col("data.event").alias("event"))


def json_event_rank_types(spark, sf_dir):
    kept = filters.behaviour_events(messages(spark, sf_dir), rank_events.RANKED_EVENTS)
    return kept.select("event_id", F.col("data.event").alias("event"))


def search_word_projection(spark, sf_dir):
    kept = filters.behaviour_events(messages(spark, sf_dir), ["searchProduct"])
    return projections.search_word_pairs(kept, "event_id")


def rank_record_projection(spark, sf_dir):
    kept = filters.behaviour_events(messages(spark, sf_dir), rank_events.RANKED_EVENTS)
    return projections.rank_records(kept, "event_id")


def table_filter_not_null(spark, sf_dir):
    records = rank_record_projection(spark, sf_dir)
    return filters.without_nulls(records, "rank_id", "rank_channel")


def tumbling(width: str):
    def query(spark, sf_dir):
        events = tables.events(spark, sf_dir)
        return bounds(windows.tumbling_count(events, ["event_type"], width), end=True)

    return query


def hopping_count_labelled(spark, sf_dir):
    return labelled_counts.hot_words(tables.events(spark, sf_dir), "event_type")


def session_count_labelled(spark, sf_dir):
    return labelled_counts.play_sessions(tables.events(spark, sf_dir), "user_id")


def windowed_key_print(spark, sf_dir):
    counts = windows.tumbling_count(tables.events(spark, sf_dir), ["event_type"], "1 hour")
    return labelled_counts.printed(counts, "event_type")


def stats_selector(spark, sf_dir):
    stats = projections.page_stats(page_counts(spark, sf_dir))
    return bounds(stats.select(
        F.col("industry").alias("group_key"), "window", F.col("stats.user").alias("user"),
        F.col("stats.page").alias("page"), F.col("stats.industry").alias("industry"),
        F.col("stats.count").alias("count"),
    ))


def page_count_changes(spark, sf_dir):
    views = filters.flagged_views(page_views(spark, sf_dir), MARKER)
    return changelog.count_changelog(
        views, ["page", "industry"], "1 hour", "10 seconds", null_parts=True
    )


def count_changelog(spark, sf_dir):
    changes = bounds(page_count_changes(spark, sf_dir))
    return changes.withColumn("committed", F.unix_millis("committed"))


def retractable_collect(spark, sf_dir):
    """The collection of a group's pages, each with its rank; changes of counts just replace them."""
    return bounds(ranking.standings(page_counts(spark, sf_dir), top_pages.GROUP))


def take_first_per_group(spark, sf_dir):
    first = ranking.first_in_group(
        page_counts(spark, sf_dir), top_pages.GROUP, [-F.col("count"), F.col("page")],
        F.struct("page", "count"),
    )
    return bounds(first.select("industry", "window", "first.page", "first.count"))


def top_pages_per_industry_hour(spark, sf_dir):
    return bounds(top_pages.top_pages(page_counts(spark, sf_dir)))


def topic_windowed_text(spark, sf_dir):
    sent = top_pages.as_topic_records(top_pages.top_pages(page_counts(spark, sf_dir)))
    industry, start = bytes_to_windowed_key(F.col("key"))
    return sent.select(
        F.hex("key").alias("key_hex"), industry.alias("industry"), start.alias("window_start"),
        F.decode("value", "UTF-8").alias("pages"),
    )


def topic_keyed_longs(spark, sf_dir):
    sent = labelled_counts.as_topic_records(session_count_labelled(spark, sf_dir))
    return sent.select(F.decode("key", "UTF-8").alias("key"), F.hex("value").alias("value_hex"))


def rank_stream_1m(spark, sf_dir):
    counts = rank_events.with_rank_json(rank_events.rank_counts(messages(spark, sf_dir)))
    return bounds(counts.withColumnRenamed("count", "rank_value"), end=True)


def search_word_rank_30s(spark, sf_dir):
    return bounds(search_words.search_word_counts(messages(spark, sf_dir)), end=True)


def tokenize_lines(spark, sf_dir):
    return projections.words(projections.lines(tables.documents(spark, sf_dir)))


def word_counts(spark, sf_dir):
    return word_count.word_count(projections.lines(tables.documents(spark, sf_dir)))


def snapshot(spark, sf_dir):
    return state_snapshot.state_snapshot(tables.events(spark, sf_dir), "event_type")


def common_rank_rows(spark, sf_dir):
    counts = rank_events.rank_counts(messages(spark, sf_dir))
    return projections.common_rank_rows(counts, F.lit(UPDATE_DATE))


def halves(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records before and from the middle of the month: two deliveries."""
    noon = F.to_timestamp(F.lit("2024-01-16 12:00:00"))
    return records.filter(F.col("timestamp") < noon), records.filter(F.col("timestamp") >= noon)


def landing_rows(spark, sf_dir):
    records = tables.as_topic_records(tables.events(spark, sf_dir))
    return landing.dated(records, F.col("timestamp"))


def uuid_header(spark, sf_dir):
    """Every record has an id of full length; ``landing_with_uuid`` counts that they differ."""
    tagged = projections.with_uuid(messages(spark, sf_dir)).withColumn("uuid", projections.header("uuid"))
    return tagged.agg(
        F.count("*").alias("records"), F.count("uuid").alias("ids"),
        F.min(F.length("uuid")).alias("shortest"), F.max(F.length("uuid")).alias("longest"),
    )


BATCH = {
    "source_typed_kv": source_typed_kv,
    "source_pageviews": source_pageviews,
    "multi_topic_scan": multi_topic_scan,
    "next_offset_per_partition": next_offset_per_partition,
    "filter_article_views": filter_article_views,
    "rekey_article_views": rekey_article_views,
    "json_shape_guard": json_shape_guard,
    "json_event_search_only": json_event_search_only,
    "json_event_rank_types": json_event_rank_types,
    "search_word_projection": search_word_projection,
    "rank_record_projection": rank_record_projection,
    "table_filter_not_null": table_filter_not_null,
    "tumbling_count_1h": tumbling("1 hour"),
    "tumbling_count_1m": tumbling("1 minute"),
    "tumbling_count_30s": tumbling("30 seconds"),
    "hopping_count_labelled": hopping_count_labelled,
    "session_count_labelled": session_count_labelled,
    "windowed_key_print": windowed_key_print,
    "stats_selector": stats_selector,
    "count_changelog_10s": count_changelog,
    "retractable_collect": retractable_collect,
    "take_first_per_group": take_first_per_group,
    "top_pages_per_industry_hour": top_pages_per_industry_hour,
    "topic_windowed_text": topic_windowed_text,
    "topic_keyed_longs": topic_keyed_longs,
    "rank_stream_1m": rank_stream_1m,
    "search_word_rank_30s": search_word_rank_30s,
    "tokenize_lines": tokenize_lines,
    "word_count": word_counts,
    "state_snapshot": snapshot,
    "common_rank_rows": common_rank_rows,
    "landing_rows": landing_rows,
    "uuid_header": uuid_header,
}
