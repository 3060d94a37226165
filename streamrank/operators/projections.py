"""Row-by-row reshaping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import drop_trailing_empty, split_words

HEADERS = "array<struct<key: string, value: binary>>"


def rekey_views(views: DataFrame, *carry: str) -> DataFrame:
    """One user for all, so that views group by page and industry; flags go null."""
    return views.select(
        F.lit("user").alias("user"), "page", "industry",
        F.lit(None).cast("string").alias("flags"), *carry,
    )


def search_word_pairs(events: DataFrame, *carry: str) -> DataFrame:
    """(project, search word) of parsed search events."""
    return events.select(
        F.col("data.project").alias("project"),
        F.col("data.properties.search_word").alias("search_word"),
        *carry,
    )


def rank_records(events: DataFrame, *carry: str) -> DataFrame:
    """What a parsed event counts towards: its type, subject, project and channel.

    The subject is the searched word or the viewed product, else empty.
    """
    event, properties = F.col("data.event"), F.col("data.properties")
    subject = (
        F.when(event == "searchProduct", properties["search_word"])
        .when(event == "viewProduct", properties["product_id"])
        .otherwise("")
    )
    return events.select(
        event.alias("rank_type"),
        subject.alias("rank_id"),
        F.col("data.project").alias("user_project"),
        properties["channel"].alias("rank_channel"),
        *carry,
    )


def common_rank_rows(counted: DataFrame, now_ms: Column | None = None) -> DataFrame:
    """Counted rank records in the columns of the rank table.

    Key columns may not be null there, so a missing part becomes empty text.
    """
    if now_ms is None:
        now_ms = F.unix_millis(F.current_timestamp())
    return counted.select(
        *[
            F.coalesce(F.col(name), F.lit("")).alias(name)
            for name in ("user_project", "rank_type", "rank_id", "rank_channel")
        ],
        F.lit(None).cast("string").alias("rank_name"),
        F.col("count").alias("rank_value"),
        now_ms.cast("long").alias("update_date"),
    )


def page_stats(counted: DataFrame) -> DataFrame:
    """Counted (page, industry) windows as stats records grouped by industry."""
    return counted.select(
        "industry", "window",
        F.struct(F.lit("user").alias("user"), "page", "industry", "count").alias("stats"),
    )


def lines(documents: DataFrame, text: str = "text") -> DataFrame:
    """One row ``value`` per line of text."""
    return documents.select(F.explode(F.split(text, "\n")).alias("value"))


def words(records: DataFrame, value: str = "value") -> DataFrame:
    """One row ``word`` per word; null lines give none."""
    return records.select(split_words(F.col(value)).alias("pieces")).select(
        F.explode(drop_trailing_empty(F.col("pieces"))).alias("word")
    )


def with_uuid(records: DataFrame) -> DataFrame:
    """Tag each record with a unique id, as a header beside the body.

    Headers the record already has stay. Topics are read and written with the
    column in this shape.
    """
    own = F.array(F.struct(F.lit("uuid").alias("key"), F.encode(F.expr("uuid()"), "UTF-8").alias("value")))
    if "headers" not in records.columns:
        return records.withColumn("headers", own)
    return records.withColumn("headers", F.concat(F.coalesce("headers", F.array().cast(HEADERS)), own))


def header(name: str) -> Column:
    """The text of the last header of that name, null without one."""
    named = F.filter("headers", lambda h: h["key"] == name)
    return F.decode(F.try_element_at(named, F.lit(-1))["value"], "UTF-8")


def json_value(*columns: str) -> Column:
    """JSON text of the columns; null fields are left out."""
    return F.to_json(F.struct(*columns))
