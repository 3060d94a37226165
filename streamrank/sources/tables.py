"""Parquet tables, and the stand-in records the registered queries use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import pin_utc

EVENTS_DDL = (
    "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
)


def with_event_time(events: DataFrame) -> DataFrame:
    """Event time as an instant: streams cannot watermark a zone-less timestamp."""
    return events.withColumn("timestamp", F.col("ts").cast("timestamp")).drop("ts")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_time(pin_utc(spark).read.parquet(f"{sf_dir}/events.parquet"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def as_page_views(events: DataFrame) -> DataFrame:
    """Events as page views, flagged with their type."""
    return events.select(
        F.col("user_id").cast("string").alias("user"),
        F.get_json_object("props", "$.k").alias("page"),
        F.concat(F.lit("i"), (F.col("user_id") % 5).cast("string")).alias("industry"),
        F.col("event_type").alias("flags"),
        "timestamp",
    )


def as_behaviour_json(events: DataFrame) -> DataFrame:
    """Events as JSON messages, some of another type, without data, or malformed.

    The explode of one element gives the message as a finished column, which it
    would be on a topic, so that later filters do not build it again each time.
    """
    subject = F.get_json_object("props", "$.k")
    channel = F.when(F.col("user_id") % 3 != 0, '"channel":"H5",').otherwise("")

    def message(event: str, field: str):
        return F.concat(
            F.lit('{"data":{"project":"p'), (F.col("user_id") % 5).cast("string"),
            F.lit(f'","event":"{event}","properties":{{'), channel,
            F.lit(f'"{field}":"'), subject, F.lit('"}},"ip":"127.0.0.1"}'),
        )

    kind = F.col("event_type")
    value = (
        F.when(kind == "view", message("viewProduct", "product_id"))
        .when(kind == "click", message("searchProduct", "search_word"))
        .when(kind == "purchase", message("buy", "product_id"))
        .when(kind == "signup", F.lit('{"ip":"127.0.0.1"}'))
        .otherwise(F.concat(F.lit("not json "), subject))
    )
    return events.select("event_id", F.explode(F.array(value)).alias("value"), "timestamp")


def as_topic_records(events: DataFrame) -> DataFrame:
    """Events as records of several topics with partitions and offsets."""
    return events.select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("user_id").cast("string").alias("key"),
        F.col("props").alias("value"),
        "timestamp",
    )
