"""Writing keyed records to topics."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.wire import long_to_bytes, windowed_key_to_bytes


def sink_options(
    servers: str = "localhost:9092",
    *,
    acks: str = "all",
    retries: int | None = None,
    batch_size: int = 16384,
    linger_ms: int = 1,
    buffer_memory: int = 33554432,
    override: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a topic writer. A non-empty ``override`` replaces all of them.

    Without ``retries`` the client goes on for as long as its delivery timeout
    allows, so that a moved partition leader does not fail the query.
    """
    if override:
        return dict(override)
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": acks,
        **({} if retries is None else {"kafka.retries": str(retries)}),
        "kafka.batch.size": str(batch_size),
        "kafka.linger.ms": str(linger_ms),
        "kafka.buffer.memory": str(buffer_memory),
    }


def keyed_longs(rows: DataFrame, key: Column, value: Column) -> DataFrame:
    """Text keys with long values, as bytes."""
    return rows.select(
        F.encode(key, "UTF-8").alias("key"), long_to_bytes(value.cast("long")).alias("value")
    )


def keyed_text(rows: DataFrame, key: Column, value: Column) -> DataFrame:
    """Text keys with text values, as bytes."""
    return rows.select(
        F.encode(key, "UTF-8").alias("key"), F.encode(value, "UTF-8").alias("value")
    )


def windowed_text(rows: DataFrame, key: Column, value: Column, window: str = "window") -> DataFrame:
    """Keys tied to a time window with text values, as bytes."""
    start_ms = F.unix_millis(F.col(f"{window}.start"))
    return rows.select(
        windowed_key_to_bytes(key, start_ms).alias("key"),
        F.encode(value, "UTF-8").alias("value"),
    )


def write_topic(records: DataFrame, topic: str, options: Mapping[str, str]) -> None:
    """Write ``key``/``value`` bytes in bulk; needs the Kafka connector package.

    A ``headers`` column, as ``with_uuid`` makes it, is written along.
    """
    with_headers = str("headers" in records.columns).lower()
    (
        records.write.format("kafka").options(**options)
        .option("includeHeaders", with_headers).option("topic", topic).save()
    )
