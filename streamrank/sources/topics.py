"""Topics: reader options, streaming scans, and the same records from files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.wire import bytes_to_long

TOPIC_COLUMNS = ("topic", "partition", "offset", "timestamp", "key", "value")

_DECODERS = {
    "string": lambda c: c.cast("string"),
    "long": bytes_to_long,
    "bytes": lambda c: c,
}


def source_options(
    servers: str = "localhost:9092",
    *,
    group_id: str | None = None,
    starting_offsets: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_offsets_per_trigger: int | None = None,
    session_timeout_ms: int | None = None,
    override: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a topic reader. A non-empty ``override`` replaces all of them.

    Positions are committed by the checkpoint of the query, never by the
    client, and keys and values arrive as bytes, so there are no options for
    automatic commits or deserialisers.
    """
    if override:
        return dict(override)
    given = {
        "kafka.bootstrap.servers": servers,
        "kafka.group.id": group_id or None,
        "startingOffsets": starting_offsets,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
        "minOffsetsPerTrigger": min_offsets_per_trigger,
        "kafka.session.timeout.ms": session_timeout_ms,
    }
    return {name: str(value) for name, value in given.items() if value is not None}


def earliest(servers: str, **more) -> dict[str, str]:
    """Read from the first record a topic still holds."""
    return source_options(servers, starting_offsets="earliest", **more)


def topic_stream(
    spark: SparkSession, topics: str | Sequence[str], options: Mapping[str, str], *, headers: bool = False
) -> DataFrame:
    """Streaming scan of one or more topics; needs the Kafka connector package.

    Each micro-batch takes all there is, unless ``max_offsets_per_trigger`` is among
    the options. With ``headers`` the records keep theirs.
    """
    names = topics if isinstance(topics, str) else ",".join(topics)
    columns = (*TOPIC_COLUMNS, "headers") if headers else TOPIC_COLUMNS
    return (
        spark.readStream.format("kafka").options(**options).option("includeHeaders", str(headers).lower())
        .option("subscribe", names).load().select(*columns)
    )


def typed(records: DataFrame, key: str = "string", value: str = "string") -> DataFrame:
    """Decode key and value bytes; types are ``string``, ``long`` or ``bytes``."""
    return records.withColumns({
        "key": _DECODERS[key](F.col("key")),
        "value": _DECODERS[value](F.col("value")),
    })


def subscribed(records: DataFrame, topics: Sequence[str]) -> DataFrame:
    """The records of some topics, from files that hold them with their ``topic``.

    Files in a folder per topic are read only for the topics asked for.
    """
    return records.filter(F.col("topic").isin(*topics))
