"""Queries that deliver results to files and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import projections
from ..operators.offsets import next_offsets
from ..plans import rank_events
from ..session import shared_dir
from ..sinks import batches, commits, landing, rank_table
from ..sources import tables
from .batch import UPDATE_DATE, halves, messages


def landing_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records in a folder per day, hour and topic."""
    records = tables.as_topic_records(tables.events(spark, sf_dir))
    path = shared_dir(spark, "landing")
    landing.land(landing.dated(records, F.col("timestamp")), path)
    return landing.read_landed(spark, path)


def landing_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four days apiece landed as batches, one of them twice, and gathered into a base on the way."""
    records = tables.as_topic_records(tables.events(spark, sf_dir))
    rows, path = landing.dated(records, F.col("timestamp")), shared_dir(spark, "landing-batches")
    # Days alone are dealt here: each batch has folders of its own.
    parts = [rows.where(F.col("day").cast("int") % 4 == i).withColumn("hour", F.lit("00")) for i in range(4)]
    for batch_id in (0, 1, 1, 2, 3, 2):
        landing.land_batch(parts[batch_id], batch_id, path, compact_every=2)
    return landing.read_batches_landed(spark, path)


def resumed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scan that stores its positions with its rows, and goes on from them without a checkpoint."""
    records = tables.as_topic_records(tables.events(spark, sf_dir))
    path, columns = shared_dir(spark, "resumed"), ["topic", "partition", "offset", "value"]
    half = records.where(F.dayofmonth("timestamp") <= 15)
    for batch_id, seen in enumerate((half, records, records)):
        rows = commits.not_yet_read(seen, spark, path).select(*columns)
        commits.commit(spark, path, batch_id, {"rows": rows, commits.POSITIONS: next_offsets(rows)})
    return commits.read_committed(spark, path, "rows", "topic string, partition int, offset long, value string")


def idempotent_batch_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches delivered twice: the first and the last with fewer rows, and with none, the second time."""
    earlier, later = halves(messages(spark, sf_dir))
    path = shared_dir(spark, "batches")
    everything = messages(spark, sf_dir)
    for batch_id, rows in ((0, everything), (0, earlier), (1, later), (1, later), (2, later), (2, later.limit(0))):
        batches.write_batch(rows, batch_id, path)
    return batches.read_batches(spark, path).select("event_id", "value")


def landing_with_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records landed with a unique id in their headers: how many ids there are, and how many differ."""
    records = projections.with_uuid(tables.as_topic_records(tables.events(spark, sf_dir)))
    path = shared_dir(spark, "landing-uuid")
    landing.land_with_headers(landing.dated(records, F.col("timestamp")), path)
    ids = spark.read.parquet(path).select(projections.header("uuid").alias("uuid"))
    return ids.agg(F.count("*").alias("records"), F.count("uuid").alias("ids"),
                   F.count_distinct("uuid").alias("distinct_ids"))


def upsert_accumulate_common_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries to the rank table, the first with names, and a fold between reads."""
    path = shared_dir(spark, "named-rank")
    earlier, later = (
        projections.common_rank_rows(rank_events.rank_counts(part), F.lit(UPDATE_DATE + i))
        for i, part in enumerate(halves(messages(spark, sf_dir)))
    )
    named = earlier.withColumn("rank_name", F.concat(F.lit("name of "), "rank_id"))
    rank_table.add_counts(named, 0, path, fold_every=1)
    rank_table.add_counts(later, 1, path, fold_every=1)
    return rank_table.read_rank_table(spark, path)


def rank_table_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two batches of counts, the second delivered twice."""
    path = shared_dir(spark, "common-rank")
    earlier, later = (
        projections.common_rank_rows(rank_events.rank_counts(part), F.lit(UPDATE_DATE + i))
        for i, part in enumerate(halves(messages(spark, sf_dir)))
    )
    for batch_id, rows in ((0, earlier), (1, later), (1, later)):
        rank_table.add_counts(rows, batch_id, path)
    return rank_table.read_rank_table(spark, path)


DELIVERED = {
    "landing_written": landing_written,
    "landing_with_uuid": landing_with_uuid,
    "landing_replayed": landing_replayed,
    "resumed_scan": resumed_scan,
    "upsert_accumulate_common_rank": upsert_accumulate_common_rank,
    "idempotent_batch_write": idempotent_batch_write,
    "rank_table_replayed": rank_table_replayed,
}
