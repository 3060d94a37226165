"""Landing raw records in folders per day, hour and topic."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .commits import commit, compact, read_committed

PATH_COLUMNS = ("day", "hour", "topic")


def dated(records: DataFrame, at: Column | None = None) -> DataFrame:
    """Record bodies with the folder they belong to, by default by wall clock.

    ``headers`` stay with records that have them.
    """
    at = F.current_timestamp() if at is None else at
    kept = ["headers"] if "headers" in records.columns else []
    return records.select(
        F.date_format(at, "yyyyMMdd").alias("day"),
        F.date_format(at, "HH").alias("hour"),
        "topic",
        F.col("value").cast("string").alias("value"),
        *kept,
    )


LANDED_DDL = "value string, day string, hour string, topic string"
#: Rows of a folder that one task writes to one file.
FILE_ROWS = 1_000_000


def gathered(rows: DataFrame, file_rows: int = FILE_ROWS) -> DataFrame:
    """The rows of a small folder in one task, those of a large one in several, all tasks at work.

    Folders are counted first, and dealt over as many partitions as the session has: most
    of the time goes into making folders, which few tasks would do one after another.
    """
    folders = list(PATH_COLUMNS)
    sizes = rows.groupBy(*folders).agg(F.ceil(F.count("*") / file_rows).alias("_files"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in folders]
    known = sizes.select(*(F.col(c).alias(f"_{c}") for c in folders), "_files")
    dealt = rows.join(known, reduce(and_, same)).withColumn("_file", F.pmod(F.xxhash64("value"), "_files"))
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.repartition(partitions, *folders, "_file").select(*rows.columns)


def land(rows: DataFrame, path: str) -> None:
    """Add dated rows to the text files of their folders."""
    gathered(rows).write.mode("append").partitionBy(*PATH_COLUMNS).text(path)


def land_with_headers(rows: DataFrame, path: str) -> None:
    """Like ``land``, as parquet files that keep all columns, ``headers`` among them."""
    gathered(rows).write.mode("append").partitionBy(*PATH_COLUMNS).parquet(path)


def land_batch(rows: DataFrame, batch_id: int, path: str, compact_every: int = 50) -> None:
    """Land dated rows under their batch's number, all of them or none; a replay adds nothing.

    The log of landed batches is the folder ``commits``. Every ``compact_every`` batches
    the earlier ones are gathered into one base, so that a folder's files do not pile up:
    it has a file per batch since the last base, and what its rows need in the base.
    """
    spark = rows.sparkSession
    split = {"landed": list(PATH_COLUMNS)}
    new = commit(spark, path, batch_id, {"landed": gathered(rows.select("value", *PATH_COLUMNS))}, split)
    if new and batch_id and batch_id % compact_every == 0:
        compact(spark, path, batch_id - 1, {"landed": LANDED_DDL}, split, {"landed": gathered})


def read_batches_landed(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all landed batches, with the folder each belongs to."""
    return read_committed(spark, path, "landed", LANDED_DDL)


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed rows with the folder each came from."""
    return spark.read.schema(LANDED_DDL).text(path)


def land_stream(
    rows: DataFrame, path: str, checkpoint: str, roll: str | None = "30 seconds", files: int = 8
) -> StreamingQuery:
    """Land a stream, starting new files every ``roll``; without one, until caught up.

    Rows with ``headers`` land as parquet, others as text. How much a micro-batch
    takes does not depend on ``roll``: it takes all there is. A folder gets up to
    ``files`` files each time, written by as many tasks.
    """
    dealt = rows.repartition(*PATH_COLUMNS, F.pmod(F.xxhash64("value"), F.lit(files)))
    kind = "parquet" if "headers" in rows.columns else "text"
    writer = (
        dealt.writeStream.format(kind).partitionBy(*PATH_COLUMNS)
        .option("checkpointLocation", checkpoint).queryName("landing")
    )
    trigger = {"processingTime": roll} if roll else {"availableNow": True}
    return writer.trigger(**trigger).start(path)
