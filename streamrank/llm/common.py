"""What several operators share: written tables, components, text in task batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parked(rows: DataFrame, label: str, path: str | None = None, **options) -> DataFrame:
    """``rows`` written to the shared folder, with the writer's options, and read back.

    This cuts the lineage: a lost executor costs the tasks that were running,
    not what was already written.
    """
    spark = rows.sparkSession
    path = path or shared_dir(spark, label)
    rows.write.mode("overwrite").options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder this library has written and no longer reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def is_held_out(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """Whether the checksum of the id's text leaves no remainder; null ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(True))


def give_back() -> None:
    """Returns memory that is no longer used to the system: Spark keeps Python processes for later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidied(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on a task's batches, which gives its memory back at the end."""
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run


def mapped(
    rows: DataFrame, schema: str, work: Callable[..., Iterable[dict[str, list]]], *args, at_once: int = 1 << 14
) -> DataFrame:
    """Runs ``work(batch, *args)`` in the tasks, on Arrow batches turned into columns.

    ``work`` gets a dict of Python lists, of ``at_once`` rows at most, and yields dicts of
    lists or arrays that follow ``schema``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    wanted = StructType.fromDDL(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = to_arrow_schema(wanted, prefers_large_types=False)
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                columns = {n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}
                for out in work(columns, *args):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in target], schema=target
                    )

    return rows.mapInArrow(tidied(run), wanted)


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest node it reaches.

    Alternating stars: each round hangs every node's larger neighbours, then its
    smaller ones, onto its smallest neighbour, so that the number of rounds grows
    with the logarithm of the longest path. A hub's neighbours are never gathered
    in one place: minima combine before the shuffle, and the join back is one Spark
    can split. Each round is written to the shared folder and the one before removed.
    """
    spark = edges.sparkSession

    def both(e: DataFrame) -> DataFrame:
        return e.select(F.explode(F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
            F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
        )).alias("e")).select("e.u", "e.v")

    def large(e: DataFrame) -> DataFrame:
        near = both(e)
        least = near.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        return near.where("v > u").join(least, "u").select(
            F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()

    def small(e: DataFrame) -> DataFrame:
        down = e.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        hung = down.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        return hung.union(own).where("a <> b").distinct()

    before, old, mark = edges.select("a", "b").where("a <> b"), None, None
    while True:
        path = shared_dir(spark, label)
        now = parked(small(large(before)), label, path)
        found = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % (1 << 40))).first()
        if old:
            discard(spark, old)
        if tuple(found) == mark:
            break
        before, old, mark = now, path, tuple(found)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
