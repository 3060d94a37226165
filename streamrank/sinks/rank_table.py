"""The rank table: counts that add up per key, in buckets of keys.

Adding commutes, so every batch is stored as it comes, split by bucket, and readers add
up what is there. Nothing is read or rewritten on the way in, however large the table
is, and the batch number makes replays harmless. Every so many batches what came before
is folded into a base: only buckets that those batches touch are merged, the others stay
where they are, and a manifest that names the folder of every bucket makes the new base
visible last. Looking up keys reads their buckets and nothing else.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.accumulate import accumulate
from ..schemas import COMMON_RANK, COMMON_RANK_KEYS
from .batches import committed, exists, remove
from .commits import publish, published

#: Batches from one base to the next.
FOLD_EVERY = 100
#: Buckets of a new table. A bucket is merged in one task, which may spill.
BUCKETS = 16


def _manifest(spark: SparkSession, path: str) -> dict:
    """upto: the last batch the base covers; folders: of each bucket, by number."""
    return published(spark, f"{path}/base.json") or {"upto": -1, "buckets": BUCKETS, "folders": {}}


def _bucket(keys: list[Column], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _bucketed(rows: DataFrame, buckets: int) -> DataFrame:
    """One file for each bucket."""
    bucket = _bucket([F.col(k) for k in COMMON_RANK_KEYS], buckets)
    return rows.withColumn("bucket", bucket).repartition(min(buckets, 64), "bucket")


def add_counts(rank_rows: DataFrame, batch_id: int, path: str, fold_every: int = FOLD_EVERY, buckets: int = BUCKETS) -> None:
    """Add rank rows to the table, combined per key first.

    A batch that a base already covers is a replay and changes nothing. ``buckets`` is
    for a table without a base; it must not change before the first one.
    """
    spark = rank_rows.sparkSession
    base = _manifest(spark, path)
    if batch_id <= base["upto"]:
        return
    n = base["buckets"] if base["folders"] else buckets
    _bucketed(accumulate(rank_rows), n).write.mode("overwrite").partitionBy("bucket").parquet(
        f"{path}/batches/batch_id={batch_id}")
    if batch_id and batch_id % fold_every == 0:
        fold(spark, path, batch_id - 1, n)


def _stored(spark: SparkSession, path: str, base: Mapping, upto: int | None, wanted: set[int] | None = None) -> DataFrame | None:
    """The rows of the base and of the batches after it, of some buckets or of all."""
    numbers = [n for n in committed(spark, f"{path}/batches") if n > base["upto"] and (upto is None or n <= upto)]
    batches = [f"{path}/batches/batch_id={n}" for n in numbers]
    folders = [f for k, f in base["folders"].items() if wanted is None or int(k) in wanted]
    if wanted is not None:
        batches = [f for b in batches for k in sorted(wanted) if exists(spark, f := f"{b}/bucket={k}")]
    found = [
        spark.read.schema(COMMON_RANK).option("basePath", f"{path}/{kind}").parquet(*some).select(*COMMON_RANK.fieldNames())
        for kind, some in (("bases", [f"{path}/{f}" for f in folders]), ("batches", batches)) if some]
    return reduce(DataFrame.unionByName, found) if found else None


def read_rank_table(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The table with all committed batches, or those up to a number, added up."""
    rows = _stored(spark, path, _manifest(spark, path), upto)
    if rows is None:
        return spark.createDataFrame([], COMMON_RANK)
    return accumulate(rows).select(*COMMON_RANK.fieldNames())


def look_up(spark: SparkSession, path: str, *keys: Mapping[str, str | None], buckets: int = BUCKETS) -> DataFrame:
    """The table's rows of some keys, each a dict of the key columns; only their buckets are read."""
    base = _manifest(spark, path)
    n = base["buckets"] if base["folders"] else buckets
    kinds = ", ".join(f"{k} string" for k in COMMON_RANK_KEYS)
    asked = spark.createDataFrame([tuple(key[k] for k in COMMON_RANK_KEYS) for key in keys], kinds)
    hit = {r[0] for r in asked.select(_bucket([F.col(k) for k in COMMON_RANK_KEYS], n)).distinct().collect()}
    rows = _stored(spark, path, base, None, hit)
    if rows is None:
        return spark.createDataFrame([], COMMON_RANK)
    same = F.lit(False)
    for key in keys:
        same |= _matches(key)
    return accumulate(rows.where(same)).select(*COMMON_RANK.fieldNames())


def _matches(key: Mapping[str, str | None]) -> Column:
    same = F.lit(True)
    for name in COMMON_RANK_KEYS:
        same &= F.col(name).eqNullSafe(F.lit(key[name]))
    return same


def fold(spark: SparkSession, path: str, upto: int, buckets: int = BUCKETS) -> None:
    """Folds all batches up to ``upto`` into the base; its manifest is written last.

    ``upto`` must lie before any batch that may still be replayed. Buckets without new
    rows keep their folder. What the base before this one had replaced is removed; newer
    leftovers stay until the next fold, for readers that have begun with them.
    """
    base = _manifest(spark, path)
    if upto <= base["upto"]:
        return
    n = base["buckets"] if base["folders"] else buckets
    numbers = [b for b in committed(spark, f"{path}/batches") if base["upto"] < b <= upto]
    folders = [f"{path}/batches/batch_id={b}" for b in numbers]
    touched = set()
    if folders:
        new = spark.read.schema(T.StructType([*COMMON_RANK, T.StructField("bucket", T.IntegerType())])).option("basePath", f"{path}/batches").parquet(*folders)
        touched = {r[0] for r in new.select("bucket").distinct().collect()}
    if touched:
        merged = _bucketed(accumulate(_stored(spark, path, base, upto, touched)), n)
        merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/bases/base_id={upto}")
    kept = base["folders"] | {str(k): f"bases/base_id={upto}/bucket={k}" for k in touched}
    publish(spark, f"{path}/base.json", {"upto": upto, "buckets": n, "folders": kept, "replaced": [
        f for k, f in base["folders"].items() if int(k) in touched]})
    for old in base.get("replaced", ()):
        remove(spark, f"{path}/{old}")
    for b in committed(spark, f"{path}/batches"):
        if b <= base["upto"]:
            remove(spark, f"{path}/batches/batch_id={b}")
