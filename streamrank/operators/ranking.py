"""Ordering within groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import lines_of


#: Parts of a group that are trimmed by tasks of their own.
SALTS = 64


def top_n(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """The first ``n`` rows of each group, with their ``position`` from 1.

    Every task trims its share of a group to ``n`` rows before the shuffle, so
    a group of any size arrives as ``n`` rows per task. Spark does that up to a
    threshold; for larger ``n`` a group is first spread over salts and trimmed
    within each of them.
    """
    def trimmed(rows: DataFrame, *within: str) -> DataFrame:
        ranked = Window.partitionBy(*group, *within).orderBy(*order)
        return rows.withColumn("position", F.row_number().over(ranked)).filter(F.col("position") <= n)

    if n > int(rows.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
        rows = trimmed(salted, "_salt").drop("_salt", "position")
    return trimmed(rows)


def first_in_group(
    rows: DataFrame, group: Sequence[str], order: Sequence[Column], value: Column
) -> DataFrame:
    """``value`` of the first row of each group, one row per task and group shuffled."""
    return top_n(rows, group, order, 1).select(*group, value.alias("first"))


def listed(top: DataFrame, group: Sequence[str], item: str, alias: str) -> DataFrame:
    """Rows that ``top_n`` kept -> one row per group, an item per line, in order."""
    in_order = F.array_sort(F.collect_list(F.struct("position", item)))
    items = F.transform(in_order, lambda row: row[item])
    return top.groupBy(*group).agg(lines_of(items).alias(alias))


def standings(counted: DataFrame, group: Sequence[str], salt_bits: int = 4) -> DataFrame:
    """Every row with its ``rank`` in the group: 1 + rows with a larger count.

    Equal counts share a rank. The whole group is never sorted in one place:
    how many rows have each count is enough to tell the ranks, and there are
    far fewer distinct counts than rows. The join back is salted because most
    rows of a large group have the same small count.
    """
    last_salt = F.lit(2**salt_bits - 1).cast("long")
    larger_first = (
        Window.partitionBy(*group).orderBy(F.desc("count"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    ranks = (
        counted.groupBy(*group, "count").agg(F.count("*").alias("_rows"))
        .withColumn("rank", F.sum("_rows").over(larger_first) - F.col("_rows") + 1)
        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), last_salt)))
    )
    salted = counted.withColumn("_salt", F.xxhash64(*counted.columns).bitwiseAND(last_salt))
    same = [
        F.col(f"one.{name}").eqNullSafe(F.col(f"all.{name}"))
        for name in (*group, "count", "_salt")
    ]
    joined = salted.alias("one").join(ranks.alias("all"), reduce(and_, same))
    return joined.select(*[f"one.{name}" for name in counted.columns], "all.rank")
