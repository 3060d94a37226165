"""Accumulating counts into a keyed table."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ..schemas import COMMON_RANK_KEYS


def accumulate(rank_rows: DataFrame) -> DataFrame:
    """One row per rank key: values add up, the latest update time and a name stay.

    Values are summed by a hash aggregation. Names would turn that into a sort of
    all rows, so they are gathered apart, from the rows that have one, and joined;
    where counting alone makes the rows, Spark sees that there are none and leaves
    the join out. Of several names of a key the last in order stays.
    """
    sums = rank_rows.groupBy(*COMMON_RANK_KEYS).agg(
        F.sum("rank_value").alias("rank_value"), F.max("update_date").alias("update_date")
    )
    named = rank_rows.where(F.col("rank_name").isNotNull()).groupBy(
        *(F.col(k).alias(f"_{k}") for k in COMMON_RANK_KEYS)
    ).agg(F.max("rank_name").alias("rank_name"))
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in COMMON_RANK_KEYS))
    return sums.join(named, same, "left").select(*COMMON_RANK_KEYS, "rank_name", "rank_value", "update_date")


def upsert(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Insert new keys; for known ones add to the value and renew the time."""
    return accumulate(existing.unionByName(incoming))
