"""Reading the named state of a query, while it runs or after it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def stored_state(
    spark: SparkSession, checkpoint: str, operator: int = 0, variable: str | None = None, batch_id: int | None = None,
) -> DataFrame:
    """Keys and values that a stateful operator of a query holds, from its checkpoint.

    Operators are numbered from the sink; ``variable`` names a state of a handler, which
    is read with its ``key`` and ``value`` as they are. ``batch_id`` goes back to an earlier
    micro-batch that the checkpoint still has.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    if variable:
        return reader.option("stateVarName", variable).load(checkpoint)
    return reader.load(checkpoint).select("key.*", "value.*")
