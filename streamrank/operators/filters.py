"""Row filters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..schemas import BEHAVIOUR_EVENT

# What producers may send beyond strict JSON and still be read.
JSON_OPTIONS = {
    "allowUnquotedFieldNames": "true",
    "allowComments": "true",
    "allowUnquotedControlChars": "true",
    "allowNumericLeadingZeros": "true",
}


def flagged_views(views: DataFrame, marker: str = "ARTICLE") -> DataFrame:
    """Keep views whose flags contain the marker; case matters, null flags drop."""
    return views.filter(F.col("flags").contains(marker))


def json_shaped(value: Column) -> Column:
    """Text that starts with ``{`` and ends with ``}``, untrimmed.

    Blank text and null cannot pass, so they need no test of their own.
    """
    return value.startswith("{") & value.endswith("}")


def behaviour_events(records: DataFrame, wanted: Sequence[str], value: str = "value") -> DataFrame:
    """Rows whose JSON ``data.event`` is one of ``wanted``, with ``data`` parsed.

    Rows that are not one well-formed JSON object, or lack the field, drop.
    Parsing dominates the cost, so text that cannot hold a wanted name is
    skipped first: a name appears either literally or through an escape, which
    for letters and digits can only be ``\\u``.
    Reading the text as a one-element list rejects objects with anything
    behind them. The explode of a single element keeps the optimizer from
    repeating the parse in the filter and in every projected field.
    """
    text = F.col(value)
    escape = "\\u" if all(name.isalnum() for name in wanted) else "\\"
    mentions = reduce(or_, [text.contains(piece) for piece in (*wanted, escape)])
    parsed = F.from_json(
        F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(BEHAVIOUR_EVENT), JSON_OPTIONS
    )
    return (
        records.filter(json_shaped(text) & mentions)
        .withColumn("_parsed", F.explode(F.array(parsed)))
        .filter(F.size("_parsed") == 1)
        .withColumn("data", F.col("_parsed")[0]["data"])
        .filter(F.col("data.event").isin(*wanted))
        .drop("_parsed")
    )


def without_nulls(table: DataFrame, *columns: str) -> DataFrame:
    """Drop rows with a null key or value."""
    return table.filter(reduce(and_, [F.col(name).isNotNull() for name in columns]))
