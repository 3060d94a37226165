"""Avro-valued records; needs the Avro package on the classpath."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.avro.functions import from_avro

from ..schemas import to_avsc


def header_id(value: Column) -> Column:
    """The schema id in a registry's header; null without such a header."""
    framed = (F.octet_length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == "00")
    return F.when(framed, F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("long"))


def by_schema_id(value: Column, decoders: Mapping[int, Callable[[Column], Column]]) -> Column:
    """A framed ``value`` decoded by the decoder of its schema id; ids without one fail the query.

    Every decoder gets the bytes behind the header and gives the same type. A null value stays null.
    """
    given, body = header_id(value), F.substring(value, 6, 1 << 30)
    unknown = F.raise_error(F.concat(F.lit("unexpected schema id "), F.coalesce(given.cast("string"), F.lit("none"))))
    found = F.when(value.isNull(), F.lit(None))
    for number, decode in decoders.items():
        # Only the bytes of its own records reach a decoder.
        found = found.when(given == number, decode(F.when(given == number, body)))
    return found.otherwise(unknown)


def avro_values(
    records: DataFrame, name: str, record: T.StructType, *, registry_header: bool = True,
    schema_id: int | None = None, writers: Mapping[int, T.StructType] | None = None,
) -> DataFrame:
    """Decode ``value`` and spread its fields over columns, keeping ``timestamp``.

    Producers that use a schema registry put five bytes (a zero and the schema id) before
    the record. ``writers`` has the schema of each id that records may carry; each record is
    decoded by the one it was written with and read as ``record``. Given a ``schema_id``
    alone, records are of that one. A record with any other id fails the query instead of
    being misread.
    """
    reader = to_avsc(name, record)
    if schema_id is not None and not writers:
        writers = {schema_id: record}
    if registry_header and writers:
        decoded = by_schema_id(F.col("value"), {
            number: lambda body, written=to_avsc(name, schema): from_avro(body, written, {"avroSchema": reader})
            for number, schema in writers.items()})
    else:
        decoded = from_avro(F.expr("substring(value, 6)") if registry_header else F.col("value"), reader)
    return records.select("timestamp", decoded.alias("record")).select("timestamp", "record.*")
