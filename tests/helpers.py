"""Shared test helpers."""

from __future__ import annotations

import datetime as dt
import os

import duckdb
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq

SF_DIR = "/root/testdata/sf0.001"
UTC = dt.timezone.utc


def at(ms: int) -> dt.datetime:
    return dt.datetime.fromtimestamp(ms / 1000, UTC)


def clock(text: str, day: str = "2024-01-01") -> dt.datetime:
    return dt.datetime.fromisoformat(f"{day}T{text}+00:00")


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows with columns in name order, sorted, with one kind of null."""
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if pd.isna(value) else value for value in row)
        for row in frame.itertuples(index=False, name=None)
    ]
    return sorted(rows, key=repr)


def rows_of(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)


def duck(tables=("events", "documents"), sf_dir: str = SF_DIR):
    connection = duckdb.connect()
    for name in tables:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


class Feed:
    """A folder that receives one file of rows per call, read as a stream."""

    def __init__(self, path, ddl: str = "key string, timestamp timestamp"):
        self.path, self.ddl, self.files = str(path), ddl, 0
        os.makedirs(self.path, exist_ok=True)

    def send(self, *rows: tuple) -> None:
        kinds = {"string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "timestamp": pa.timestamp("us", "UTC"),
                 "long": pa.int64()}
        schema = pa.schema([(name, kinds[kind]) for name, kind in map(str.split, self.ddl.split(", "))])
        table = pa.Table.from_pylist([dict(zip(schema.names, row)) for row in rows], schema)
        name = os.path.join(self.path, f"{self.files:04d}.parquet")
        pq.write_table(table, name)
        os.utime(name, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def stream(self, spark):
        return (
            spark.readStream.schema(self.ddl).option("maxFilesPerTrigger", 1).parquet(self.path)
        )
