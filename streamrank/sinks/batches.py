"""All-or-nothing batches under a number.

A batch becomes visible as a whole when its job commits; a failed one leaves
nothing behind, and writing a number again replaces what it held, also with
nothing. Used from ``foreachBatch``, a micro-batch that is replayed after a
failure therefore counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def write_batch(rows: DataFrame, batch_id: int, path: str) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name, on whatever file system it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_batches(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of all committed batches, with their ``batch_id``.

    Given a ``schema``, a target that no batch has reached yet reads as an empty
    table; without one, the schema is that of the stored rows.
    """
    reader = spark.read
    if schema is not None:
        fields = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        stored = T.StructType([*fields.fields, T.StructField("batch_id", T.LongType())])
        if not exists(spark, path):
            return spark.createDataFrame([], stored)
        reader = reader.schema(stored)
    return reader.parquet(path).withColumn("batch_id", F.col("batch_id").cast("long"))


def committed(spark: SparkSession, path: str, name: str = "batch_id") -> list[int]:
    """The numbers of folders ``name=number`` under ``path`` that Spark has marked as complete."""
    if not exists(spark, path):
        return []
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    found = (status.getPath().getName().partition("=") for status in files.listStatus(place))
    numbers = [int(number) for kind, _, number in found if kind == name and number.isdigit()]
    return sorted(n for n in numbers if exists(spark, f"{path}/{name}={n}/_SUCCESS"))


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder of stored rows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
