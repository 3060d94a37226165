"""Batches over several targets that become visible together, and where to go on from.

A batch's rows for every target are prepared in folders that no reader looks at. One
manifest, published last by a rename, makes all of them visible at once; a failure
before that leaves nothing to be seen and its folders are removed. A batch that has a
manifest is not written again, so a replay changes nothing. With the rows a batch can
store the positions it has read up to, from which a job goes on without its checkpoint.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .batches import exists, remove

#: The target that holds the positions of a batch.
POSITIONS = "positions"
POSITIONS_DDL = "topic string, partition int, next_offset long"


def publish(spark: SparkSession, path: str, content: dict) -> None:
    """Writes a small file under its name as a whole, replacing what it held."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    target, draft = place(path), place(f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    if files.exists(target):
        files.delete(target, False)
    if not files.rename(draft, target):
        raise OSError(f"could not publish {path}")


def published(spark: SparkSession, path: str) -> dict | None:
    """What ``publish`` has written under a name."""
    if not exists(spark, path):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def manifests(spark: SparkSession, path: str, upto: int | None = None) -> list[dict]:
    """The newest base and the batches after it, in order; batches a base covers are left out."""
    folder = f"{path}/commits"
    if not exists(spark, folder):
        return []
    rows = spark.read.schema("batch_id long, attempt string, base boolean, targets array<string>").json(folder).collect()
    found = [r.asDict() for r in rows if upto is None or r["batch_id"] <= upto]
    base = max((m for m in found if m["base"]), key=lambda m: m["batch_id"], default=None)
    after = base["batch_id"] if base else -1
    return [base] * bool(base) + sorted(
        (m for m in found if not m["base"] and m["batch_id"] > after), key=lambda m: m["batch_id"])


def _folder(path: str, target: str, manifest: Mapping) -> str:
    return f"{path}/{target}/_part={'base' if manifest['base'] else 'batch'}-{manifest['batch_id']}/_attempt={manifest['attempt']}"


def _write(
    spark: SparkSession, path: str, batch_id: int, base: bool, targets: Mapping[str, DataFrame],
    partitioned: Mapping[str, Sequence[str]],
) -> None:
    made = {"batch_id": batch_id, "attempt": uuid.uuid4().hex, "base": base, "targets": sorted(targets)}
    try:
        for name, rows in targets.items():
            rows.write.partitionBy(*partitioned.get(name, ())).parquet(_folder(path, name, made))
        publish(spark, f"{path}/commits/{'base' if base else 'batch'}-{batch_id}.json", made)
    except BaseException:
        for name in targets:
            remove(spark, _folder(path, name, made))
        raise


def commit(
    spark: SparkSession, path: str, batch_id: int, targets: Mapping[str, DataFrame],
    partitioned: Mapping[str, Sequence[str]] | None = None,
) -> bool:
    """Writes the rows of all ``targets``, or of none; whether the batch was new.

    ``partitioned`` names the columns by which a target's folders are split.
    """
    known = manifests(spark, path)
    if any(m["batch_id"] == batch_id or m["base"] and m["batch_id"] >= batch_id for m in known):
        return False
    for name in targets:
        # What an attempt has left that ended before it could remove it.
        remove(spark, f"{path}/{name}/_part=batch-{batch_id}")
    _write(spark, path, batch_id, False, targets, partitioned or {})
    return True


def read_committed(spark: SparkSession, path: str, target: str, schema: str, upto: int | None = None) -> DataFrame:
    """The rows of a target in all committed batches; ``schema`` has the columns that folders are split by, too."""
    folders = [_folder(path, target, m) for m in manifests(spark, path, upto) if target in m["targets"]]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{path}/{target}").parquet(*folders)
    return rows.drop("_part", "_attempt")


def compact(
    spark: SparkSession, path: str, upto: int, schemas: Mapping[str, str],
    partitioned: Mapping[str, Sequence[str]] | None = None,
    merge: Mapping[str, Callable[[DataFrame], DataFrame]] | None = None,
) -> None:
    """Puts the batches up to ``upto`` into one base, target by target, which becomes visible as a whole.

    ``merge`` may reshape a target's rows on the way, such as to gather small files. What
    the base before this one had replaced is removed; newer leftovers stay until the next
    time, for readers that have begun with them.
    """
    known = manifests(spark, path, upto)
    old = next((m["batch_id"] for m in known if m["base"]), -1)
    if not known or upto <= old:
        return
    same = lambda rows: rows
    _write(spark, path, upto, True, {
        name: (merge or {}).get(name, same)(read_committed(spark, path, name, schema, upto))
        for name, schema in schemas.items()}, partitioned or {})
    for batch_id in range(_swept(spark, path) + 1, old + 1):
        for name in schemas:
            remove(spark, f"{path}/{name}/_part=batch-{batch_id}")
        remove(spark, f"{path}/commits/batch-{batch_id}.json")
    publish(spark, f"{path}/swept.json", {"upto": old})


def _swept(spark: SparkSession, path: str) -> int:
    return (published(spark, f"{path}/swept.json") or {"upto": -1})["upto"]


# Positions.

def positions(spark: SparkSession, path: str) -> DataFrame:
    """topic, partition and next_offset: where the committed batches end."""
    stored = read_committed(spark, path, POSITIONS, POSITIONS_DDL)
    return stored.groupBy("topic", "partition").agg(F.max("next_offset").alias("next_offset"))


def starting_offsets(spark: SparkSession, path: str) -> str:
    """The positions as the ``startingOffsets`` of a topic reader; ``earliest`` if there are none."""
    found: dict[str, dict[str, int]] = {}
    for row in positions(spark, path).orderBy("topic", "partition").collect():
        found.setdefault(row["topic"], {})[str(row["partition"])] = row["next_offset"]
    return json.dumps(found) if found else "earliest"


def not_yet_read(records: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """The records at and after the positions, for sources that take no starting offsets."""
    known = positions(spark, path).select(
        F.col("topic").alias("_topic"), F.col("partition").alias("_partition"), "next_offset")
    same = (F.col("topic") == F.col("_topic")) & (F.col("partition") == F.col("_partition"))
    return records.join(known, same, "left").where(
        "next_offset is null or offset >= next_offset").select(*records.columns)


# Batch numbers in topic records.

def numbered(records: DataFrame, batch_id: int) -> DataFrame:
    """``key``/``value`` records whose headers carry their batch and their number among equal records.

    A replayed batch gives the same headers, whatever order its rows come in.
    """
    number = lambda n: F.encode(F.format_string("%d", n), "UTF-8")
    copies = records.groupBy("key", "value").agg(F.count("*").alias("_n"))
    each = copies.select("key", "value", F.explode(F.sequence(F.lit(1).cast("long"), "_n")).alias("_copy"))
    header = lambda name, n: F.struct(F.lit(name).alias("key"), number(n).alias("value"))
    return each.select("key", "value", F.array(
        header("batch", F.lit(batch_id).cast("long")), header("copy", F.col("_copy"))).alias("headers"))


def without_replays(records: DataFrame) -> DataFrame:
    """Records of ``numbered`` batches, each once however often its batch was sent."""
    return records.dropDuplicates(["key", "value", "headers"])
