"""Token ids as bit-plane shuffled, compressed chunk files.

A document's ids are those of its whole text and an end id. Ids lie in ascending
doc_id order and are cut into segments of about a million, which end with a document,
and these into blocks of a fixed number of ids. A block is transposed: byte planes
hold the first, second, ... byte of every id, bit planes their single bits, so that
the planes that hardly change shrink to almost nothing. Each plane is compressed on
its own with zstandard.

A data set is a folder of three Parquet tables, written and committed by Spark:
``data`` has a row per segment with the planes end to end, ``chunks`` the chunk index
(which ids a block holds, and where its planes lie in the segment), and ``docs`` where
each document starts. Token positions are global.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import shared_dir
from .common import mapped, table, tidied
from .token_units import byte_level, chunks_of, tokenizer_json

BLOCK_IDS = 1 << 14
SEGMENT_IDS = 1 << 20
END_ID = 0
LEVEL = 3


def pack(ids: np.ndarray, planes: str, compress) -> list[bytes]:
    """The compressed planes of one block of ids."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if planes == "bit":
        bits = np.unpackbits(octets, axis=1, bitorder="little")
        return [compress(np.packbits(bits[:, i]).tobytes()) for i in range(32)]
    return [compress(octets[:, i].tobytes()) for i in range(4)]


def unpack(parts: list[bytes], n: int, expand) -> np.ndarray:
    """What ``pack`` was given: the number of planes tells their kind."""
    flat = [np.frombuffer(expand(p), np.uint8) for p in parts]
    if len(parts) == 32:
        bits = np.stack([np.unpackbits(p, count=n) for p in flat], axis=1)
        octets = np.packbits(bits, axis=1, bitorder="little")
    else:
        octets = np.stack(flat, axis=1)
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


DATA = (
    "part int, segment int, n_ids long, doc_ids array<long>, doc_starts array<int>, "
    "chunk_starts array<int>, plane_ends array<int>, n_planes int, payload binary"
)


def _segments(
    batches: Iterator[pa.RecordBatch], schema: pa.Schema, definition: str, end_id: int,
    planes: str, block_ids: int, segment_ids: int,
) -> Iterator[pa.RecordBatch]:
    encoder, compress = byte_level(definition), zstandard.ZstdCompressor(level=LEVEL).compress
    part, number, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4")
    docs: list[int | None] = []
    held: list[np.ndarray] = []
    starts = [0]

    def segment() -> pa.RecordBatch:
        ids = np.concatenate(held)
        firsts = list(range(0, len(ids), block_ids))
        packed = [pack(ids[i:i + block_ids], planes, compress) for i in firsts]
        ends = np.cumsum([len(p) for block in packed for p in block]).tolist()
        row = [part, number, len(ids), docs, starts[:-1], firsts, ends, len(packed[0]),
               b"".join(p for block in packed for p in block)]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], type=f.type) for v, f in zip(row, schema)], schema=schema)

    for doc_ids, texts in chunks_of(batches):
        for doc_id, found in zip(doc_ids, encoder.ids(texts)):
            ids = np.concatenate([found, end])
            docs.append(doc_id)
            held.append(ids)
            starts.append(starts[-1] + len(ids))
            if starts[-1] >= segment_ids:
                yield segment()
                docs, held, starts, number = [], [], [0], number + 1
    if held:
        yield segment()


def write_token_ids(
    docs: DataFrame, path: str, definition: str | None = None, end_id: int = END_ID,
    planes: str = "byte", block_ids: int = BLOCK_IDS, segment_ids: int = SEGMENT_IDS,
) -> str:
    """Writes the ids of ``docs`` (doc_id, text) under ``path`` and returns it.

    ``planes`` is "byte" or "bit". A null text is empty and has its end id alone. Null
    doc_ids come first; rows with one doc_id lie next to each other, in the order of
    their text's hash, and each keeps an entry of its own. An empty input leaves empty
    tables. Other columns are not stored.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    if planes not in ("byte", "bit"):
        raise ValueError("planes must be 'byte' or 'bit'")
    spark = docs.sparkSession
    definition = definition or tokenizer_json()
    wanted = StructType.fromDDL(DATA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted, prefers_large_types=False)
        return _segments(batches, schema, definition, end_id, planes, block_ids, segment_ids)

    order = ["doc_id", F.xxhash64("text")]
    ordered = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(tidied(run), wanted).write.mode("overwrite").option(
        "compression", "none").parquet(f"{path}/data")

    segments = segment_starts(spark, path)
    segments.select(
        F.posexplode("chunk_starts").alias("chunk", "offset"), "part", "segment", "n_ids", "start", "chunk_starts",
        "plane_ends", "n_planes",
    ).select(
        "part", "segment", "chunk", (F.col("start") + F.col("offset")).alias("start"),
        (F.coalesce(F.try_element_at("chunk_starts", F.col("chunk") + 2), "n_ids") - F.col("offset")).alias("n_ids"),
        F.coalesce(F.try_element_at("plane_ends", F.expr("nullif(chunk * n_planes, 0)")), F.lit(0)).alias("byte_start"),
        F.slice("plane_ends", F.col("chunk") * F.col("n_planes") + 1, F.col("n_planes")).alias("plane_ends"),
    ).write.mode("overwrite").parquet(f"{path}/chunks")
    segments.select(
        "part", "segment", "n_ids", "start", F.posexplode("doc_ids").alias("i", "doc_id"), "doc_starts",
    ).select(
        "doc_id", "part", "segment", F.element_at("doc_starts", F.col("i") + 1).alias("offset"), "i", "n_ids", "start",
        F.try_element_at("doc_starts", F.col("i") + 2).alias("next"),
    ).select(
        "doc_id", "part", "segment", "offset", (F.col("start") + F.col("offset")).alias("start"),
        (F.coalesce("next", "n_ids") - F.col("offset")).alias("n_tokens"),
    ).write.mode("overwrite").parquet(f"{path}/docs")
    return path


def _data(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DATA).parquet(f"{path}/data")


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """The segments without their payload, with the global position of their first id.

    Running totals go first over the parts, of which there are as many as tasks wrote,
    and then within each part.
    """
    segments = _data(spark, path).drop("payload")
    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = parts.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = segments.select("part", "segment", "n_ids").join(bases, "part").select(
        "part", "segment", (F.col("base") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("start"))
    return segments.join(sizes, ["part", "segment"])


def _blocks(row: dict, wanted: Iterable[int] | None = None) -> np.ndarray:
    """The ids of a segment's blocks, or of the ``wanted`` ones."""
    expand = zstandard.ZstdDecompressor().decompress
    payload, k, firsts = row["payload"], row["n_planes"], [*row["chunk_starts"], row["n_ids"]]
    cuts = [0, *row["plane_ends"]]
    chosen = range(len(firsts) - 1) if wanted is None else wanted
    return np.concatenate([
        unpack([payload[cuts[k * i + p]:cuts[k * i + p + 1]] for p in range(k)], firsts[i + 1] - firsts[i], expand)
        for i in chosen])


def _documents(batch: dict[str, list], digest: bool) -> Iterable[dict]:
    for i in range(len(batch["part"])):
        row = {k: v[i] for k, v in batch.items()}
        ids = _blocks(row)
        cuts = [*row["doc_starts"], len(ids)]
        runs = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        n = len(runs)
        out = {"doc_id": row["doc_ids"], "part": [row["part"]] * n, "segment": [row["segment"]] * n,
               "offset": cuts[:-1]}
        if digest:
            yield out | {"n_tokens": [len(r) for r in runs],
                         "ids_crc32": [zlib.crc32(r.astype("<u4").tobytes()) for r in runs]}
        else:
            yield out | {"ids": [r.astype(np.int64) for r in runs]}


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start and ids (the end id included) of each document of a data set."""
    found = mapped(_data(spark, path), "doc_id long, part int, segment int, offset int, ids array<long>",
                   _documents, False)
    starts = segment_starts(spark, path).select("part", "segment", F.col("start").alias("first"))
    return found.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), "ids")


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from its decoded ids."""
    found = mapped(_data(spark, path),
                   "doc_id long, part int, segment int, offset int, n_tokens long, ids_crc32 long",
                   _documents, True)
    starts = segment_starts(spark, path).select("part", "segment", F.col("start").alias("first"))
    return found.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("first") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def _ranges(batch: dict[str, list], low: int, high: int) -> Iterable[dict]:
    for i in range(len(batch["part"])):
        row = {k: v[i] for k, v in batch.items()}
        ids = _blocks(row, row["wanted"])
        start = row["first"] + row["chunk_starts"][row["wanted"][0]]
        a, b = max(low - start, 0), min(high - start, len(ids))
        yield {"start": [start + a], "ids": [ids[a:b].astype(np.int64)]}


def read_range(spark: SparkSession, path: str, low: int, high: int) -> DataFrame:
    """start and ids of the pieces of token positions ``low`` to ``high`` (not included).

    The chunk index tells the segments and blocks, and only those are decoded.
    """
    chunks = spark.read.parquet(f"{path}/chunks").where(
        (F.col("start") < high) & (F.col("start") + F.col("n_ids") > low))
    wanted = chunks.groupBy("part", "segment").agg(F.sort_array(F.collect_list("chunk")).alias("wanted"))
    starts = segment_starts(spark, path).select("part", "segment", F.col("start").alias("first"))
    rows = _data(spark, path).join(wanted, ["part", "segment"]).join(starts, ["part", "segment"])
    return mapped(rows, "start long, ids array<long>", _ranges, low, high)


def op5_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read back from written files."""
    path = write_token_ids(table(spark, sf_dir, "documents"), shared_dir(spark, "token-ids"))
    return document_digests(spark, path)
