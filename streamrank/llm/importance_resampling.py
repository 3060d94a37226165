"""Importance resampling towards a target corpus, by hashed runs of words.

Every run of one to three words falls into a bucket by the CRC-32 of its bytes. How much
more often the target has a bucket than the raw documents is the bucket's gain, a
document's weight is the sum of its runs' gains, and documents are drawn without
replacement by weight plus Gumbel noise, which depends on their id alone.

Checksums are taken of whole batches of texts: distinct runs of equal length form a
two-dimensional array of bytes, whose checksums advance column by column.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import parked, table, tidied
from .token_units import chunks_of

BUCKETS = 10_000
LONGEST_RUN = 3
MIN_WORDS = 20
PERCENT = 5
SEED = 42
#: Bytes of text that one set of matrices covers; a longer text is taken whole.
CHUNK_BYTES = 1 << 22
#: Rows of a matrix, so that its columns stay in the processor's cache.
MATRIX_ROWS = 1 << 15
#: Runs beyond this many bytes are so rare that a matrix of them would have a row or two.
LONG_RUN = 1 << 10


def crc_table() -> np.ndarray:
    """What a byte does to a CRC-32, by the reversed polynomial."""
    made = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        made = (made >> 1) ^ np.where(made & 1, np.uint32(0xEDB88320), np.uint32(0))
    return made


def crcs_of_runs(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The CRC-32 of each run flat[start:start + length].

    Runs are grouped by length; all checksums of a group take up one column at a time.
    """
    step, out = crc_table(), np.empty(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    bounds = np.flatnonzero(np.diff(lengths[order], prepend=-1, append=-1))
    for low, high in zip(bounds.tolist(), bounds[1:].tolist()):
        length = int(lengths[order[low]])
        if length > LONG_RUN:
            for i in order[low:high].tolist():
                out[i] = zlib.crc32(flat[starts[i]:starts[i] + length].tobytes())
            continue
        rows = np.lib.stride_tricks.sliding_window_view(flat, length) if length else None
        for first in range(low, high, MATRIX_ROWS):
            bucket = order[first:min(first + MATRIX_ROWS, high)]
            crc = np.full(len(bucket), 0xFFFFFFFF, np.uint32)
            if length:
                for column in np.ascontiguousarray(rows[starts[bucket]].T):
                    crc = step[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
            out[bucket] = ~crc
    return out


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(flat, starts, ends, first): the words of all texts in one buffer, one space after each.

    Word i is flat[starts[i]:ends[i]], and text t has the words first[t] to first[t + 1].
    Letters A-Z become small; digits, letters and all bytes beyond ASCII are word bytes.
    """
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, content = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(content or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    small = np.arange(256, dtype=np.uint8)
    small[65:91] += 32
    inside = np.zeros(256, bool)
    inside[48:58] = inside[97:123] = inside[128:] = True
    raw = small[raw]
    mask = inside[raw]
    # A word ends with its text, and so may begin at any text's first byte.
    begins = mask.copy()
    begins[1:] &= ~mask[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    begins[heads] = mask[heads]
    at = np.flatnonzero(begins)
    stops = np.concatenate([at[1:], [len(raw)]])
    counts = np.concatenate([[0], np.cumsum(mask)])
    lengths = counts[stops] - counts[at] if len(at) else np.empty(0, np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    flat = np.full(int(lengths.sum()) + len(at), 32, np.uint8)
    spots = np.ones(len(flat), bool)
    spots[starts + lengths] = False
    flat[spots] = raw[mask]
    return flat, starts, starts + lengths, np.searchsorted(at, offsets)


def buckets_of(
    texts: pa.Array, buckets: int = BUCKETS, longest: int = LONGEST_RUN
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, owner, n_words): an entry for each run of one to ``longest`` words, and each text's words."""
    flat, starts, ends, first = words_of(texts)
    n = len(starts)
    text_of = np.repeat(np.arange(len(texts)), np.diff(first))
    offsets = pa.py_buffer(np.concatenate([starts, [len(flat)]]).astype(np.int64))
    alike = pa.Array.from_buffers(pa.large_binary(), n, [None, offsets, pa.py_buffer(flat)]).dictionary_encode()
    name = alike.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    same, found, owners = name, [], []
    for size in range(1, longest + 1):
        at = np.arange(max(n - size + 1, 0))
        at = at[text_of[at] == text_of[at + size - 1]]
        if size > 1:
            # A run is known by the shorter run that begins it, and its last word.
            pairs = pa.array(same[at] * (len(alike.dictionary) + 1) + name[at + size - 1]).dictionary_encode()
            run = pairs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        else:
            run = name
        # Where each distinct run is met first.
        new = np.flatnonzero(np.diff(np.maximum.accumulate(run), prepend=-1) > 0) if len(run) else at
        head = at[new]
        crc = crcs_of_runs(flat, starts[head], ends[head + size - 1] - starts[head]) if len(head) else np.empty(0, np.uint32)
        found.append((crc % np.uint32(buckets)).astype(np.int32)[run])
        owners.append(text_of[at])
        same = np.full(n, -1, np.int64)
        same[at] = run
    return np.concatenate(found), np.concatenate(owners), np.diff(first)


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST_RUN) -> DataFrame:
    """bucket, n: how many runs of all texts fall into each bucket that has any.

    Every task adds up its own before the shuffle. Null texts have no runs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, texts in chunks_of(batches, CHUNK_BYTES):
            total += np.bincount(buckets_of(texts, buckets, longest)[0], minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    found = docs.select(F.lit(0).alias("id"), "text").mapInArrow(tidied(run), "bucket int, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln(target share / raw share)) of every bucket, each count raised by one.

    The two tables of ``bucket_counts`` have at most ``buckets`` rows, which is what
    the driver takes.
    """
    tables = []
    for rows in (raw, target):
        counts = np.zeros(buckets)
        for r in rows.collect():
            counts[r["bucket"]] = r["n"]
        tables.append(counts)
    s, t = tables
    share = (t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets))
    return np.floor(1000 * np.log(share)).astype(np.int64)


def document_weights(docs: DataFrame, gains: np.ndarray, longest: int = LONGEST_RUN) -> DataFrame:
    """doc_id, n_words, n_features, weight of every row: the sum of its runs' gains."""
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in chunks_of(batches, CHUNK_BYTES):
            bucket, owner, n_words = buckets_of(texts, buckets, longest)
            # Sums of whole numbers are exact in doubles.
            weight = np.bincount(owner, gains[bucket], minlength=len(ids)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n_words.astype(np.int64)),
                 pa.array(np.bincount(owner, minlength=len(ids))), pa.array(weight)],
                names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(tidied(run), "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: str, seed: int = SEED) -> Column:
    """1000 times standard Gumbel noise, rounded down, that the id and the seed decide."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("long") + 0.5) / 4294967296.0
    return F.floor(-1000 * F.log(-F.log(share))).cast("long")


def drawn(weights: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``document_weights``.

    Of the rows with ``min_words`` words, those with the ``percent`` per cent highest
    scores are drawn and ranked, ties by doc_id (null first); other ranks are null.
    Rows are dealt out by ranges of score and id, ranked within a range, and moved up by
    the sizes of the ranges before it, so that no task sees more than its range. Equal
    scores may be many: the id parts them. Repeated rows are ranked one by one.
    """
    scored = parked(weights.withColumn("score", F.col("weight") + gumbel("doc_id", seed)), "resampling-scores")
    eligible = F.col("n_words") >= min_words
    keys = [F.desc("score"), F.asc("doc_id"), F.asc("n_features")]
    ranges = parked(scored.where(eligible).repartitionByRange(*keys).sortWithinPartitions(*keys).select(
        "doc_id", "n_features", "weight", "score", F.spark_partition_id().alias("range")), "resampling-ranges")
    sizes = ranges.groupBy("range").agg(F.count("*").alias("size"))
    before = F.sum("size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select(
        "range", F.coalesce(before, F.lit(0)).alias("base"),
        F.floor(F.sum("size").over(Window.partitionBy()) * percent / 100).alias("wanted"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*keys))
    ranked = ranges.withColumn("place", place).join(bases, "range").withColumn("rank", F.col("base") + F.col("place"))
    out = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*out, F.when(F.col("rank") <= F.col("wanted"), F.col("rank")).alias("rank")).unionByName(
        scored.where(~eligible).select(*out, F.lit(None).cast("long").alias("rank")))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document, towards the benchmark's texts.

    A null or empty text has no features and weight 0, and so has a text without words.
    Empty tables give no rows, or gains of an empty target. Long texts are taken whole.
    """
    docs = table(spark, sf_dir, "documents")
    gains = bucket_gains(bucket_counts(docs), bucket_counts(table(spark, sf_dir, "benchmark")))
    return drawn(document_weights(docs, gains))
