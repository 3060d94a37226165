"""Near-duplicates by SimHash, found through a pigeonring index.

A fingerprint's 64 bits are eight segments on a ring. Two fingerprints that differ
in at most ``bits`` bits must have a starting segment from which every chain of
``l`` consecutive segments differs in at most ``l * bits / 8`` bits: the budgets are
proportional. For three bits the first two segments are then equal, and of the next
three at most one differs. The index holds just that: per start and per segment that
may differ, a key of the four others. Pairs that meet under a key go through the whole
chain test, and only those that pass through the full count of differing bits.

Documents with one fingerprint are one class from the start, so copies cost nothing.
A key's classes are dealt into blocks by hash, blocks meet pairwise in tasks of their
own, and a task returns a spanning forest of the links it finds, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import components, mapped, parked, table

SEED = 42
SEGMENTS = 8
#: Fingerprints that meet in one task under one key.
BLOCK = 1024


def shingle_hashes(text: bytes | None, words: int) -> np.ndarray:
    """XXH64 of each run of ``words`` words, A-Z in lower case, repeats included."""
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    runs = [found] if len(found) < words else zip(*(found[i:] for i in range(words)))
    digest = xxhash.xxh64_intdigest
    return np.array([digest(x, SEED) for x in map(b" ".join, runs)], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is one if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(batch: dict[str, list], words: int) -> Iterable[dict]:
    prints = np.array([fingerprint(shingle_hashes(t, words)) for t in batch["text"]], np.uint64)
    yield {"doc_id": batch["doc_id"], "fp": prints.view(np.int64)}


def _row_fingerprints(batch: dict[str, list], words: int) -> Iterable[dict]:
    for found in _fingerprints(batch, words):
        yield found | {"row_a": batch["row_a"], "row_b": batch["row_b"]}


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a long). Null or wordless texts have fingerprint zero."""
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return mapped(rows, "doc_id long, fp long", _fingerprints, words, at_once=1024)


def hex_digits(fp: str | Column = "fp") -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def ring_keys(fp: Column, bits: int) -> Column:
    """The array of index keys of a fingerprint, for up to seven differing bits."""
    if not 0 <= bits < SEGMENTS:
        raise ValueError(f"bits must be from 0 to {SEGMENTS - 1}")
    if bits == 0:
        return F.array(fp)
    equal = -(-SEGMENTS // bits) - 1  # the longest chain with a budget under one
    length = min(SEGMENTS, -(-2 * SEGMENTS // bits) - 1)  # and with one under two

    def key(start: int, spare: int) -> Column:
        made = F.lit(start * SEGMENTS + spare).cast("long")
        for j in [*range(equal), *(j for j in range(equal, length) if j != spare)]:
            segment = F.shiftrightunsigned(fp, 8 * ((start + j) % SEGMENTS)).bitwiseAND(255)
            # Up to seven segments and the start: two words, mixed by the hash.
            made = F.xxhash64(made, segment) if length - 1 > 6 else F.shiftleft(made, 8).bitwiseOR(segment)
        return made

    spares = range(equal, length) if length > equal else [SEGMENTS]
    return F.array(*(key(i, s) for i in range(SEGMENTS) for s in spares))


def linked(xors: np.ndarray, bits: int) -> np.ndarray:
    """Which of the XORed fingerprints pass the chain test and the full count."""
    flat = np.ascontiguousarray(xors).reshape(-1)
    apart = np.bitwise_count(flat.view(np.uint8).reshape(-1, SEGMENTS))
    ring = np.concatenate([apart, apart[:, :-1]], axis=1).cumsum(axis=1, dtype=np.uint16)
    ring = np.concatenate([np.zeros((len(ring), 1), np.uint16), ring], axis=1)
    passes = np.zeros(len(flat), bool)
    for start in range(SEGMENTS):
        chain = np.ones(len(flat), bool)
        for length in range(1, SEGMENTS + 1):
            chain &= ring[:, start + length] - ring[:, start] <= length * bits // SEGMENTS
        passes |= chain
    passes[passes] = np.bitwise_count(flat[passes]) <= bits
    return passes.reshape(xors.shape)


def forest(left: list, right: list, near: np.ndarray) -> list[tuple]:
    """Edges that join what ``near`` (left x right) joins, each to the least of its group."""
    names = sorted({*left, *right})
    at = {name: i for i, name in enumerate(names)}
    group = np.arange(len(names))
    i, j = np.nonzero(near)
    a, b = np.array([at[x] for x in left])[i], np.array([at[x] for x in right])[j]
    while True:
        least = np.minimum(group[a], group[b])
        now = group.copy()
        np.minimum.at(now, a, least)
        np.minimum.at(now, b, least)
        now = now[now]
        if (now == group).all():
            break
        group = now
    return [(names[x], names[g]) for x, g in enumerate(group) if g != x]


def _links(batch: dict[str, list], bits: int) -> Iterable[dict]:
    edges: set[tuple] = set()
    for left, right in zip(batch["left"], batch["right"]):
        x = np.array(left, np.int64).view(np.uint64)
        y = x if right is None else np.array(right, np.int64).view(np.uint64)
        if len(x) == len(y) == 2 and right is None:
            if linked(x[:1] ^ x[1:], bits)[0]:
                edges.add((max(left), min(left)))
            continue
        near = linked(x[:, None] ^ y[None, :], bits)
        edges.update(forest(left, left if right is None else right, near))
    yield {"a": [a for a, _ in edges], "b": [b for _, b in edges]}


def met(keyed: DataFrame, block: int = BLOCK) -> DataFrame:
    """left, right: the distinct ``fp`` of each key, in blocks that meet pairwise.

    ``right`` is null where a key has one block, which then meets itself. Blocks
    are dealt by hash after counting, so no key is gathered anywhere.
    """
    counts = keyed.groupBy("key").count().where("count > 1")
    several = keyed.join(counts, "key").withColumn("n", F.ceil(F.col("count") / block))
    dealt = several.withColumn("block", F.pmod(F.xxhash64("fp"), "n"))
    blocks = parked(dealt.groupBy("key", "n", "block").agg(F.collect_set("fp").alias("left")), "blocks")
    alone = blocks.where("n = 1").select("left", F.lit(None).cast("array<long>").alias("right"))
    split = blocks.where("n > 1")
    others = split.select("key", F.col("block").alias("other"), F.col("left").alias("right"))
    pairs = split.withColumn("other", F.explode(F.sequence("block", F.col("n") - 1)))
    return alone.union(pairs.join(others, ["key", "other"]).select("left", "right"))


def print_links(prints: DataFrame, bits: int = 3) -> DataFrame:
    """(a, b): links that join all distinct ``fp`` within ``bits`` bits of each other."""
    keyed = prints.select("fp").distinct().select("fp", F.explode(ring_keys(F.col("fp"), bits)).alias("key"))
    return mapped(met(keyed), "a long, b long", _links, bits).distinct()


def simhash_components(docs: DataFrame, words: int = 3, bits: int = 3) -> DataFrame:
    """doc_id, fingerprint, component_id, n_links per row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, the row's own included
    (null if all of them are null); ``n_links`` counts the distinct other fingerprints
    in the component. Rows repeated in the input are repeated in the result, an empty
    input gives an empty result, and other columns are left out.
    """
    prints = parked(fingerprints(docs, words), "fingerprints")
    roots = parked(components(print_links(prints, bits)), "roots")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"), (F.count("*") - 1).alias("n_links"))
    named = rooted.join(least, "root").select("fp", "component_id", "n_links")
    return prints.join(named, "fp").select(
        "doc_id", hex_digits("fp").alias("fingerprint"), "component_id", "n_links")


def row_keys() -> list[Column]:
    """Two hashes that tell a row's id and text apart from any other's, nulls included."""
    return [F.xxhash64("doc_id", "text").alias("row_a"),
            F.xxhash64(F.lit(7), "text", "doc_id").alias("row_b")]


def deduplicated(docs: DataFrame, words: int = 3, bits: int = 3) -> DataFrame:
    """``docs`` with one document of each component: the smallest doc_id's.

    Components are those of ``simhash_components``; texts without words are alike. Null
    ids come after every other, and rows of one id go by the hash of their text. Where one
    row is in the table several times, one of them stays. All columns are kept.
    """
    rows = docs.select(*row_keys(), "doc_id", F.col("text").cast("binary").alias("text"))
    prints = parked(mapped(rows, "row_a long, row_b long, doc_id long, fp long", _row_fingerprints, words, at_once=1024), "fingerprints")
    classes = prints.groupBy("fp").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_a", "row_b")).alias("first"))
    roots = components(print_links(prints, bits)).withColumnRenamed("node", "fp")
    first = classes.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(
        F.min("first").alias("first")).select("first.row_a", "first.row_b")
    times = prints.groupBy("row_a", "row_b").agg(F.count("*").alias("times"))
    kept = parked(first.join(times, ["row_a", "row_b"]), "kept")
    found = docs.select(F.struct("*").alias("doc"), *row_keys()).join(kept, ["row_a", "row_b"])
    again = found.where("times > 1").dropDuplicates(["row_a", "row_b"])
    return found.where("times = 1").union(again).select("doc.*")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's SimHash fingerprint and component; see ``simhash_components``."""
    return simhash_components(table(spark, sf_dir, "documents"))
