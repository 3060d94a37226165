"""Repeated passages by relative Lempel-Ziv parsing.

Every document is parsed greedily against an index of all documents: a factor starts
at a word from which ``length`` words also stand earlier (in a smaller doc_id, or
earlier in the same document), and goes on while that holds. The windows that end
beyond a factor's first window are looked up one by one, those across its end included,
so nothing is missed at factor boundaries. Words under factors are duplicates.

The index is built in steps so that little is shuffled. Of each window only the run of
``SEED`` words with the smallest hash, its seed, is announced; equal windows have equal
seeds, and neighbours share theirs. Only windows with a seed that occurs twice are
indexed, by a 128-bit hash, once per document. Each belongs to the smallest doc_id that
has it, and that document is told. Nothing is gathered by window, so a passage in a
third of all documents is one row per task.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_dir
from .common import discard, mapped, parked, table

LENGTH = 20
SEED = 6
#: Fixed odd multipliers of the two rolling hashes.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
LAST = (1 << 63) - 1


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.array([*map(xxhash.xxh64_intdigest, words)], np.uint64)


def rolled(hashes: np.ndarray, length: int, multiplier: int) -> np.ndarray:
    """A hash of each run of ``length`` words, put together from shorter runs."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base, out, done = hashes, None, 0
    power, rest, factor = 1, length, multiplier
    while rest:
        if rest & 1:
            part = base[done:done + n]
            out = part if out is None else out * np.uint64(factor) + part
            done += power
        rest >>= 1
        if rest:
            base = base[:-power] * np.uint64(factor) + base[power:]
            power *= 2
            factor = factor * factor % (1 << 64)
    return out * np.uint64(MULTIPLIERS[0])


def seeds_of(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The seed of each window of ``length`` words, and where in the document it stands."""
    runs = rolled(hashes, SEED, MULTIPLIERS[1])
    if len(hashes) < length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    mixed = (runs ^ (runs >> np.uint64(31))) * np.uint64(MULTIPLIERS[0])
    views = np.lib.stride_tricks.sliding_window_view(mixed, length - SEED + 1)
    places = views.argmin(axis=1) + np.arange(len(views))
    return mixed[places], places


def _seeds(batch: dict[str, list], length: int) -> Iterable[dict]:
    for t1, text in zip(batch["t1"], batch["text"]):
        found, places = seeds_of(word_hashes(words_of(text)), length)
        if len(found):
            # Neighbouring windows share a seed; equal windows have it in two places.
            _, first = np.unique(places, return_index=True)
            seeds, counts = np.unique(found[first], return_counts=True)
            yield {"seed": seeds.view(np.int64), "t1": np.full(len(seeds), t1), "again": counts > 1}


def _indexed(hashes: np.ndarray, shared: list[int] | None, length: int) -> tuple[np.ndarray, ...]:
    """The starts of windows with a shared seed, and their two hashes."""
    if not shared:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    starts = np.nonzero(np.isin(seeds_of(hashes, length)[0], np.array(shared, np.int64).view(np.uint64)))[0]
    return (starts, *(rolled(hashes, length, m)[starts] for m in MULTIPLIERS))


def _windows(batch: dict[str, list], length: int) -> Iterable[dict]:
    for doc, text, shared in zip(batch["doc"], batch["text"], batch["shared"]):
        _, one, two = _indexed(word_hashes(words_of(text)), shared, length)
        if len(one):
            pairs = np.unique(np.stack([one, two], axis=1), axis=0).view(np.int64)
            yield {"one": pairs[:, 0], "two": pairs[:, 1], "doc": np.full(len(pairs), doc)}


def factors(repeats: np.ndarray) -> list[tuple[int, int]]:
    """Greedy factors, as first and last window, of the sorted starts of repeating windows."""
    if not len(repeats):
        return []
    breaks = np.nonzero(np.diff(repeats) > 1)[0]
    firsts = repeats[np.concatenate([[0], breaks + 1])]
    lasts = repeats[np.concatenate([breaks, [len(repeats) - 1]])]
    return [*zip(firsts.tolist(), lasts.tolist())]


def _parsed(batch: dict[str, list], length: int) -> Iterable[dict]:
    out: dict[str, list] = {k: [] for k in ("doc_id", "n_words", "n_removed", "starts", "ends", "kept")}
    for i, text in enumerate(batch["text"]):
        words = words_of(text)
        spans: list[tuple[int, int]] = []
        if batch["is_copy"][i] and len(words) >= length:
            spans = [(0, len(words))]  # the earlier copy is one factor
        elif batch["shared"][i]:
            starts, one, _ = _indexed(word_hashes(words), batch["shared"][i], length)
            _, first = np.unique(one, return_index=True)
            own = np.zeros(len(one), bool)
            own[first] = np.isin(one[first], np.array(batch["own"][i] or [], np.int64).view(np.uint64))
            for a, b in factors(starts[~own]):
                end = b + length
                if spans and a <= spans[-1][1]:
                    a = spans.pop()[0]
                spans.append((a, end))
        kept, at = [], 0
        for a, b in spans:
            kept += words[at:a]
            at = b
        kept += words[at:]
        out["doc_id"].append(batch["doc_id"][i])
        out["n_words"].append(len(words))
        out["n_removed"].append(len(words) - len(kept))
        out["starts"].append([a for a, _ in spans])
        out["ends"].append([b for _, b in spans])
        out["kept"].append(b" ".join(kept).decode())
    yield out


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_words, n_removed, starts, ends, kept for each row of ``docs`` (doc_id, text).

    ``starts`` and ``ends`` are the duplicate spans in words, ``kept`` the words outside
    them, joined by single spaces. Words are runs without ASCII white space; null texts
    have none. Null doc_ids come after all others and count as one. Rows that share
    doc_id and text are one document and get the same result, and rows that share a
    doc_id only are judged as if each were that document. Windows are judged on the
    input. Other columns are left out.
    """
    if length < SEED:
        raise ValueError(f"windows need {SEED} words at least")
    rows = docs.select(
        "doc_id", F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("t1"),
        F.xxhash64(F.lit(1), "text").alias("t2"), F.col("text").cast("binary").alias("text"))
    spark = docs.sparkSession
    place = shared_dir(spark, "seeds")
    seeds = parked(mapped(rows.select("t1", "text"), "seed long, t1 long, again boolean", _seeds, length), "seeds", place)
    # In two texts, or in two places of one; copies of a text are no news.
    twice = seeds.groupBy("seed").agg(
        F.min("t1").alias("low"), F.max("t1").alias("high"), F.max("again").alias("again")
    ).where("low <> high or again").select("seed")
    shared = seeds.join(twice, "seed").groupBy("t1").agg(F.collect_set("seed").alias("shared"))
    # Of the copies of a whole text the first one stands for all.
    names = rows.select("doc", "t1", "t2").distinct()
    first = names.groupBy("t1", "t2").agg(F.min("doc").alias("first"))
    known = names.join(first, ["t1", "t2"]).select("doc", "t1", "t2", (F.col("doc") > F.col("first")).alias("is_copy"))
    known = parked(known.join(shared, "t1", "left").withColumn(
        "shared", F.when(~F.col("is_copy"), F.col("shared"))), "known")
    discard(spark, place)
    leading = known.where("shared is not null").select("doc", "t1", "t2", "shared")
    # The texts are dealt out once: both joins below read the same columns by the same keys.
    found = mapped(rows.join(leading, ["doc", "t1", "t2"]).select("doc_id", "doc", "text", "shared"),
                   "one long, two long, doc long", _windows, length)
    owners = found.groupBy("one", "two").agg(F.min("doc").alias("doc"))
    own = owners.groupBy("doc").agg(F.collect_set("one").alias("own"))
    told = known.join(own, "doc", "left")
    return mapped(
        rows.join(told, ["doc", "t1", "t2"]).select("doc_id", "text", "is_copy", "shared", "own"),
        "doc_id long, n_words long, n_removed long, starts array<long>, ends array<long>, kept string",
        _parsed, length)


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    parsed = remove_repeats(table(spark, sf_dir, "documents"))
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
