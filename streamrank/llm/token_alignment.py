"""Alignment of two tokenizers' tokens over the same bytes.

Tokens of A (byte-level) and B (word pieces) are intervals of the bytes of a space and
the text. All intervals are sorted by start, the running maximum of their ends is taken,
and a group ends where a start reaches it; within a group all overlapping pairs of an A
and a B token are links. How many documents link a pair of ids, and which B ids an A id
is linked with most, is counted over the whole corpus.

A unit of text (see ``token_units``) begins and ends with a token of either side, so
intervals are coalesced once for each distinct unit of a chunk of texts. A chunk is a
row: its documents' units and its units' links, packed, and its distinct id pairs. Only
the pairs are shuffled to be counted, and only their counts come back to the chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import give_back, parked, table, tidied
from .token_units import RUN, ByteLevel, UnitEncoder, byte_level, chunks_of, joined, tokenizer_json, units_of

#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20
#: Units whose documents' pairs and texts are worked out together.
BLOCK_UNITS = 1 << 15
#: A pair of ids as one number: the A id is above these bits.
SHIFT = 32
#: What stands for a space in word pieces; texts that hold it are not the same bytes.
SPACE = "▁"

#: What Spark sees of a chunk; the body is for Python alone (see ``packed``).
CHUNKS = "chunk long, body binary, pairs array<long>, pair_docs array<int>"
#: How chunks are stored. A body is compressed already, and both pages and row groups are
#: checked after each row: by default after a hundred, which would be held in memory.
STORED = {
    "compression": "uncompressed", "parquet.block.size": 16 << 20,
    "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1,
}


def piece_model(name: str = "piece_bpe_32k.model") -> bytes:
    """The public piece model; tasks get it with the query, not by path."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


class Pieces(UnitEncoder):
    """Encodes units with the sentencepiece library, which adds their space.

    A unit that its pieces do not spell again, byte for byte, has no ids.
    """

    def __init__(self, model: bytes):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(SPACE in name.lstrip(SPACE) for name in names):
            raise ValueError("the model has pieces that reach across a space")
        spelled = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace(SPACE, " ").encode()
            for i, name in enumerate(names)]
        self.n_bytes = np.array([len(b) for b in spelled], np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n_bytes)])
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        super().__init__()

    def new_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # The library's lists take many times what is kept of them.
        found = [self.spelled_again(units.slice(i, RUN).to_pylist()) for i in range(0, len(units), RUN)]
        counts = np.concatenate([np.zeros(1, np.int64), *(n for _, n in found)])
        return np.concatenate([np.empty(0, np.int64), *(ids for ids, _ in found)]), np.cumsum(counts)

    def spelled_again(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units, end to end, and how many each has."""
        found = self.model.encode(strings, num_threads=1)
        counts = np.fromiter(map(len, found), np.int64, len(found))
        starts = np.concatenate([[0], np.cumsum(counts)])
        flat = np.fromiter(chain.from_iterable(found), np.int64, starts[-1])
        again = joined(self.spelled, self.first, flat)
        if again.tobytes() == "".join([" " + u for u in strings]).encode():
            return flat, counts
        ends = np.concatenate([[0], np.cumsum(self.n_bytes[flat])])[starts]
        same = np.array([again[x:y].tobytes() == b" " + u.encode() for x, y, u in zip(ends, ends[1:], strings)])
        return flat[np.repeat(same, counts)], counts * same


def coalesced(a_bytes: np.ndarray, b_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(group of each A token, group of each B token, A of each link, B of each link).

    The lengths are of tokens that lie end to end, A's and B's over the same bytes.
    """
    a_end, b_end = np.cumsum(a_bytes), np.cumsum(b_bytes)
    a_start, b_start = a_end - a_bytes, b_end - b_bytes
    start, end = np.concatenate([a_start, b_start]), np.concatenate([a_end, b_end])
    order = np.lexsort((np.arange(len(start)), start))
    reach = np.maximum.accumulate(end[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    # Overlaps: the B tokens that end after an A token's start and start before its end.
    low, high = np.searchsorted(b_end, a_start, "right"), np.searchsorted(b_start, a_end, "left")
    n = high - low
    first = np.cumsum(n) - n
    link_b = np.repeat(low - first, n) + np.arange(n.sum())
    return group[:len(a_end)], group[len(a_end):], np.repeat(np.arange(len(n)), n), link_b


def mark(text: str) -> pa.Scalar:
    return pa.scalar(text, pa.large_string())


def _spelled(a_ids, a_group, b_ids, b_group, n_groups: int) -> pa.Array:
    """The text of each group: A's ids with commas, a bar, and B's."""
    sides = []
    for ids, groups in ((a_ids, a_group), (b_ids, b_group)):
        cuts = pa.array(np.searchsorted(groups, np.arange(n_groups + 1)), pa.int64())
        names = pa.array(ids, pa.int64()).cast(pa.large_string())
        sides.append(pc.binary_join(pa.LargeListArray.from_arrays(cuts, names), mark(",")))
    return pc.binary_join_element_wise(*sides, mark("|"))


def _lists(cuts: np.ndarray, values: pa.Array) -> pa.Array:
    """The values between cuts, with semicolons."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(cuts, pa.int64()), values), mark(";"))


def distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def blocks(cuts: np.ndarray, units: int = BLOCK_UNITS) -> Iterator[tuple[int, int]]:
    """Runs of texts of about that many units each; a run ends with the text that fills it."""
    first = 0
    while first < len(cuts) - 1:
        last = min(int(np.searchsorted(cuts, cuts[first] + units)), len(cuts) - 1)
        yield first, last
        first = last


def grouped_units(texts: pa.Array, a: ByteLevel, b: Pieces) -> tuple:
    """(cuts, index, units' A ids and starts, B ids and starts) of texts; spoiled texts have no units."""
    nothing = pa.scalar("", texts.type)
    texts = pc.if_else(pc.fill_null(pc.match_substring(texts, SPACE), False), nothing, texts)
    cuts, index, units = units_of(texts)
    b_ids, b_starts = b.of_units(units)
    lost = np.diff(b_starts) == 0
    if lost[index].any():
        # A text that the pieces do not spell again has no tokens.
        wrong = np.concatenate([[0], np.cumsum(lost[index])])
        cuts, index, units = units_of(pc.if_else(pa.array(wrong[cuts[1:]] > wrong[cuts[:-1]]), nothing, texts))
        b_ids, b_starts = b.of_units(units)
    used = np.zeros(len(units), bool)
    used[index] = True
    if not used.all():
        units, index = units.filter(pa.array(used)), (np.cumsum(used) - 1)[index]
        b_ids, b_starts = b.of_units(units)
    return cuts, index, *a.of_units(units), b_ids, b_starts


def aligned_chunk(texts: pa.Array, a: ByteLevel, b: Pieces) -> dict:
    """What a chunk holds of some texts, but for its number and their ids."""
    cuts, index, a_ids, a_starts, b_ids, b_starts = grouped_units(texts, a, b)
    a_ids, b_ids = a_ids.astype(np.int64), b_ids.astype(np.int64)
    a_group, b_group, link_a, link_b = coalesced(a.n_bytes[a_ids], b.n_bytes[b_ids])

    # Groups, links and their text, by unit: units begin and end with a token.
    n_groups = int(a_group[-1]) + 1 if len(a_group) else 0
    group_starts = np.concatenate([a_group, [n_groups]])[a_starts]
    unit_texts = _lists(group_starts, _spelled(a_ids, a_group, b_ids, b_group, n_groups))
    codes = a_ids[link_a] << SHIFT | b_ids[link_b]
    pairs = distinct(codes)
    link = np.searchsorted(pairs, codes)
    link_starts = np.searchsorted(link_a, a_starts)

    # The same by document.
    total = lambda per_unit: np.diff(np.concatenate([[0], np.cumsum(per_unit[index])])[cuts])
    digests = []
    for first, last in blocks(cuts):
        found = unit_texts.take(pa.array(index[cuts[first]:cuts[last]]))
        digests += [hashlib.sha256(text.as_buffer()).hexdigest() if len(text.as_buffer()) else ""
                    for text in _lists(cuts[first:last + 1] - cuts[first], found)]
    # A document counts once for a pair: its distinct units first, then their distinct pairs.
    n_units, n_pairs, per_unit = max(len(a_starts) - 1, 1), max(len(pairs), 1), np.diff(link_starts)
    pair_docs = np.zeros(len(pairs), np.int64)
    for first, last in blocks(cuts):
        at = np.repeat(np.arange(last - first), np.diff(cuts[first:last + 1]))
        doc, unit = np.divmod(distinct(at * n_units + index[cuts[first]:cuts[last]]), n_units)
        once = distinct(np.repeat(doc, per_unit[unit]) * n_pairs + joined(link, link_starts, unit))
        pair_docs += np.bincount(once % n_pairs, minlength=len(pairs))[:len(pairs)]
    return {
        "n_a": total(np.diff(a_starts)), "n_b": total(np.diff(b_starts)), "n_groups": total(np.diff(group_starts)),
        "n_links": total(per_unit), "groups_sha256": digests, "doc_units": np.diff(cuts), "units": index,
        "unit_links": per_unit, "links": link, "pairs": pairs,
        "pair_docs": pair_docs,
    }


def packed(lists: dict) -> bytes:
    """Lists by name as one compressed batch of a row, numbers no wider than they need be.

    Spark would take a row's millions of numbers apart one by one, and hold many rows of them.
    """
    def narrow(values) -> pa.Array:
        if isinstance(values, np.ndarray):
            values = values.astype(np.min_scalar_type(values.max(initial=0)))
        return pa.array(values)

    columns = [pa.LargeListArray.from_arrays(pa.array([0, len(x)], pa.int64()), x) for x in map(narrow, lists.values())]
    batch = pa.RecordBatch.from_arrays(columns, names=list(lists))
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpacked(body: bytes | pa.Buffer) -> dict[str, pa.Array]:
    """What was ``packed``."""
    batch = pa.ipc.open_stream(body).read_next_batch()
    return {name: batch.column(name)[0].values for name in batch.schema.names}


def aligned(
    docs: DataFrame, definition: str | None = None, model: bytes | None = None, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """Chunks of ``docs`` (doc_id, text), stored: a row as in CHUNKS for about ``chunk_bytes`` of text."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    definition, model, wanted = definition or tokenizer_json(), model or piece_model(), StructType.fromDDL(CHUNKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(wanted, prefers_large_types=False)
        a, b, chunk = byte_level(definition, plain_specials=True), Pieces(model), TaskContext.get().partitionId() << 32
        for ids, texts in chunks_of(batches, chunk_bytes):
            lists = {"doc_id": pa.array(ids, pa.int64())} | aligned_chunk(texts, a, b)
            row = {"chunk": chunk, "pairs": lists.pop("pairs"), "pair_docs": lists.pop("pair_docs")}
            row["body"] = packed(lists)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row[f.name]], type=f.type) for f in schema], schema=schema)
            chunk += 1
            # A chunk takes many times its bytes for a moment; the next one need not wait on top of that.
            del row, lists
            give_back()

    return parked(docs.select("doc_id", "text").mapInArrow(tidied(run), wanted), "aligned-chunks", **STORED)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """pair, n and best: in how many documents a pair is linked, and whether no pair of its A id is in more.

    Chunks have added up their own documents. An A id has no more rows here than B has
    ids, and its best is found by an aggregation that combines before the shuffle.
    """
    found = chunks.select(F.explode(F.arrays_zip("pairs", "pair_docs")).alias("p")).select(
        F.col("p.pairs").alias("pair"), F.col("p.pair_docs").alias("n"))
    counts = parked(found.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")
    a = F.shiftright("pair", SHIFT)
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row, given = unpacked(batch.column("body")[i].as_buffer()), batch.column("answers")[i].values
            answers = given.flatten() if given is not None else [pa.array([], pa.int64())] * 3
            at, n, best = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in answers)
            count, top = np.zeros((2, len(at)), np.int64)
            count[at], top[at] = n, best
            links, index = row["links"].to_numpy(), row["units"].to_numpy()
            unit = np.concatenate([[0], np.cumsum(row["unit_links"].to_numpy().astype(np.int64))])
            cuts = np.concatenate([[0], np.cumsum(row["doc_units"].to_numpy().astype(np.int64))])

            def total(per_pair: np.ndarray) -> np.ndarray:
                per_unit = np.diff(np.concatenate([[0], np.cumsum(per_pair[links])])[unit])
                return np.diff(np.concatenate([[0], np.cumsum(per_unit[index])])[cuts])

            yield pa.RecordBatch.from_arrays(
                [row[n].cast(pa.int64()) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                + [pa.array(total(top)), pa.array(total(count)), row["groups_sha256"]],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def document_alignments(chunks: DataFrame, counts: DataFrame) -> DataFrame:
    """The documents of ``aligned`` chunks, their links measured by ``pair_counts``.

    A frequent pair has a row for each chunk, which Spark may split when it joins, and a
    chunk gets its own pairs back, of which its size bounds the number. Its body is moved
    as it is.
    """
    asked = chunks.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(counts, "pair").groupBy("chunk").agg(
        F.collect_list(F.struct("at", "n", "best")).alias("answers"))
    return chunks.drop("pairs", "pair_docs").join(answers, "chunk", "left").drop("chunk").mapInArrow(
        tidied(_scored), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
                 "groups_sha256 string")


def alignment_groups(docs: DataFrame, definition: str | None = None, model: bytes | None = None) -> DataFrame:
    """doc_id and groups of every row: the aligned ids as text, ``a1,a2|b1;a3|b2,b3``.

    Texts that are null, empty or not spelled again by the pieces have no groups.
    """
    definition, model = definition or tokenizer_json(), model or piece_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = byte_level(definition, plain_specials=True), Pieces(model)
        for ids, texts in chunks_of(batches, CHUNK_BYTES):
            cuts, index, a_ids, a_starts, b_ids, b_starts = grouped_units(texts, a, b)
            a_ids, b_ids = a_ids.astype(np.int64), b_ids.astype(np.int64)
            a_group, b_group, _, _ = coalesced(a.n_bytes[a_ids], b.n_bytes[b_ids])
            n_groups = int(a_group[-1]) + 1 if len(a_group) else 0
            group_starts = np.concatenate([a_group, [n_groups]])[a_starts]
            found = _lists(group_starts, _spelled(a_ids, a_group, b_ids, b_group, n_groups))
            groups = _lists(cuts, found.take(pa.array(index))).cast(pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), groups], names=["doc_id", "groups"])

    return docs.select("doc_id", "text").mapInArrow(tidied(run), "doc_id long, groups string")


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alignment of two public tokenizers over every document.

    Texts that are null, empty or hold U+2581 have no tokens: zeros and an empty digest.
    Long texts are taken whole; rows with one doc_id are documents of their own; an empty
    table gives no rows; other columns are not read.
    """
    chunks = aligned(table(spark, sf_dir, "documents"))
    return document_alignments(chunks, pair_counts(chunks))
