"""What tasks keep, and how much they encode and align at a time."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from streamrank.llm import token_alignment, token_units
from streamrank.llm.token_alignment import Pieces, aligned, aligned_chunk, blocks, packed, piece_model, unpacked
from streamrank.llm.token_units import ByteLevel, byte_level, tokenizer_json


def words(n: int, seed: int = 3) -> list[str]:
    pick = random.Random(seed)
    return ["".join(pick.choices("etaoinshrdé1,", k=pick.randrange(1, 9))) for _ in range(n)]


def test_pieces_are_encoded_in_runs():
    """The library's lists of a whole chunk's units took more memory than the chunk."""
    pieces = Pieces(piece_model())
    given, model = sorted({*words(20_000), "a ▁b"}), pieces.model

    class Counting:
        seen: list[int] = []

        def encode(self, strings, num_threads):
            self.seen.append(len(strings))
            return model.encode(strings, num_threads=num_threads)

    expected = [model.encode(w) if model.decode(model.encode(w)) == w and "▁" not in w else None for w in given]
    pieces.model = Counting()
    flat, starts = pieces.new_units(pa.array(given, pa.large_string()))
    assert max(Counting.seen) <= token_units.RUN < sum(Counting.seen) == len(given)
    for want, a, b in zip(expected, starts, starts[1:]):
        if want is not None:
            assert flat[a:b].tolist() == want


def test_blocks_of_documents_give_what_a_chunk_gives(monkeypatch):
    pick, known = random.Random(4), words(300)
    texts = ["", None, *(" ".join(pick.choices(known, k=pick.randrange(1, 60))) for _ in range(80)), "", " "]
    a, b = ByteLevel(tokenizer_json(), plain_specials=True), Pieces(piece_model())

    def rows(size: int) -> dict:
        monkeypatch.setattr(token_alignment.blocks, "__defaults__", (size,))
        return {k: list(v) for k, v in aligned_chunk(pa.array(texts, pa.large_string()), a, b).items()}

    assert rows(1) == rows(50) == rows(1 << 30)
    cuts = np.array([0, 0, 3, 3, 9, 10, 10])
    assert list(blocks(cuts, 4)) == [(0, 4), (4, 6)]


def test_a_process_keeps_its_encoder():
    definition = tokenizer_json()
    first = byte_level(definition)
    text = pa.array(["once upon a midnight dreary"])
    ids = first.ids(text)[0]
    assert byte_level(definition) is first
    assert len(first.units) and (first.ids(text)[0] == ids).all()
    assert ids.tolist() == first.tokenizer.encode(text[0].as_py(), add_special_tokens=False).ids
    assert byte_level(definition, plain_specials=True) is not first


def test_pieces_of_units_are_the_tokenizers_own():
    encoder, given = ByteLevel(tokenizer_json()), sorted(set(words(9_000, seed=9)))
    flat, starts = encoder.of_pieces(pa.array([" " + w for w in given], pa.large_string()))
    for w, i, j in list(zip(given, starts, starts[1:]))[::37]:
        merged = [t.id for t in encoder.tokenizer.model.tokenize((" " + w).encode().decode("latin1").translate(encoder.letters))]
        assert flat[i:j].tolist() == merged


def test_packing_keeps_every_value():
    lists = {
        "doc_id": pa.array([None, -1, 1 << 62], pa.int64()), "units": np.array([0, 255, 256, 65_535, 65_536]),
        "links": np.array([1 << 32]), "unit_links": np.zeros(0, np.int64), "groups_sha256": ["", "ab", "é"],
    }
    again = unpacked(packed(lists))
    assert {k: v.to_pylist() for k, v in again.items()} == {
        k: v.to_pylist() if isinstance(v, pa.Array) else list(v) for k, v in lists.items()}
    assert [again[k].type for k in ("units", "links", "unit_links")] == [pa.uint32(), pa.uint64(), pa.uint8()]


def test_spark_moves_a_chunks_numbers_packed(spark):
    """Lists of a chunk's units and links, as rows, took most of an executor's memory."""
    pick, known = random.Random(5), words(300)
    texts = [" ".join(pick.choices(known, k=2_000)) for _ in range(20)] + ["", None]
    chunks = aligned(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1))
    assert chunks.dtypes == [
        ("chunk", "bigint"), ("body", "binary"), ("pairs", "array<bigint>"), ("pair_docs", "array<int>")]
    stored, = chunks.collect()
    found = {k: v.to_pylist() for k, v in unpacked(bytes(stored.body)).items()}
    expected = {k: list(v) for k, v in aligned_chunk(
        pa.array(texts, pa.large_string()), ByteLevel(tokenizer_json(), plain_specials=True), Pieces(piece_model())).items()}
    assert found | {"pairs": stored.pairs, "pair_docs": stored.pair_docs} == expected | {"doc_id": list(range(22))}
    assert len(stored.body) < 2 * (len(found["units"]) + len(found["links"]))


def test_chunks_are_stored_in_small_row_groups(spark, monkeypatch):
    """Writers and readers hold a row group, which was of a hundred chunks at least."""
    monkeypatch.setitem(token_alignment.STORED, "parquet.block.size", 1 << 12)
    docs = spark.createDataFrame([(i, " ".join(words(200, seed=i))) for i in range(24)], "doc_id long, text string")
    chunks = aligned(docs.coalesce(1), chunk_bytes=500)
    file, = chunks.inputFiles()
    stored = pq.ParquetFile(file.removeprefix("file://")).metadata
    assert stored.num_rows == 24 and stored.num_row_groups > 6
    assert {stored.row_group(0).column(i).compression for i in range(stored.num_columns)} == {"UNCOMPRESSED"}
