"""Pieces of units: how they are cut, and that the library merges each once."""

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer, models, pre_tokenizers, trainers

from streamrank.llm.token_units import PIECES, ByteLevel, tokenizer_json

ALPHABET = list(" '\n\t\r\x0b\x1c\x85\xa0 　abstd'llveERé漢٣½́​<|>._-1 2\U0001f600\U00050000") + ["  ", " \n", "n't", "word"]


def drawn(n: int, most: int = 14) -> list[str]:
    pick = np.random.default_rng(7)
    return ["".join(pick.choice(ALPHABET, pick.integers(1, most))) for _ in range(n)]


def test_a_piece_is_merged_once_whatever_stands_beside_it():
    encoder, asked = ByteLevel(tokenizer_json()), []
    merge = encoder.of_pieces

    def of_pieces(pieces):
        asked.extend(pieces.to_pylist())
        return merge(pieces)

    encoder.of_pieces = of_pieces
    for text in ("a word here", "a word, here", "a word. (word) word!\nhere", "a word; word\nhere word"):
        assert encoder.ids(pa.array([text]))[0].tolist() == encoder.tokenizer.encode(text).ids
    assert len(asked) == len(set(asked)) and asked.count(" word") == 1


def test_strings_are_cut_as_the_pattern_cuts_them():
    encoder, strings = ByteLevel(tokenizer_json()), [*drawn(20_000), "x" * 50, " ", "\n", "é"]
    for given in (strings, [s for s in strings if s.isascii()], strings[:1], []):
        pieces, cuts = encoder.pieces_of(pa.array(given, pa.large_string()))
        pieces = pieces.to_pylist()
        assert [pieces[a:b] for a, b in zip(cuts, cuts[1:])] == [regex.findall(PIECES, s) for s in given]


def test_letters_that_the_model_lacks():
    small = Tokenizer(models.BPE(unk_token="[UNK]"))
    small.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    small.train_from_iterator(["a word here, a word there"] * 9, trainers.BpeTrainer(
        vocab_size=60, special_tokens=["[UNK]"], show_progress=False))
    encoder, texts = ByteLevel(small.to_str()), ["a word, zz here", "word é qq word", *drawn(300, 40)]
    assert encoder.by_unit and not encoder.spells
    assert [f.tolist() for f in encoder.ids(pa.array(texts))] == [small.encode(t).ids for t in texts]
