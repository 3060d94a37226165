"""Texts as indices into their distinct units, so that each unit is looked at once.

A unit begins at a space that follows no space and that a visible character follows.
Neither byte-level pieces (which take one space before a word, and leave a run of white
space at its last one) nor word pieces (which hold spaces at their beginning only) reach
across such a place, so the tokens of a text are those of its units, end to end.

The byte-level encoder cuts units on into pieces and remembers these: words with and
without a comma are many units, but few pieces.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Characters of text that are looked at together; a longer text is taken whole.
CHUNK_CHARS = 1 << 21
#: Bytes of units or pieces and their ids a task keeps from one chunk to the next.
REMEMBERED_BYTES = 12 << 20
#: Units or pieces that are encoded at a time.
RUN = 1 << 13
#: Fixed: how byte-level tokenizers of this kind cut a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Kinds of characters that pieces tell apart; from SPACE on they are white space.
LETTER, NUMBER, OTHER, QUOTE, SPACE, BLANK = range(6)
#: The planes of Unicode that hold scripts; characters beyond them are left to the pattern.
SCRIPTS = 0x40000

_CUT = re.compile(r"(?<=[^ ]) (?=\S)")


def tokenizer_json(name: str = "byte_bpe_50k.json") -> str:
    """The public tokenizer's definition; tasks get it with the query, not by path."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


def chunks_of(
    batches: Iterable[pa.RecordBatch], chars: int = CHUNK_CHARS
) -> Iterator[tuple[list, pa.StringArray]]:
    """Ids and texts of (id, text) batches, in chunks of about ``chars`` bytes of text.

    A chunk ends with the text that fills it, so it holds at most one text beyond them.
    """
    ids: list = []
    held: list[pa.Array] = []
    size = 0
    for batch in batches:
        texts = batch.column(1)
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
        ends = size + np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < len(texts):
            cut = min(int(np.searchsorted(ends, chars)) + 1, len(texts))
            ids += batch.column(0).slice(start, cut - start).to_pylist()
            held.append(texts.slice(start, cut - start).cast(pa.large_string()))
            size = int(ends[cut - 1])
            if size >= chars:
                yield ids, pa.concat_arrays(held)
                ids, held, ends, size = [], [], ends - size, 0
            start = cut
    if ids:
        yield ids, pa.concat_arrays(held)


def units_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(offsets, indices, units): the units of text i are units[indices[offsets[i]:offsets[i + 1]]].

    Every unit but a text's first has lost the space that it begins with. A null or an
    empty text has no units.
    """
    full = pc.fill_null(texts, "")
    parts = pc.split_pattern(full, " ")
    cuts = parts.offsets.to_numpy().astype(np.int64)
    words = parts.values.dictionary_encode()
    index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    units = words.dictionary
    # Where a space has white space beside it the text is cut by the full rule.
    odd = begins_blank(units)
    empty = pc.equal(full, "").to_numpy(zero_copy_only=False)
    marks = np.concatenate([[0], np.cumsum(odd[index])])
    troubled = np.flatnonzero((marks[cuts[1:]] > marks[cuts[:-1]]) | empty)
    if not len(troubled):
        return cuts, index, units
    lengths = np.diff(cuts)
    again = [[] if empty[i] else _CUT.split(full[i].as_py()) for i in troubled.tolist()]
    lengths[troubled] = [len(found) for found in again]
    plain = pc.take(units, pa.array(index))
    runs, last = [], 0
    for i, found in zip(troubled.tolist(), again):
        runs += [plain.slice(last, cuts[i] - last), pa.array(found, units.type)]
        last = cuts[i + 1]
    words = pa.concat_arrays([*runs, plain.slice(last)]).dictionary_encode()
    index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return np.concatenate([[0], np.cumsum(lengths)]), index, words.dictionary


def begins_blank(units: pa.Array) -> np.ndarray:
    """Which strings are empty or begin with white space."""
    first = pc.utf8_slice_codeunits(units, 0, 1)
    return pc.or_(pc.equal(first, ""), pc.utf8_is_space(first)).to_numpy(zero_copy_only=False)


def joined(flat: np.ndarray, starts: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """The runs ``flat[starts[i]:starts[i + 1]]`` of the chosen i, end to end."""
    lengths = np.diff(starts)[chosen]
    ends = np.cumsum(lengths)
    if not len(ends):
        return flat[:0]
    return flat[np.repeat(starts[chosen] - ends + lengths, lengths) + np.arange(ends[-1])]


def byte_letters() -> dict[int, str]:
    """The character that stands for each byte: itself where it is visible, else the next from 256 on."""
    visible = [b for b in range(256) if 33 <= b < 127 or 161 <= b < 173 or b > 173]
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def kinds() -> np.ndarray:
    """The kind of each code point; QUOTE is what only the pattern can cut."""
    made = np.full(0x110000, QUOTE, np.uint8)
    made[:SCRIPTS] = OTHER
    for found in regex.finditer(r"(\p{L}+)|(\p{N}+)|(\s+)", "".join(map(chr, range(SCRIPTS)))):
        made[slice(*found.span())] = (LETTER, NUMBER, BLANK)[found.lastindex - 1]
    made[ord("'")], made[ord(" ")] = QUOTE, SPACE
    return made


def spaced(units: pa.Array) -> pa.Array:
    """The units with the space that each begins with."""
    return pc.binary_join_element_wise(*(
        pa.scalar(x, units.type) if x is not None else units for x in ("", None, " ")))


def end_to_end(strings: pa.Array) -> str:
    """The strings as one, without making a Python string of each."""
    whole = pa.LargeListArray.from_arrays(pa.array([0, len(strings)], pa.int64()), strings)
    return pc.binary_join(whole, pa.scalar("", strings.type))[0].as_py()


class UnitEncoder:
    """Token ids of units (or other strings), each distinct one encoded once while it is remembered.

    What is remembered is bounded. The object belongs to a task, or to a process (``byte_level``).
    """

    def __init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.units = pa.array([], pa.large_string())
        self.flat, self.starts = np.empty(0, "<u4"), np.zeros(1, np.int64)

    def new_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of units that are not remembered."""
        raise NotImplementedError

    def of_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if self.units.nbytes + self.flat.nbytes + self.starts.nbytes > REMEMBERED_BYTES:
            self.forget()
        place = pc.index_in(units, value_set=self.units)
        new = units.filter(pc.is_null(place))
        if len(new):
            ids, starts = self.new_units(new)
            known = len(self.units)
            self.units = pa.concat_arrays([self.units, new])
            self.starts = np.concatenate([self.starts, starts[1:] + len(self.flat)])
            self.flat = np.concatenate([self.flat, ids.astype("<u4", copy=False)])
            fresh = pc.cumulative_sum(pc.is_null(place).cast(pa.int32()))
            place = pc.coalesce(place, pc.add(fresh, known - 1))
        place = place.to_numpy(zero_copy_only=False)
        return joined(self.flat, self.starts, place), np.concatenate([[0], np.cumsum(np.diff(self.starts)[place])])


class ByteLevel(UnitEncoder):
    """Encodes texts with the tokenizers library, each distinct piece once while it is remembered.

    Tokenizers that do not work by the fixed pieces get every text as it is.
    """

    def __init__(self, definition: str, plain_specials: bool = False):
        from tokenizers import Tokenizer

        # Spark runs a task per core; the library's threads would only add to them.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = plain_specials
        made = json.loads(definition)
        before = made.get("pre_tokenizer") or {}
        self.by_unit = (
            made.get("normalizer") is None and before.get("type") == "ByteLevel"
            and not before.get("add_prefix_space") and before.get("use_regex", True)
            and not made.get("truncation") and not made.get("padding")
        )
        self.cut = regex.compile(PIECES).findall
        self.letters, self.kinds = byte_letters(), kinds() if self.by_unit else None
        # The model alone, for pieces that are cut and spelled already.
        self.bare = Tokenizer(self.tokenizer.model)
        self.special = [] if plain_specials else [t["content"] for t in made.get("added_tokens", [])]
        # One character of a byte-level token stands for one byte.
        vocabulary = self.tokenizer.get_vocab(True)
        self.n_bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.n_bytes[list(vocabulary.values())] = [len(token) for token in vocabulary]
        # Whether the tokens of a piece have just its bytes.
        model = made["model"]
        self.spells = model.get("type") == "BPE" and all(x in model["vocab"] for x in self.letters.values()) and not any(
            model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
        super().__init__()

    def one(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def of_pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of distinct pieces: their bytes' characters, end to end, are what the model merges."""
        ends = np.cumsum(pc.binary_length(pieces).to_numpy(), dtype=np.int64)
        spelled = end_to_end(pieces).encode().decode("latin1").translate(self.letters)
        names = [spelled[i:j] for i, j in pairwise([0, *ends.tolist()])]
        runs, counts = [np.empty(0, "<u4")], [np.zeros(1, np.int64)]
        for i in range(0, len(names), RUN):
            if self.spells:
                # One answer for a run is cheaper; the tokens' bytes tell where a piece ends.
                found, = self.bare.encode_batch_fast([names[i:i + RUN]], is_pretokenized=True, add_special_tokens=False)
                runs.append(np.array(found.ids, "<u4"))
                lasts = np.searchsorted(np.cumsum(self.n_bytes[runs[-1]]), ends[i:i + RUN] - (ends[i - 1] if i else 0))
                counts.append(np.diff(lasts, prepend=-1))
            else:
                found = list(map(self.bare.model.tokenize, names[i:i + RUN]))
                counts.append(np.array([len(tokens) for tokens in found], np.int64))
                runs.append(np.array([token.id for token in chain.from_iterable(found)], "<u4"))
        return np.concatenate(runs), np.cumsum(np.concatenate(counts))

    def new_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.of_pieces(units)

    def pieces_of(self, strings: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(pieces, cuts): the pieces of string i are ``pieces[cuts[i]:cuts[i + 1]]``.

        A piece ends where the kind of character changes, but for a space, which belongs to
        what follows. That is decided for all strings at once; the pattern cuts strings with
        apostrophes, inner spaces or runs of white space.
        """
        offsets = np.concatenate([[0], np.cumsum(pc.binary_length(strings).to_numpy(), dtype=np.int64)])
        whole = end_to_end(strings)
        text = whole.encode()
        data = np.frombuffer(text, np.uint8)
        lead = data & 0xC0 != 0x80
        kind = self.kinds[np.frombuffer(whole.encode("utf-32-le"), "<u4")]
        if len(kind) < len(data):
            kind = kind[np.cumsum(lead) - 1]
        begins = np.zeros(len(data) + 1, bool)
        begins[offsets] = True
        begins = begins[:-1]
        edges = begins.copy()
        edges[1:] |= (kind[1:] != kind[:-1]) & (kind[:-1] != SPACE)
        odd = (kind == QUOTE) | (kind == SPACE) & ~begins
        odd[1:] |= (kind[1:] >= SPACE) & (kind[:-1] >= SPACE) & lead[1:] & ~begins[1:]
        hard = np.diff(np.concatenate([[0], np.cumsum(odd)])[offsets]) > 0
        if hard.any():
            found = chain.from_iterable(map(self.cut, strings.filter(pa.array(hard)).to_pylist()))
            ends = np.cumsum(pc.binary_length(pa.array(found, pa.large_string())).to_numpy())
            own = np.zeros(ends[-1] + 1, bool)
            own[0] = own[ends] = True
            edges[np.repeat(hard, np.diff(offsets))] = own[:-1]
        bounds = np.concatenate([np.flatnonzero(edges), [len(data)]])
        pieces = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(text))
        return pieces, np.concatenate([[0], np.cumsum(edges)])[offsets]

    def of_strings(self, strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of strings, each distinct piece encoded once while it is remembered."""
        pieces, cuts = self.pieces_of(strings)
        words = pieces.dictionary_encode()
        index = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        flat, starts = super().of_units(words.dictionary)
        return joined(flat, starts, index), np.concatenate([[0], np.cumsum(np.diff(starts)[index])])[cuts]

    def of_units(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, starts) of units with the spaces that they begin with."""
        return self.of_strings(spaced(units))

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; null is empty."""
        texts = texts.cast(pa.large_string())
        if not self.by_unit:
            return [self.one(text or "") for text in texts.to_pylist()]
        holds = np.zeros(len(texts), bool)
        for special in self.special:
            holds |= pc.fill_null(pc.match_substring(texts, special), False).to_numpy(zero_copy_only=False)
        cuts, index, units = units_of(pc.if_else(pa.array(holds), pa.scalar("", texts.type), texts))
        # A text's first unit has no space before it.
        used = cuts[:-1][np.diff(cuts) > 0]
        firsts, place = np.unique(index[used], return_inverse=True)
        index[used] = len(units) + place
        flat, starts = self.of_strings(pa.concat_arrays([spaced(units), units.take(pa.array(firsts))]))
        found = joined(flat, starts, index)
        ends = np.concatenate([[0], np.cumsum(np.diff(starts)[index])])[cuts].tolist()
        out = [found[a:b] for a, b in zip(ends, ends[1:])]
        for i in np.flatnonzero(holds).tolist():
            out[i] = self.one(texts[i].as_py())
        return out


def byte_level(definition: str, plain_specials: bool = False) -> ByteLevel:
    """The encoder of a definition, kept for later tasks of the process with what it remembers.

    A process keeps the last one only. It lies with the library, which stays while this
    code comes anew with every task.
    """
    import tokenizers

    kept = tokenizers.__dict__.setdefault("_kept_unit_encoder", {})
    name = hashlib.md5(definition.encode()).hexdigest(), plain_specials
    if name not in kept:
        kept.clear()
        kept[name] = ByteLevel(definition, plain_specials)
    return kept[name]
