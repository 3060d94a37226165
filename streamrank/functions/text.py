"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NOT_WORD = r"(?U)\W+"  # Unicode classes: letters of every script belong to words


def is_blank(text: Column) -> Column:
    """True for null, empty, or whitespace-only text."""
    return text.isNull() | text.rlike(r"^\s*$")


def split_words(line: Column) -> Column:
    """Lower-cased words of a line, as pieces between runs of non-word characters."""
    return F.split(F.lower(line), NOT_WORD)


def drop_trailing_empty(pieces: Column) -> Column:
    """Remove the empty piece a closing separator leaves; keep a leading one.

    The pieces between separators are never empty themselves, so only the first
    and the last can be. A line with no separator at all is kept as it is, even
    when it is the empty line; a line of separators only has no pieces.
    """
    size = F.size(pieces)
    ends_empty = (size > 1) & (F.element_at(pieces, -1) == "")
    only_separators = (size == 2) & (F.element_at(pieces, 1) == "")
    return F.when(
        ends_empty, F.slice(pieces, 1, F.when(only_separators, 0).otherwise(size - 1))
    ).otherwise(pieces)
