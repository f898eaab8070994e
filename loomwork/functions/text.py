"""Text expressions: trimming, splitting into chunks, words."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns texts are cut by, and the characters that count as white space.
_PARAGRAPH = re.compile(r"\n\n+")
_SENTENCE = re.compile("(?<=[.!?])[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")  # Unicode white space
WORD = r"[\p{L}\p{N}_]{2,}"
SPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: str | Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.btrim(text, F.lit(SPACE))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: str | Column) -> Column:
    """Lower-case words of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def hard_split(text: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` characters, each starting ``size − overlap`` after the one before."""
    step = size - overlap if 0 < size - overlap else size
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(step))
    cut = F.transform(starts, lambda s: F.substring(text, s + 1, F.lit(size)))
    return F.when(F.length(text) > 0, cut).otherwise(F.array().cast("array<string>"))


def _merged(pieces: list[str], size: int, overlap: int) -> list[str]:
    """Join pieces into chunks of about ``size`` characters, the tail of a chunk opening the next one.

    The open chunk counts one character per piece for the joining blank, but none after the carried tail; a piece longer
    than ``size`` stays whole. Pieces come stripped, so only a carried tail can begin with a blank: it is counted, then
    left out of the text.
    """
    done, text, used = [], "", 0
    for piece in pieces:
        part = piece.strip(SPACE)
        if not part:
            continue
        more = len(part) + 1
        if not text:
            text, used = part, used + more
        elif used + more > size:
            done.append(text)
            used = min(len(text), overlap) + more
            text = f"{text[-overlap:].lstrip(SPACE)} {part}" if overlap else part
        else:
            text, used = f"{text} {part}", used + more
    return [*done, text] if text else done


def _chunks(text: str | None, size: int, overlap: int) -> list[str]:
    """Chunks of one text; of none where it is missing."""
    if text is None:
        return []
    if len(text) <= size:
        return [text] if text.strip(SPACE) else []
    pieces = _PARAGRAPH.split(text)
    if len(pieces) == 1:
        pieces = _SENTENCE.split(text)
    if len(pieces) > 1:
        return _merged(pieces, size, overlap)
    step = size - overlap if 0 < size - overlap else size
    return [text[s:s + size] for s in range(0, len(text), step)]


def split_text(text: str | Column, size: int = 512, overlap: int = 50) -> Column:
    """Chunks of a whole text: as it is when short, else by paragraphs, else by sentences, else by characters.

    One pass over each text in Python, as the same fold written in SQL functions takes many times longer.
    """
    @F.pandas_udf("array<string>")
    def cut(texts: pd.Series) -> pd.Series:
        return pd.Series([_chunks(t, size, overlap) for t in texts], dtype=object)

    return cut(F.col(text) if isinstance(text, str) else text)
