"""Cutting texts into overlapping chunks."""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Chunk size and overlap in characters, and the order of separators.
CHUNK_SIZE = 2048
CHUNK_OVERLAP = 256
SEPARATORS = ("\n\n", "\n", " ", "")


def fixed_chunks(text: Column | str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP) -> Column:
    """Array of chunks of `size` characters, each starting `size - overlap` after the last."""
    column = F.col(text) if isinstance(text, str) else text
    starts = F.sequence(F.lit(0), F.length(column) - 1, F.lit(size - overlap))
    chunks = F.transform(starts, lambda i: F.substring(column, i + 1, F.lit(size)))
    return F.when(F.length(column) > 0, chunks)


def _pack(pieces: list[str], joint: str, size: int, overlap: int) -> list[str]:
    """Join neighbouring pieces into chunks up to `size`, repeating up to `overlap` characters."""
    chunks: list[str] = []
    held: deque[str] = deque()
    length = 0  # of the held pieces, joined

    def longer_by(piece: str) -> int:
        return len(piece) + (len(joint) if held else 0)

    def close() -> None:
        chunk = joint.join(held).strip()
        if chunk:
            chunks.append(chunk)

    for piece in pieces:
        if held and length + longer_by(piece) > size:
            close()
            while held and (length > overlap or length + longer_by(piece) > size):
                length -= len(held.popleft())
                length -= len(joint) if held else 0
        length += longer_by(piece)
        held.append(piece)
    close()
    return chunks


def split_text(
    text: str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    separators: tuple[str, ...] = SEPARATORS,
) -> list[str]:
    """Chunks of at most `size` characters, cut at paragraphs, else lines, words, characters."""
    level = next(i for i, s in enumerate(separators) if s in text)
    joint, finer = separators[level], separators[level + 1 :]
    pieces = [p for p in text.split(joint) if p] if joint else list(text)
    chunks: list[str] = []
    short: list[str] = []
    for piece in pieces:
        if len(piece) < size or not finer:
            short.append(piece)
            continue
        chunks += _pack(short, joint, size, overlap)
        short = []
        chunks += split_text(piece, size, overlap, finer)
    return chunks + _pack(short, joint, size, overlap)


def recursive_chunks(size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP):
    """`split_text` as an Arrow-batched column function: text -> array of chunks."""

    @F.pandas_udf("array<string>")
    def chunked(texts: pd.Series) -> pd.Series:
        return texts.map(lambda text: split_text(text, size, overlap), na_action="ignore")

    return chunked
