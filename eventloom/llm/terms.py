"""Cutting texts into terms on their UTF-8 bytes, a column at a time.

What separates terms is ASCII, so that a byte alone tells whether it belongs to one: every byte
of other scripts can be given either way by a table of 256 entries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut at a time, at least one text.
PIECE = 4 << 20

#: ASCII letters and other scripts.
LETTERS = np.array([b >= 0x80 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])
#: All but the six ASCII white space characters.
BLACK = np.array([not (b == 0x20 or 0x09 <= b <= 0x0D) for b in range(256)])
#: A-Z to a-z and nothing else.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def pieces(batch: pa.RecordBatch | pa.Table, column: str = "text", size: int | None = None) -> Iterator[pa.RecordBatch | pa.Table]:
    """``batch`` in slices of about ``size`` bytes of ``column``."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    part = np.cumsum(np.asarray(sizes), dtype=np.int64) // (size or PIECE)
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            yield batch.slice(a, b - a)


def cut(texts: pa.Array | pa.ChunkedArray, member: np.ndarray, fold: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of every term in ``texts`` in order: its row and its number in the distinct terms, which come third (binary).

    Terms are the longest runs of ``member`` bytes; ``fold`` maps their bytes. A null text has none.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays([c.cast(pa.large_binary()) for c in texts.chunks]) if texts.num_chunks else pa.array([], pa.large_binary())
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(offsets) or offsets[0] == offsets[-1]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), pa.array([], pa.large_binary())
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inside = member[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    # A term ends where its text does.
    heads = offsets[:-1][np.diff(offsets) > 0]
    first[heads] = inside[heads]
    last[heads[1:] - 1] = inside[heads[1:] - 1]
    starts = np.flatnonzero(first)
    ends = np.cumsum(np.flatnonzero(last) + 1 - starts)
    # The last of rows that begin at one place is the one with text.
    rows = np.searchsorted(offsets, starts, side="right") - 1
    spots = np.concatenate([[0], ends]).astype(np.int64)
    kept = data[inside] if fold is None else fold[data[inside]]
    terms = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(spots), pa.py_buffer(kept)])
    coded = terms.dictionary_encode()
    return rows, coded.indices.to_numpy().astype(np.int64), coded.dictionary
