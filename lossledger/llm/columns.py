"""Helpers on text columns that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Arrow batches are worked on in slices of about so many bytes of text; one longer text is a slice of its own.
SLICE_BYTES = 2_000_000
#: For work that holds many numbers for each byte and gains nothing from larger slices.
SHORT_SLICE = 500_000
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: What parts words once a text is in lower case: all ASCII but letters and digits.
_MARKS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])


def text_of(df: DataFrame) -> Column:
    """The text as UTF-8 bytes; null is empty."""
    return F.coalesce(df["text"].cast("string"), F.lit("")).cast("binary")


def flat(array: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in one array, and the offsets of its values in it."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary()).fill_null(b"")
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each part holds at most ``most`` bytes of text, or one row."""
    for batch in batches:
        _, offsets = flat(batch.column(batch.schema.get_field_index(text)))
        at, n = 0, batch.num_rows
        while at < n:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, min(end, n) - at)
            at = min(end, n)


def word_spans(data: np.ndarray, offsets: np.ndarray, parts: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; words end where their row ends. Bytes in ``parts`` part words: by default those
    of ``[\\x20\\x09-\\x0D]``."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~parts[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    starts = np.flatnonzero(inside & (~before | cut[:-1]))
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, in lower case and without marks, and where each text's words begin (one more
    entry at the end)."""
    from lossledger.llm.hashing import Spans

    data, offsets = flat(pc.utf8_lower(texts.cast(pa.large_string())).cast(pa.large_binary()))
    starts, ends, row = word_spans(data, offsets, _MARKS)
    return Spans(data).hash(starts, ends), np.searchsorted(row, np.arange(len(texts) + 1))
