"""Finding long repeats by anchors: what word and byte repeats have in common.

A text is a sequence of units. Anchors are short spans at places chosen so that any two equal windows hold an anchor at
the same place in them. Anchors with equal hashes meet in a bucket; those whose whole context (every window around the
anchor) is equal too are settled there. Only anchors that meet others in a different context, at the ends of a repeat, are
looked at more closely, from the text.

Between the steps travel packed arrays, one row for each bucket and slice of text, so that a row's overhead is paid once
for hundreds of anchors. The number of buckets follows the amount of text. A key that is common in one slice sends a few
of its anchors to its bucket; the others are marked for the closer look at once, so no key gathers all its anchors.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.llm.hashing import Spans, mix
from lossledger.sources.tables import materialise

#: Text for each bucket of anchors, and for each bucket of documents, in bytes.
ANCHOR_BUCKET = 2_000_000
TEXT_BUCKET = 6_000_000
#: Contexts of one key that a slice sends to the key's bucket.
COMMON = 8

COVERED, OPEN = 0, 1
PACKED = "bucket int, payload binary"


# --- packed arrays -------------------------------------------------------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length; integers that count something are stored compressed, hashes as they are."""
    parts, head = [], [len(arrays), len(arrays[0])]
    for a in arrays:
        raw = a.tobytes() if a.dtype.kind == "V" or a.dtype.itemsize == 1 else np.diff(a, prepend=a.dtype.type(0)).tobytes() if a.dtype == np.int64 else a.tobytes()
        raw = zstandard.ZstdCompressor(level=1).compress(raw) if a.dtype.kind == "i" or a.dtype.itemsize == 1 else raw
        parts.append(raw)
        head += [_CODES.index(a.dtype.str), len(raw)]
    return np.array(head, "<i8").tobytes() + b"".join(parts)


_CODES = ["<u8", "<i8", "<i4", "|u1"]


def unpack(payload: bytes) -> list[np.ndarray]:
    n_arrays, n = np.frombuffer(payload, "<i8", 2)
    head, at = np.frombuffer(payload, "<i8", 2 * n_arrays, 16), 16 + 16 * n_arrays
    out = []
    for code, size in head.reshape(-1, 2).tolist():
        raw, kind = payload[at : at + size], np.dtype(_CODES[code])
        raw = zstandard.ZstdDecompressor().decompress(raw, int(n) * kind.itemsize or 1) if kind.kind == "i" or kind.itemsize == 1 else raw
        a = np.frombuffer(raw, kind)
        out.append(np.cumsum(a) if kind == np.int64 else a)
        at += size
    return out


def gather(payloads: pa.ChunkedArray | list, n_arrays: int) -> list[np.ndarray]:
    """The arrays of all payloads, one after the other."""
    all_arrays = [unpack(p if isinstance(p, bytes) else p.as_py()) for p in payloads]
    if not all_arrays:
        return [np.zeros(0, np.int64)] * n_arrays
    return [np.concatenate(a) for a in zip(*all_arrays)]


def by_bucket(bucket: np.ndarray, *arrays: np.ndarray) -> list[tuple[int, bytes]]:
    """One packed row for each bucket."""
    if not len(bucket):
        return []
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    return [(int(bucket[part[0]]), pack(*(a[order[part]] for a in arrays))) for part in np.split(np.arange(len(bucket)), cuts)]


def table_of(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b for b, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())], ["bucket", "payload"])


def text_bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def packed_for_text(ids: np.ndarray, buckets: int, *arrays: np.ndarray) -> list[tuple[int, bytes]]:
    """Rows for the documents' own buckets. They have numbers below zero, to tell them from buckets of keys."""
    return by_bucket(-1 - text_bucket(ids, buckets), ids.astype(np.int64), *arrays)


# --- documents -----------------------------------------------------------------------------------------------------


def numbered(docs: DataFrame, keep: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """(id, doc_id, text as bytes) with a distinct id that keeps the order of doc_id, and the bytes of all text. Columns
    in ``keep`` come along in one column ``_keep``.

    Usually doc_id is that id. If it holds nulls or repeats, rows are sorted (nulls first, then by text) and numbered. They
    are dealt out by the beginnings of texts, so the sample that sets the ranges holds no whole ones.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    more = [F.struct(*keep).alias("_keep")] if keep else []
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), *more)
    seen = plain.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("bytes"))
    total = seen.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.count_if(F.col("doc_id").isNull()).alias("nulls")).first()
    if total["most"] <= 1 and not total["nulls"]:
        return plain.select(F.col("doc_id").alias("id"), "*"), total["bytes"]
    by_doc = F.col("doc_id").asc_nulls_first()
    keyed = plain.repartitionByRange(by_doc, F.substring("text", 1, 64)).sortWithinPartitions(by_doc, "text")
    return materialise(keyed.select(F.monotonically_increasing_id().alias("id"), "*"), "numbered"), total["bytes"]


def buckets_for(size: int, each: int) -> int:
    return max(1, -(-size // each))


# --- anchors -------------------------------------------------------------------------------------------------------


class Context:
    """How far the windows around an anchor reach: ``left`` units before it and ``window`` units from it on."""

    def __init__(self, window: int, left: int):
        self.window, self.left = window, left

    def of(self, spans: Spans, at: np.ndarray, row: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Hash of everything that windows around each anchor hold, and where the anchor lies in it."""
        starts = np.maximum(at[row], place - self.left)
        ends = np.minimum(at[row + 1], place + self.window)
        return mix(spans.hash(starts, ends) + (place - starts).astype(np.uint64))


def settle(key: np.ndarray, context: np.ndarray, ids: np.ndarray, place: np.ndarray, common: np.ndarray | None = None):
    """Sort anchors by key, context, document and place. Returns that order, and in it: whether an anchor is the first of
    its context, how many share the context, whether its key has several contexts (or is ``common``), and how many."""
    order = np.lexsort((place, ids, context, key))
    key, context = key[order], context[order]
    new_key = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    first = new_key | np.r_[True, context[1:] != context[:-1]] if len(key) else np.zeros(0, bool)
    class_of, key_of = np.cumsum(first) - 1, np.cumsum(new_key) - 1
    members = np.bincount(class_of)[class_of] if len(key) else np.zeros(0, int)
    contexts = np.bincount(key_of[first])[key_of] if len(key) else np.zeros(0, int)
    several = contexts > 1
    if common is not None and len(key):
        several |= np.bincount(key_of, common[order])[key_of] > 0
    return order, first, members, several, contexts


def anchor_rows(key, context, ids, place, buckets: int, text_buckets: int, both: bool) -> list[tuple[int, bytes]]:
    """A slice's anchors for their keys' buckets. Equal contexts go once; the others of them are covered already (with
    ``both``, the first is too). Of a key with many contexts a few go, marked as common, and all are open."""
    order, first, members, _, contexts = settle(key, context, ids, place)
    key, context, ids, place = key[order], context[order], ids[order], place[order]
    covered = (members > 1) if both else ~first
    # the running number of each context in its key
    new_key = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
    nth = np.cumsum(first)
    nth = nth - np.repeat(nth[new_key], np.diff(np.r_[np.flatnonzero(new_key), len(key)])) if len(key) else nth
    common = contexts > COMMON
    sent = first & (~common | (nth < COMMON))
    opened = first & common
    out = by_bucket((key[sent] % np.uint64(buckets)).astype(np.int64), key[sent], context[sent], ids[sent].astype(np.int64), place[sent].astype(np.int32), (common[sent] + 2 * (members[sent] > 1)).astype(np.uint8))
    for which, kind in ((covered, COVERED), (opened, OPEN)):
        if which.any():
            out += packed_for_text(ids[which], text_buckets, place[which].astype(np.int32), np.full(int(which.sum()), kind, np.uint8))
    return out


def meet(payloads, text_buckets: int, both: bool) -> list[tuple[int, bytes]]:
    """A bucket's anchors, from all slices: which are covered, which are open."""
    key, context, ids, place, flags = gather(payloads, 5)
    order, first, members, several, _ = settle(key, context, ids, place, flags & 1)
    ids, place, flags = ids[order], place[order], flags[order]
    covered = (members > 1) if both else ~first
    opened = first & several
    which = np.flatnonzero(np.r_[covered, opened])
    kind = np.repeat(np.array([COVERED, OPEN], np.uint8), len(ids))[which]
    at = which % max(1, len(ids))
    return packed_for_text(ids[at], text_buckets, place[at].astype(np.int32), kind)


def grouped(rows: DataFrame, work) -> DataFrame:
    """Apply ``work(payloads, bucket)`` to every bucket of keys; rows for documents' buckets pass on as they are."""

    def go(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        if bucket < 0:
            return table.select(["bucket", "payload"])
        return pa.Table.from_batches([table_of(work(table["payload"], bucket))])

    return rows.groupBy("bucket").applyInArrow(go, PACKED)


def with_texts(docs: DataFrame, rows: DataFrame, text_buckets: int, work, schema: str) -> DataFrame:
    """Bring packed rows and the texts of the same documents together, a bucket of documents at a time:
    ``work(ids, doc_ids, texts, payloads)`` gives a table."""

    def go(texts: pa.Table, packed: pa.Table) -> pa.Table:
        ids = texts["id"].to_numpy() if len(texts) else np.zeros(0, np.int64)
        return work(ids, texts["doc_id"], texts["text"], packed["payload"])

    @F.pandas_udf("int")
    def bucket(ids):
        import pandas as pd

        return pd.Series(-1 - text_bucket(ids.to_numpy(), text_buckets), dtype="int32")

    left = docs.select(bucket("id").alias("bucket"), "id", "doc_id", "text")
    return left.groupBy("bucket").cogroup(rows.groupBy("bucket")).applyInArrow(go, schema)


def rows_at(ids: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The row of each wanted id."""
    order = np.argsort(ids)
    return order[np.searchsorted(ids[order], wanted)]


def mask(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in a span."""
    steps = np.bincount(starts, minlength=n + 1) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(steps)[:n] > 0


def runs(covered: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end (within the row) of each stretch of covered places; rows begin at ``at``."""
    if not len(covered):
        none = np.zeros(0, np.int64)
        return none, none, none
    cut = np.zeros(len(covered) + 1, bool)
    cut[at] = True
    starts = np.flatnonzero(covered & (np.r_[True, ~covered[:-1]] | cut[:-1]))
    ends = np.flatnonzero(covered & (np.r_[~covered[1:], True] | cut[1:])) + 1
    row = np.searchsorted(at, starts, "right") - 1
    return row, starts - at[row], ends - at[row]
