"""Substring dedup over words by difference-cover anchors.

Places 0, 1, 3 and 9 of every 13 words cover all differences modulo 13: whatever two places equal windows begin at, some
shift of less than 13 brings both onto cover places at once. So only windows of eight words at cover places are hashed; two
equal passages of 20 words share such an anchor at the same place in them, and the match extends from there. Anchors whose
whole surroundings are equal settle all windows around them; at the ends of a match the single windows are compared, by
128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lossledger.llm import anchors as an
from lossledger.llm.columns import flat, slices, word_spans
from lossledger.llm.hashing import Spans

WINDOW = 20
#: A perfect difference cover: every difference modulo the period is that of two of these.
PERIOD, COVER = 13, (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1
CONTEXT = an.Context(WINDOW, WINDOW - ANCHOR)

_AT_COVER = np.isin(np.arange(PERIOD), COVER)
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, n_spans long, spans array<struct<start:int,end:int>>, kept_text string"


def _words(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, start and end of each word, its hash, and where each text's words begin."""
    data, offsets = flat(texts)
    starts, ends, row = word_spans(data, offsets)
    return data, starts, ends, Spans(data).hash(starts, ends), np.searchsorted(row, np.arange(len(texts) + 1))


def _anchors(docs: DataFrame, buckets: int, text_buckets: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, _, _, words, at = _words(batch.column(1))
            ids = batch.column(0).to_numpy()
            row = np.repeat(np.arange(len(ids)), np.diff(at))
            place = np.arange(len(words)) - at[row]
            n = np.diff(at)[row]
            own = np.flatnonzero(_AT_COVER[place % PERIOD] & (place + ANCHOR <= n) & (n >= WINDOW))
            spans = Spans(words)
            key, context = spans.hash(own, own + ANCHOR), CONTEXT.of(spans, at, row[own], own)
            yield an.table_of(an.anchor_rows(key, context, ids[row[own]], place[own], buckets, text_buckets, both=False))

    return docs.select("id", "text").mapInArrow(work, an.PACKED)


def _spans_of(ids, at, payloads) -> np.ndarray:
    """Which words the packed spans (id, start, end) cover."""
    span_ids, starts, ends = an.gather(payloads, 3)
    row = an.rows_at(ids, span_ids)
    return an.mask(int(at[-1]), at[row] + starts, np.minimum(at[row] + ends, at[row + 1]))


def _open_windows(buckets: int, text_buckets: int):
    def work(ids, _, texts, payloads) -> pa.Table:
        anchor_ids, place, kind = an.gather(payloads, 3)
        if not len(anchor_ids):
            return pa.Table.from_batches([an.table_of([])])
        words, at = _words(texts)[3:]
        row = an.rows_at(ids, anchor_ids)
        here = at[row] + place
        low, high = np.maximum(at[row], here - CONTEXT.left), np.minimum(here, at[row + 1] - WINDOW)  # first and last window
        known = kind == an.COVERED
        repeated = an.mask(len(words) + 1, low[known], high[known] + 1)
        starts = np.flatnonzero(an.mask(len(words) + 1, low[~known], high[~known] + 1) & ~repeated)
        start_row = np.searchsorted(at, starts, "right") - 1
        one, two = Spans(words).hash(starts, starts + WINDOW), Spans(words, 1).hash(starts, starts + WINDOW)
        place, of = starts - at[start_row], ids[start_row]
        order = np.lexsort((place, of, two, one))
        again = np.zeros(len(order), bool)
        again[1:] = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        repeated[starts[order[again]]] = True
        sent = order[~again]
        out = an.by_bucket((one[sent] % np.uint64(buckets)).astype(np.int64), one[sent], two[sent], of[sent].astype(np.int64), place[sent].astype(np.int32))
        begin = np.flatnonzero(repeated)
        r, a, b = an.runs(an.mask(len(words), begin, begin + WINDOW), at)
        out += an.packed_for_text(ids[r], text_buckets, a.astype(np.int32), b.astype(np.int32))
        return pa.Table.from_batches([an.table_of(out)])

    return work


def _later_windows(text_buckets: int):
    def work(payloads, _) -> list[tuple[int, bytes]]:
        one, two, ids, place = an.gather(payloads, 4)
        order = np.lexsort((place, ids, two, one))
        one, two = one[order], two[order]
        later = order[np.r_[False, (one[1:] == one[:-1]) & (two[1:] == two[:-1])]] if len(order) else order
        return an.packed_for_text(ids[later], text_buckets, place[later], (place[later] + WINDOW).astype(np.int32))

    return work


def _remove(ids, doc_ids, texts, payloads) -> pa.Table:
    data, starts, ends, _, at = _words(texts)
    gone = _spans_of(ids, at, payloads)
    r, a, b = an.runs(gone, at)
    first = np.searchsorted(r, np.arange(len(ids) + 1))
    raw = data.tobytes()
    n_words = np.diff(at)
    removed = np.r_[0, np.cumsum(gone)]
    kept_text, digest, spans = [], [], []
    for k in range(len(ids)):
        words = [raw[s:e] for s, e, g in zip(starts[at[k] : at[k + 1]].tolist(), ends[at[k] : at[k + 1]].tolist(), gone[at[k] : at[k + 1]].tolist()) if not g]
        kept = b" ".join(words)
        kept_text.append(kept.decode("utf-8", "replace"))
        digest.append(hashlib.sha256(kept).hexdigest())
        spans.append([{"start": int(x), "end": int(y)} for x, y in zip(a[first[k] : first[k + 1]], b[first[k] : first[k + 1]])])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    columns = [doc_ids.combine_chunks() if isinstance(doc_ids, pa.ChunkedArray) else doc_ids, pa.array(n_words), pa.array(removed[at[1:]] - removed[at[:-1]]), pa.array(digest, pa.string()), pa.array(np.diff(first)), pa.array(spans, kind), pa.array(kept_text, pa.string())]
    return pa.table(columns, ["doc_id", "n_words", "n_removed", "kept_sha256", "n_spans", "spans", "kept_text"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, n_spans, spans (removed runs of words: start, end) and kept_text.

    A word goes if a window of 20 words that covers it begins earlier somewhere with the same words: in a document with a
    smaller doc_id, or before it in the same one. Windows are judged on the input. Words are ``[^\\x20\\x09-\\x0D]+``, as
    they stand. Null and empty texts have no words; texts below 20 words keep all. A null doc_id counts as smaller than
    all others; rows that share a doc_id are ordered by a hash of their text and then the text, so of equal rows the
    first keeps its words. Other columns are ignored; an empty table gives an empty one.
    """
    texts, size = an.numbered(docs)
    buckets, text_buckets = an.buckets_for(size, an.ANCHOR_BUCKET), an.buckets_for(size, an.TEXT_BUCKET)
    met = an.grouped(_anchors(texts, buckets, text_buckets), lambda p, _: an.meet(p, text_buckets, both=False))
    windows = an.with_texts(texts, met, text_buckets, _open_windows(buckets, text_buckets), an.PACKED)
    later = an.grouped(windows, _later_windows(text_buckets))
    return an.with_texts(texts, later, text_buckets, _remove, RESULT)
