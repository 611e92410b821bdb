"""Substring dedup over bytes: maximal repeats from an enhanced suffix array.

The suffix array is sparse. Of the 129 places where a 72-byte span can lie in a 200-byte window, the span with the least
hash is the window's anchor, so equal windows have their anchors at the same place and about one byte in 65 starts a
suffix. Suffixes with the same first 72 bytes are sorted next to each other and share a bucket. Those that are equal in
all windows around them are one leaf; such a leaf with several occurrences is a repeat by itself. What is left are suffixes
at the ends of repeats, whose surroundings differ. They are sorted by what follows, the common prefixes of neighbours are
scanned with a stack, and each interval of the scan is tested for left-extension diversity: within it, all occurrences are
ordered by what precedes them, so each learns how far it extends to both sides together with any other, not only with its
neighbour in the array.

Anchors that share what follows or what precedes with very many others don't meet in one task: all windows around them are
hashed instead, and equal windows meet after each task has added up its own.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.llm import anchors as an
from lossledger.llm.columns import flat, slices
from lossledger.llm.hashing import Spans, mix

WINDOW = 200
ANCHOR = 72
PLACES = WINDOW - ANCHOR + 1
LEFT = PLACES - 1
CONTEXT = an.Context(WINDOW, LEFT)
#: Two occurrences of a window agree on so many bytes after their anchor's begin, or on so many before it.
AFTER, BEFORE = (WINDOW + ANCHOR) // 2, (WINDOW - ANCHOR) // 2
#: Surroundings of one suffix class that a bucket of documents sends on for sorting; beyond it, windows are hashed.
SORTED = 32

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,end:int>>, kept binary"


def _sliding(x: np.ndarray, width: int, best, fill) -> np.ndarray:
    """``best`` (minimum or maximum) of x[i : i + width] at each i; beyond the end counts as ``fill``."""
    n = len(x)
    padded = np.full(-(-(n + width) // width) * width, fill, x.dtype)
    padded[:n] = x
    blocks = padded.reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).ravel()
    back = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[:n], ahead[width - 1 : width - 1 + n])


def anchors_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, Spans]:
    """Anchors of all windows of all rows, their rows, and the span hashes of the bytes."""
    spans = Spans(data)
    n = len(data)
    lengths = np.diff(offsets)
    row = np.repeat(np.arange(len(lengths)), lengths)
    if n < WINDOW:
        return np.zeros(0, np.int64), row, spans
    places = np.arange(n - ANCHOR + 1)
    left = offsets[row[: len(places)] + 1] - places  # bytes of the row from here on
    top = np.iinfo(np.uint64).max
    order = np.where(left >= ANCHOR, spans.hash(places, places + ANCHOR), top)
    least = np.where(left >= WINDOW, _sliding(order, PLACES, np.minimum, top), np.uint64(0))
    # an anchor is the least of some window that begins up to LEFT bytes before it
    reached = _sliding(least[::-1], PLACES, np.maximum, np.uint64(0))[::-1]
    return np.flatnonzero((order == reached) & (left >= ANCHOR)), row, spans


def _anchors(docs: DataFrame, buckets: int, text_buckets: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, at = flat(batch.column(1))
            ids = batch.column(0).to_numpy()
            own, row, spans = anchors_of(data, at)
            row = row[own]
            yield an.table_of(an.anchor_rows(spans.hash(own, own + ANCHOR), CONTEXT.of(spans, at, row, own), ids[row], own - at[row], buckets, text_buckets, both=True))

    return docs.select("id", "text").mapInArrow(work, an.PACKED)


def _window_rows(one, two, ids, place, buckets: int, text_buckets: int) -> list[tuple[int, bytes]]:
    """Windows for their hash's bucket, each once, with a mark if it stands at several places here; those are repeats."""
    order = np.lexsort((place, ids, two, one))
    one, two, ids, place = one[order], two[order], ids[order], place[order]
    # a window may come once for each anchor around it
    once = np.r_[True, (one[1:] != one[:-1]) | (ids[1:] != ids[:-1]) | (place[1:] != place[:-1])] if len(one) else np.zeros(0, bool)
    one, two, ids, place = one[once], two[once], ids[once], place[once]
    first = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])] if len(one) else np.zeros(0, bool)
    several = np.bincount(np.cumsum(first) - 1)[np.cumsum(first) - 1] > 1 if len(one) else first
    out = an.by_bucket((buckets + one[first] % np.uint64(buckets)).astype(np.int64), one[first], two[first], ids[first], place[first].astype(np.int32), several[first].astype(np.uint8))
    return out + (an.packed_for_text(ids[several], text_buckets, place[several].astype(np.int32), (place[several] + WINDOW).astype(np.int32)) if several.any() else [])


def _surroundings(buckets: int, text_buckets: int):
    """Buckets 0.. are suffix classes to sort, ``buckets``.. are windows."""

    def work(ids, _, texts, payloads) -> pa.Table:
        anchor_ids, place, kind = an.gather(payloads, 3)
        if not len(anchor_ids):
            return pa.Table.from_batches([an.table_of([])])
        data, at = flat(texts)
        row = an.rows_at(ids, anchor_ids)
        here = at[row] + place
        known = kind == an.COVERED
        low, high = np.maximum(at[row], here - LEFT), np.minimum(at[row + 1], here + WINDOW)
        r, a, b = an.runs(an.mask(len(data), low[known], high[known]), at)
        out = an.packed_for_text(ids[r], text_buckets, a.astype(np.int32), b.astype(np.int32))
        row, here, low, high = (x[~known] for x in (row, here, low, high))
        here, first = np.unique(here, return_index=True)  # an anchor may be open for two reasons
        row, low, high = row[first], low[first], high[first]
        spans = Spans(data)
        after, before = high - here >= AFTER, here - low >= BEFORE
        key = np.r_[mix(spans.hash(here[after], here[after] + AFTER) ^ np.uint64(1)), spans.hash(here[before] - BEFORE, here[before] + ANCHOR)]
        which = np.r_[np.flatnonzero(after), np.flatnonzero(before)]
        order = np.argsort(key, kind="stable")
        key, which = key[order], which[order]
        new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        sizes = np.diff(np.r_[np.flatnonzero(new), len(key)])
        nth, size = np.arange(len(key)) - np.repeat(np.flatnonzero(new), sizes), np.repeat(sizes, sizes)
        sent = nth < SORTED
        common = (size > SORTED).astype(np.uint8)
        some = which[sent]
        context = _contexts(data, here[some], low[some], high[some])
        out += an.by_bucket((key[sent] % np.uint64(buckets)).astype(np.int64), key[sent], ids[row[some]].astype(np.int64), (here[some] - at[row[some]]).astype(np.int32), common[sent], context)
        crowded = np.unique(which[common > 0])
        if len(crowded):
            starts = np.flatnonzero(an.mask(len(data) + 1, low[crowded], high[crowded] - WINDOW + 1))
            start_row = np.searchsorted(at, starts, "right") - 1
            out += _window_rows(spans.hash(starts, starts + WINDOW), Spans(data, 1).hash(starts, starts + WINDOW), ids[start_row].astype(np.int64), starts - at[start_row], buckets, text_buckets)
        return pa.Table.from_batches([an.table_of(out)])

    return work


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix of two rows of bytes; 0 bytes lie beyond the text."""
    differ = (a != b) | (a == 0)
    at = int(differ.argmax())
    return at if differ[at] else len(a)


class Extents:
    """How far each suffix of one class extends, to the left and right, together with any other one."""

    def __init__(self, before: np.ndarray):
        self.before = before  # of each suffix, in reading order away from the anchor
        order = sorted(range(len(before)), key=lambda i: before[i].tobytes())
        self.rank = [0] * len(before)
        for k, i in enumerate(order):
            self.rank[i] = k
        self.suffix = order
        self.left = [0] * len(before)
        self.right = [0] * len(before)

    def join(self, a: list[int], b: list[int], depth: int) -> list[int]:
        """Two child intervals meet in one whose suffixes share ``depth`` bytes. Their suffixes are ordered by what
        precedes them; where neighbours of different children differ on the left, a repeat is maximal to both sides."""
        large, small = (a, b) if len(a) >= len(b) else (b, a)
        for rank in small:
            k = bisect_left(large, rank)
            for other in large[max(0, k - 1) : k + 1]:
                i, j = self.suffix[rank], self.suffix[other]
                left = _common(self.before[i], self.before[j])
                if left + depth >= WINDOW:
                    for x in (i, j):
                        self.left[x], self.right[x] = max(self.left[x], left), max(self.right[x], depth)
        for rank in small:
            insort(large, rank)
        return large

    def scan(self, common: list[int]) -> None:
        """Stack scan over the common prefixes of neighbours in suffix order; ``common[i]`` is that of i - 1 and i."""
        stack = [(0, [self.rank[0]])]
        for i in range(1, len(common) + 1):
            depth = common[i] if i < len(common) else -1
            while len(stack) > 1 and stack[-1][0] >= depth:
                d, top = stack.pop()
                below, rest = stack[-1]
                stack[-1] = (below, self.join(rest, top, d))
            if i < len(common):
                stack.append((depth, [self.rank[i]]))


def _contexts(data: np.ndarray, here: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The bytes around each anchor, aligned at it and raised by one: 0 is beyond the text, which has no byte 255."""
    out = np.zeros((len(here), LEFT + WINDOW), np.uint8)
    for k, (p, a, b) in enumerate(zip(here.tolist(), low.tolist(), high.tolist())):
        out[k, LEFT - (p - a) : LEFT + (b - p)] = data[a:b] + np.uint8(1)
    return out


def extents(key: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For suffixes with their surroundings: an order, and in it how far each extends to the left and right with another
    one of its key (0 and 0 if with none)."""
    before, after = np.ascontiguousarray(context[:, LEFT - 1 :: -1]), np.ascontiguousarray(context[:, LEFT:])
    order = np.lexsort((after.view(f"S{WINDOW}").ravel(), key))
    key, before, after = key[order], before[order], after[order]
    n = len(key)
    left, right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if n < 2:
        return order, left, right
    differ = (after[1:] != after[:-1]) | (after[1:] == 0)
    prefix = np.where(differ.any(1), differ.argmax(1), WINDOW)
    cuts = np.flatnonzero(key[1:] != key[:-1]) + 1
    for a, b in zip(np.r_[0, cuts].tolist(), np.r_[cuts, n].tolist()):
        if b - a == 2:  # one interval
            shared = _common(before[a], before[a + 1])
            if shared + prefix[a] >= WINDOW:
                left[a:b], right[a:b] = shared, prefix[a]
        elif b - a > 2:
            group = Extents(before[a:b])
            group.scan([0, *prefix[a : b - 1].tolist()])
            left[a:b], right[a:b] = group.left, group.right
    return order, left, right


def _sorted_suffixes(buckets: int, text_buckets: int):
    def work(payloads) -> list[tuple[int, bytes]]:
        key, ids, place, common, context = an.gather(payloads, 5)
        context = context.reshape(-1, LEFT + WINDOW)
        _, group, n = np.unique(key, return_inverse=True, return_counts=True)
        crowded = np.bincount(group, common)[group] > 0
        out = []
        if (own := np.flatnonzero(~crowded & (n[group] > 1))).size:
            order, left, right = extents(key[own], context[own])
            own = own[order][left + right > 0]
            left, right = left[left + right > 0], right[left + right > 0]
            out += an.packed_for_text(ids[own], text_buckets, (place[own] - left).astype(np.int32), (place[own] + right).astype(np.int32))
        if crowded.any():
            rows = context[crowded]
            data, starts = rows.ravel(), np.arange(len(rows))[:, None] * (LEFT + WINDOW) + np.arange(LEFT + 1)
            # the hash is that of the text's own bytes, which are one less
            whole = np.cumsum(np.r_[0, data == 0])
            starts = starts.ravel()
            starts = starts[whole[starts + WINDOW] == whole[starts]]
            row, at = np.divmod(starts, LEFT + WINDOW)
            text = data - np.uint8(1)
            out += _window_rows(Spans(text).hash(starts, starts + WINDOW), Spans(text, 1).hash(starts, starts + WINDOW), ids[crowded][row], place[crowded][row] - LEFT + at, buckets, text_buckets)
        return out

    def pass_windows(payloads, bucket: int) -> list[tuple[int, bytes]]:
        return [(bucket, p.as_py()) for p in payloads] if bucket >= buckets else work(payloads)

    return pass_windows


def _equal_windows(text_buckets: int):
    def work(payloads) -> list[tuple[int, bytes]]:
        one, two, ids, place, several = an.gather(payloads, 5)
        # the same place may come from a text and from a sorted class
        order = np.lexsort((place, ids, two, one))
        one, two, ids, place, several = one[order], two[order], ids[order], place[order], several[order]
        new = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])]
        other = new | np.r_[True, (ids[1:] != ids[:-1]) | (place[1:] != place[:-1])]
        group = np.cumsum(new) - 1
        again = (np.bincount(group, other) > 1) | (np.bincount(group, several) > 0)
        found = again[group]
        return an.packed_for_text(ids[found], text_buckets, place[found], (place[found] + WINDOW).astype(np.int32)) if found.any() else []

    return work


def _remove(ids, doc_ids, texts, payloads) -> pa.Table:
    data, at = flat(texts)
    span_ids, starts, ends = an.gather(payloads, 3)
    row = an.rows_at(ids, span_ids)
    gone = an.mask(len(data), at[row] + starts, np.minimum(at[row] + ends, at[row + 1]))
    r, a, b = an.runs(gone, at)
    first = np.searchsorted(r, np.arange(len(ids) + 1))
    removed = np.r_[0, np.cumsum(gone)]
    kept = [data[s:e][~gone[s:e]].tobytes() for s, e in zip(at[:-1].tolist(), at[1:].tolist())]
    spans = [[{"start": int(x), "end": int(y)} for x, y in zip(a[s:e], b[s:e])] for s, e in zip(first[:-1], first[1:])]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    columns = [doc_ids.combine_chunks() if isinstance(doc_ids, pa.ChunkedArray) else doc_ids, pa.array(np.diff(at)), pa.array(removed[at[1:]] - removed[at[:-1]]), pa.array(np.diff(first)), pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(spans, kind), pa.array(kept, pa.binary())]
    return pa.table(columns, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])


def covered(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """The numbered texts, what of them lies in a string that stands anywhere else too (packed for the texts' buckets),
    and the number of those buckets."""
    texts, size = an.numbered(docs)
    buckets, text_buckets = an.buckets_for(size, an.ANCHOR_BUCKET), an.buckets_for(size, an.TEXT_BUCKET)
    met = an.grouped(_anchors(texts, buckets, text_buckets), lambda p, _: an.meet(p, text_buckets, both=True))
    around = an.with_texts(texts, met, text_buckets, _surroundings(buckets, text_buckets), an.PACKED)
    extended = an.grouped(around, _sorted_suffixes(buckets, text_buckets))
    return texts, an.grouped(extended, lambda p, _, work=_equal_windows(text_buckets): work(p)), text_buckets


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed runs of bytes: start, end) and kept.

    A byte goes if a string of 200 bytes that covers it stands anywhere else too, in another row or elsewhere in the same
    one, overlapping or not; all occurrences go. Strings are judged on the input and never cross texts. Texts are UTF-8
    bytes; null is empty; texts below 200 bytes keep all. Equal rows are occurrences of each other, whatever their
    doc_id, and null doc_ids stay null. Other columns are ignored; an empty table gives an empty one.
    """
    texts, equal, text_buckets = covered(docs)
    return an.with_texts(texts, equal, text_buckets, _remove, RESULT)
