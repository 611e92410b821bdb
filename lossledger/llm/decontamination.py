"""Benchmark decontamination: n-gram seeds find passages, Smith-Waterman alignment scores them.

Every word n-gram of an item is a seed, so a copy with any ``NGRAM`` words in a row left untouched is found, however
common those words are and whatever else the corpus holds. One pass looks the seeds up, gathers the hits of an item by
their diagonal, and aligns the item's words with the passage around them. Passages that lack too many of the item's words
to reach the wanted score are not aligned. That bound is exact, and it is taken for all items that share a text's seeds at
once (first over the whole text, then over each passage), so a common opening of many items costs little. The pass leaves
rows where they are. The items are shared with all tasks in blocks of bounded size, one block after the other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lossledger.llm.columns import plain_words, slices
from lossledger.llm.hashing import Spans
from lossledger.sources.tables import materialise

NGRAM = 3
MATCH, MISMATCH, GAP = 2, -1, -1
#: An item has leaked if its best alignment has this share of the score of a full copy.
LEAKED = 0.5
#: Characters of items shared with the tasks at once; a larger benchmark goes in several blocks.
BLOCK_CHARS = 16_000_000
#: A passage is aligned in stretches of so many words (or eight items' length), which overlap by more than an alignment can span.
STRETCH = 4096

#: Hits that are worked on at once, and passages.
HITS, PASSAGES = 2_000_000, 20_000

_LEAKS = "leaks array<struct<item_id:long,score:double,start:int,end:int,n_same:int>>"


@dataclass
class Items:
    ids: list[int | None]
    flat: np.ndarray  # the words of all items
    at: np.ndarray  # where each item's words begin
    grams: np.ndarray  # sorted seed hashes, one for each place
    item: np.ndarray
    place: np.ndarray

    @classmethod
    def of(cls, rows: list[tuple[int | None, str | None]]) -> Items:
        hashes, at = plain_words(pa.array([t or "" for _, t in rows], pa.large_string()))
        words = [hashes[a:b] for a, b in zip(at[:-1], at[1:])]
        starts = [np.arange(max(0, len(w) - NGRAM + 1)) for w in words]
        grams = np.concatenate([Spans(w).hash(s, s + NGRAM) for w, s in zip(words, starts)]) if rows else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(rows)), [len(s) for s in starts])
        place = np.concatenate(starts) if rows else np.zeros(0, int)
        order = np.argsort(grams, kind="stable")
        return cls([i for i, _ in rows], hashes, at, grams[order], item[order], place[order])

    def hits(self, grams: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``grams`` and seeds that are equal, of the items from ``first`` up to ``last``. Seeds of one hash
        stand by item, so those items' are a range."""
        lo, hi = np.searchsorted(self.grams, grams, "left"), np.searchsorted(self.grams, grams, "right")
        if first or last < len(self.at) - 1:
            key = np.searchsorted(self.distinct, grams).astype(np.int64) * len(self.at)
            lo = np.maximum(lo, np.searchsorted(self.by_item, key + first))
            hi = np.minimum(hi, np.searchsorted(self.by_item, key + last))
        n = np.maximum(hi - lo, 0)
        at = np.repeat(np.arange(len(grams)), n)
        return at, np.repeat(lo, n) + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)

    @cached_property
    def distinct(self) -> np.ndarray:
        return np.unique(self.grams)

    @cached_property
    def by_item(self) -> np.ndarray:
        """Seeds as (number of the hash, item), in order."""
        return np.searchsorted(self.distinct, self.grams).astype(np.int64) * len(self.at) + self.item


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int, int]:
    """Best local alignment of two word sequences: score, start and end in the passage, and how many words are equal."""
    m, n = len(item), len(passage)
    table = np.zeros((m + 1, n + 1), np.int32)
    slope = -GAP * np.arange(n + 1, dtype=np.int32)
    for i in range(1, m + 1):
        above = table[i - 1]
        row = np.maximum(above + GAP, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(passage == item[i - 1], MATCH, MISMATCH))
        # gaps along the passage: the best of all cells to the left, less their distance
        table[i] = np.maximum.accumulate(row + slope) - slope
    i, j = np.unravel_index(int(table.argmax()), table.shape)
    score, end, same = int(table[i, j]), int(j), 0
    while table[i, j] > 0:
        equal = i and j and item[i - 1] == passage[j - 1]
        if i and j and table[i, j] == table[i - 1, j - 1] + (MATCH if equal else MISMATCH):
            i, j, same = i - 1, j - 1, same + bool(equal)
        elif i and table[i, j] == table[i - 1, j] + GAP:
            i -= 1
        else:
            j -= 1
    return score, int(j), end, same


def _best(item: np.ndarray, words: np.ndarray, lo: int, hi: int) -> tuple[float, int, int, int]:
    """The best alignment within words lo to hi: share of the full score, start, end, equal words."""
    m, best = len(item), (0.0, 0, 0, 0)
    span = m * (1 - MATCH // GAP)  # no alignment of a positive score reaches further
    stretch = max(STRETCH, 8 * m)
    while True:
        score, a, b, same = align(item, words[lo : min(hi, lo + stretch)])
        best = max(best, (score / (MATCH * m), lo + a, lo + b, same), key=lambda x: (x[0], -x[1]))
        if lo + stretch >= hi:
            return best
        lo += stretch - span


def _spread(at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all words of some items, one item after the other, and where each item's begin."""
    sizes = at[which + 1] - at[which]
    begin = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) - np.repeat(begin - at[which], sizes), begin


def _passages(items: Items, words: np.ndarray, item: np.ndarray, diagonal: np.ndarray, leaked: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, first word and end of the passages of a text that may reach ``leaked``, from the hits (by item, then
    diagonal): neighbouring diagonals make a passage, and each word of the item that it lacks takes away its match."""
    n = len(words)
    distinct, number = np.unique(words, return_inverse=True)
    candidates = np.unique(item)
    place, begin = _spread(items.at, candidates)
    rank = np.minimum(np.searchsorted(distinct, items.flat[place]), len(distinct) - 1)
    there = distinct[rank] == items.flat[place]
    sizes = items.at[candidates + 1] - items.at[candidates]
    likely = np.zeros(len(items.at) - 1, bool)
    likely[candidates] = np.add.reduceat(there.astype(np.int64), begin) / sizes >= leaked
    good = likely[item]
    item, diagonal = item[good], diagonal[good]
    if not len(item):
        return item, item, item
    size = items.at[item + 1] - items.at[item]
    pad = size // 2 + 8
    new = np.r_[True, (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > pad[1:])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(item)] - 1
    of, lo = item[first], np.maximum(0, diagonal[first] - pad[first])
    hi = np.minimum(n, diagonal[last] + size[last] + pad[last])
    order = np.argsort(number, kind="stable")
    where = number.ravel()[order] * (n + 1) + order  # places of each word, word after word
    keep = np.zeros(len(of), bool)
    for a in range(0, len(of), PASSAGES):
        part = slice(a, a + PASSAGES)
        place, begin = _spread(items.at, of[part])
        sizes = items.at[of[part] + 1] - items.at[of[part]]
        rank = np.minimum(np.searchsorted(distinct, items.flat[place]), len(distinct) - 1)
        known = distinct[rank] == items.flat[place]
        next_one = np.searchsorted(where, rank * (n + 1) + np.repeat(lo[part], sizes))
        inside = known & (next_one < len(where))
        inside &= where[np.minimum(next_one, len(where) - 1)] < rank * (n + 1) + np.repeat(hi[part], sizes)
        keep[part] = np.add.reduceat(inside.astype(np.int64), begin) / sizes >= leaked
    return of[keep], lo[keep], hi[keep]


def _grams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, begin of each row's words, and the n-grams with the position where each begins."""
    words, at = plain_words(batch.column(batch.schema.get_field_index("text")).fill_null(""))
    starts = np.arange(max(0, len(words) - NGRAM + 1))
    row = np.searchsorted(at, starts, "right") - 1
    starts = starts[starts + NGRAM <= at[row + 1]] if len(starts) else starts
    return words, at, Spans(words).hash(starts, starts + NGRAM), starts


def _leaks(items: Items, leaked: float, key: str | None):
    """Rows with their leaks; with a ``key`` only that column, and only rows that have some."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, at, grams, starts = _grams(batch)
            leaks: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            some = np.flatnonzero(np.isin(grams, items.grams))
            rows = np.searchsorted(at, starts[some], "right") - 1
            for near in np.split(some, np.flatnonzero(np.diff(rows)) + 1) if len(some) else ():  # the hits of one text at a time
                r = int(np.searchsorted(at, starts[near[0]], "right")) - 1
                own = words[at[r] : at[r + 1]]
                best: dict[int, tuple[float, int, int, int]] = {}
                for k, lo, hi in _found(items, own, grams[near], starts[near] - at[r], leaked):
                    best[k] = max(best.get(k, (0.0, 0, 0, 0)), _best(items.flat[items.at[k] : items.at[k + 1]], own, lo, hi), key=lambda x: (x[0], -x[1]))
                for k, (score, a, b, same) in sorted(best.items()):
                    if score >= leaked:
                        leaks[r].append({"item_id": items.ids[k], "score": score, "start": a, "end": b, "n_same": same})
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("start", pa.int32()), ("end", pa.int32()), ("n_same", pa.int32())]))
            if key is None:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaks, kind)], [*batch.schema.names, "leaks"])
            else:
                full = [i for i, x in enumerate(leaks) if x]
                yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(key)).take(pa.array(full, pa.int64())), pa.array([leaks[i] for i in full], kind)], [key, "leaks"])

    return work


def _found(items: Items, own: np.ndarray, grams: np.ndarray, starts: np.ndarray, leaked: float) -> Iterator[tuple[int, int, int]]:
    """Passages of a text that may hold a copy, from its seeds: (item, first word, end). Very many hits are taken in parts
    of whole items."""
    lo, hi = np.searchsorted(items.grams, grams, "left"), np.searchsorted(items.grams, grams, "right")
    cuts = [0, len(items.at) - 1]
    if (hi - lo).sum() > HITS:  # items' numbers at which about equally many hits part
        distinct = np.unique(grams)
        sizes = np.bincount(items.item[np.concatenate([np.arange(a, b) for a, b in zip(np.searchsorted(items.grams, distinct), np.searchsorted(items.grams, distinct, "right"))])], minlength=len(items.at) - 1)
        parts = int((hi - lo).sum()) // HITS + 1
        cuts = np.unique(np.r_[0, np.searchsorted(np.cumsum(sizes), np.arange(1, parts) * (sizes.sum() / parts)), len(items.at) - 1]).tolist()
    for first, last in zip(cuts, cuts[1:]):
        where, seed = items.hits(grams, first, last)
        item, diagonal = items.item[seed], starts[where] - items.place[seed]
        order = np.lexsort((diagonal, item))
        if len(order):
            yield from zip(*(x.tolist() for x in _passages(items, own, item[order], diagonal[order], leaked)))


def with_leaks(docs: DataFrame, benchmark: DataFrame, leaked: float = LEAKED, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``docs`` with ``leaks``: item_id, score (0 to 1), start, end (in words) and n_same of each item that a document
    holds a copy of, by the best alignment of each.

    Words are runs of letters and digits in lower case. Null texts hold nothing; items with fewer words than an n-gram
    have no seeds and match nothing; equal items are found each; a column named ``leaks`` is replaced and all others, as
    well as repeated rows, pass through; an empty benchmark or corpus gives no leaks. A benchmark beyond ``block_chars``
    goes block by block: each block's leaks are written (rows without any are not), then joined to the documents.
    """
    docs = docs.drop("leaks").withColumn("text", F.col("text").cast("string"))
    benchmark = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    chars = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-chars // block_chars))

    def block_of(number: int) -> Items:
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        return Items.of([(r["item_id"], r["text"]) for r in part.sort("item_id", "text").collect()])

    if blocks == 1:
        schema = StructType([*docs.schema.fields, *StructType.fromDDL(_LEAKS).fields])
        return docs.mapInArrow(_leaks(block_of(0), leaked, None), schema)
    rows = materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    found = [materialise(rows.select("_row", "text").mapInArrow(_leaks(block_of(k), leaked, "_row"), f"_row long, {_LEAKS}"), "leaks") for k in range(blocks)]
    every = reduce(DataFrame.unionByName, found).groupBy("_row").agg(F.flatten(F.collect_list("leaks")).alias("leaks"))
    none = F.array().cast(StructType.fromDDL(_LEAKS)["leaks"].dataType)
    return rows.join(every, "_row", "left").withColumn("leaks", F.coalesce("leaks", none)).drop("_row")


def leak_rows(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item it holds: doc_id, item_id, score, start, end, n_same."""
    return with_leaks(docs.select("doc_id", "text"), benchmark).select("doc_id", F.inline("leaks"))
