"""Ranked lexical search by trees of documents.

Of a document only the terms that some item asks for matter, with their counts and the document's length. These restricted
vectors, terms in order of falling document frequency, are laid into a trie, so documents that share their common terms
share a path. Every node knows, for its whole subtree, the largest count of each term and the smallest length factor m; put
together in the score they bound what any document below can reach. For an item the tree is searched depth first, the
child with the highest bound first, and a subtree whose bound is below the item's 20th best score so far is left out.

Each task builds trees of bounded size over its part of the vectors and goes from one to the next with the scores it has.
Its best rows meet those of other tasks in two steps. Items are taken in blocks of bounded text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lossledger.llm.columns import flat, slices, text_of, word_spans
from lossledger.llm.hashing import Spans
from lossledger.sources.tables import materialise

TOP = 20
#: Text of the items that are searched for together, in bytes.
ITEM_BYTES = 4_000_000
#: A tree holds about so many (document, term) entries, and a subtree of up to so many documents isn't divided further.
TREE_ENTRIES, LEAF = 4_000_000, 64
#: Parts in which the tasks' best rows meet first.
PARTS = 32
#: Whatever is no letter, digit or character beyond ASCII parts terms.
_PARTS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def _terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes with A-Z lowered, and start, end and row of every term."""
    data = _LOWER[data]
    return (data, *word_spans(data, offsets, _PARTS))


@dataclass(frozen=True)
class Items:
    """A block of items: the distinct terms as pairs of hashes (sorted by the first), and each item's terms and repeats."""

    numbers: list[int]
    one: np.ndarray
    two: np.ndarray
    terms: list[np.ndarray]
    repeats: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple[int, bytes]]) -> Items:
        data, offsets = flat(pa.array([t for _, t in rows], pa.binary()))
        data, starts, ends, row = _terms(data, offsets)
        one, two = Spans(data).hash(starts, ends), Spans(data, 1).hash(starts, ends)
        pairs, where = np.unique(np.c_[one, two], axis=0, return_inverse=True)
        found = [np.unique(where.ravel()[row == i], return_counts=True) for i in range(len(rows))]
        return cls([n for n, _ in rows], pairs[:, 0], pairs[:, 1], [f[0] for f in found], [f[1].astype(np.int64) for f in found])

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which spans are terms of the items, and which term each of these is."""
        one = Spans(data).hash(starts, ends)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        hit = np.flatnonzero(self.one[at] == one)
        at = at[hit]
        two = Spans(data, 1).hash(starts[hit], ends[hit])
        while (wrong := (self.two[at] != two) & (np.r_[self.one, 0][at + 1] == self.one[at])).any():  # equal first hashes
            at = at + wrong
        right = self.two[at] == two
        return hit[right], at[right]


def _blocks(items: DataFrame, most: int) -> Iterator[tuple[Items, DataFrame]]:
    """Items in blocks of ``most`` bytes of text, with a table of their numbers and ids; read block by block."""
    numbered = materialise(items.select(F.monotonically_increasing_id().alias("item"), items["item_id"], text_of(items).alias("text")), "items")
    held, size = [], 0
    for row in numbered.select("item", "text").toLocalIterator():
        held.append((row["item"], bytes(row["text"])))
        size += len(row["text"])
        if size >= most:
            yield Items.of(held), numbered.select("item", "item_id")
            held, size = [], 0
    if held:
        yield Items.of(held), numbered.select("item", "item_id")


def _vectors(items: Items):
    """doc_id, n (terms with repeats), and which of the items' terms a document holds, how often each."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, offsets = flat(batch.column(1))
            data, starts, ends, row = _terms(data, offsets)
            hit, term = items.find(data, starts, ends)
            keys, tf = np.unique(row[hit] * len(items.one) + term, return_counts=True)
            at = pa.array(np.searchsorted(keys, np.arange(batch.num_rows + 1) * len(items.one)).astype(np.int32))
            terms = pa.ListArray.from_arrays(at, pa.array((keys % len(items.one)).astype(np.int32)))
            counts = pa.ListArray.from_arrays(at, pa.array(tf.astype(np.int32)))
            n = pa.array(np.bincount(row, minlength=batch.num_rows).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), n, terms, counts], ["doc_id", "n", "terms", "counts"])

    return work


def _frequencies(vectors: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], ["term", "df"])

    counted = vectors.select("terms").mapInArrow(count, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out = np.zeros(size, np.int64)
    for row in counted.toLocalIterator():  # at most as many rows as the block's items have terms
        out[row["term"]] = row["df"]
    return out


class Tree:
    """Documents as a trie over their terms' ranks, in arrays: documents stand in the order of their paths, so a subtree is
    a range of them. Chains without branches are one edge; small neighbouring subtrees are one leaf."""

    def __init__(self, doc: list, m: np.ndarray, at: np.ndarray, rank: np.ndarray, tf: np.ndarray):
        order = np.lexsort((rank, np.repeat(np.arange(len(m)), np.diff(at))))
        raw, counts = rank[order].astype(">u4").tobytes(), tf[order].astype(">u4").tobytes()
        ends = (4 * at).tolist()
        rows = sorted((raw[a:b], counts[a:b], x, d is None, d or 0) for a, b, x, d in zip(ends, ends[1:], m.tolist(), doc))
        # documents alike in path, counts and m score alike for every item: the first TOP of them are all that can count
        kept, alike, before = [], 0, None
        for row in rows:
            alike = alike + 1 if row[:3] == before else 0
            before = row[:3]
            if alike < TOP:
                kept.append(row)
        self.paths = [r[0] for r in kept]
        self.docs = [(r[3], r[4]) for r in kept]
        self.m = np.array([r[2] for r in kept], np.int64)
        self.rank = np.frombuffer(b"".join(self.paths), ">u4").astype(np.int64)
        tf = np.frombuffer(b"".join(r[1] for r in kept), ">u4").astype(np.int64)
        self.at = np.r_[0, np.cumsum([len(p) // 4 for p in self.paths])]
        self.part = _part(tf, np.repeat(self.m, np.diff(self.at)))
        self._grow()
        self._bound(tf)

    def _grow(self) -> None:
        """Nodes as ranges of documents, parents before children; children[i] is empty for a leaf."""
        self.ranges, self.children = [(0, len(self.paths))], [[]]
        todo = [0]
        while todo:
            node = todo.pop()
            lo, hi = self.ranges[node]
            if hi - lo <= LEAF:
                continue
            depth = _shared(self.paths[lo], self.paths[hi - 1])  # sorted: what first and last share, all share
            inside = np.diff(self.at[lo : hi + 1]) > depth
            branch = np.where(inside, self.rank[np.minimum(self.at[lo:hi] + depth, len(self.rank) - 1)], -1)
            cuts = (np.flatnonzero(np.diff(branch)) + 1 + lo).tolist()
            runs = [(a, b) for a, b in zip([lo, *cuts], [*cuts, hi])]
            parts: list[tuple[int, int, bool]] = []
            for a, b in runs:
                if b - a > LEAF and branch[a - lo] >= 0:
                    parts.append((a, b, True))
                    continue
                for c in range(a, b, LEAF):  # a path that ends here, shared by many documents, is cut
                    d = min(c + LEAF, b)
                    if parts and not parts[-1][2] and d - parts[-1][0] <= LEAF:
                        parts[-1] = (parts[-1][0], d, False)
                    else:
                        parts.append((c, d, False))
            for a, b, deeper in parts:
                self.children[node].append(len(self.ranges))
                if deeper:
                    todo.append(len(self.ranges))
                self.ranges.append((a, b))
                self.children.append([])

    def _bound(self, tf: np.ndarray) -> None:
        """For every node the largest count of each term below, and with the least m there the most a term can give."""
        most: list = [None] * len(self.ranges)
        least = np.zeros(len(self.ranges), np.int64)
        for node in range(len(self.ranges) - 1, -1, -1):
            lo, hi = self.ranges[node]
            least[node] = self.m[lo:hi].min()
            below = self.children[node]
            if below:
                ranks, counts = np.concatenate([most[c][0] for c in below]), np.concatenate([most[c][1] for c in below])
            else:
                ranks, counts = self.rank[self.at[lo] : self.at[hi]], tf[self.at[lo] : self.at[hi]]
            order = np.argsort(ranks, kind="stable")
            ranks, counts = ranks[order], counts[order]
            first = np.flatnonzero(np.r_[True, ranks[1:] != ranks[:-1]])
            most[node] = ranks[first], np.maximum.reduceat(counts, first)
        rank = np.concatenate([r for r, _ in most])
        node = np.repeat(np.arange(len(most)), [len(r) for r, _ in most])
        part = _part(np.concatenate([c for _, c in most]), least[node])
        order = np.argsort(rank, kind="stable")
        self._b_rank, self._b_node, self._b_part = rank[order], node[order], part[order]

    def search(self, ranks: np.ndarray, weights: np.ndarray, dense: np.ndarray, best: list[tuple[int, bool, int]]) -> None:
        """Bring the documents of this tree into ``best``, an item's rows (-score, no doc_id, doc_id) in order. ``dense``
        is the item's weight for every rank."""
        lows, highs = np.searchsorted(self._b_rank, ranks), np.searchsorted(self._b_rank, ranks, "right")
        bounds = np.zeros(len(self.ranges), np.int64)
        for lo, hi, weight in zip(lows.tolist(), highs.tolist(), weights.tolist()):
            bounds[self._b_node[lo:hi]] += weight * self._b_part[lo:hi]
        least = -best[-1][0] if len(best) == TOP else 1
        todo = [0]
        while todo:
            node = todo.pop()
            if bounds[node] < least:
                continue
            if self.children[node]:
                todo += sorted((c for c in self.children[node] if bounds[c] >= least), key=bounds.__getitem__)
                continue
            lo, hi = self.ranges[node]
            a, b = self.at[lo], self.at[hi]
            scores = np.add.reduceat(dense[self.rank[a:b]] * self.part[a:b], self.at[lo:hi] - a)
            enough = np.flatnonzero(scores >= least)
            if len(enough):
                best += [(-score, *self.docs[lo + i]) for i, score in zip(enough.tolist(), scores[enough].tolist())]
                best.sort()
                del best[TOP:]
                least = -best[-1][0] if len(best) == TOP else 1


def _part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term gives for each unit of its weight; it grows with tf and falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _shared(a: bytes, b: bytes) -> int:
    """Terms that two paths begin with alike."""
    n = min(len(a), len(b)) // 4
    x, y = np.frombuffer(a, ">u4", n), np.frombuffer(b, ">u4", n)
    differ = x != y
    return int(differ.argmax()) if differ.any() else n


def _best_rows(items: Items, documents: int, all_terms: int, frequencies: np.ndarray, entries: int):
    by_frequency = np.lexsort((items.one, -frequencies))
    rank_of = np.empty(len(by_frequency), np.int64)
    rank_of[by_frequency] = np.arange(len(by_frequency))
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1))) for df in frequencies.tolist()], np.int64)
    asked = [(rank_of[t], weight[t] * c) for t, c in zip(items.terms, items.repeats)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, bool, int]]] = [[] for _ in asked]
        dense = np.zeros(len(rank_of), np.int64)
        held: list[pa.RecordBatch] = []

        def search() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            terms, counts = table["terms"].combine_chunks(), table["counts"].combine_chunks()
            at = np.r_[0, np.cumsum(terms.value_lengths().to_numpy())]
            m = 75 + (25 * table["n"].to_numpy() * documents) // all_terms
            tree = Tree(table["doc_id"].to_pylist(), m, at, rank_of[terms.flatten().to_numpy()], counts.flatten().to_numpy())
            for rows, (ranks, weights) in zip(best, asked):
                if len(ranks):
                    dense[ranks] = weights
                    tree.search(ranks, weights, dense, rows)
                    dense[ranks] = 0

        n = 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += len(batch.column(2).flatten())
            if n >= entries:
                search()
                n = 0
        if held:
            search()
        flat_rows = [(number, -score, None if absent else doc) for number, rows in zip(items.numbers, best) for score, absent, doc in rows]
        columns = [pa.array([r[i] for r in flat_rows], pa.int64()) for i in range(3)]
        task = pa.array(np.full(len(flat_rows), TaskContext.get().partitionId() % PARTS, np.int32))
        yield pa.RecordBatch.from_arrays([*columns, task], ["item", "score", "doc_id", "part"])

    return work


def search(docs: DataFrame, items: DataFrame, block: int = ITEM_BYTES, entries: int = TREE_ENTRIES) -> DataFrame:
    """The TOP highest-scoring documents of each item: item_id, rank (from 1), doc_id, score. Only scores above 0 count;
    equal scores go by ascending doc_id, a null doc_id last.

    Terms are what is left between ASCII characters that are neither letter nor digit, with A-Z lowered. A null or empty
    text has no term: such a document is in no statistic and no result, such an item has no rows. Rows that repeat a doc_id
    or an item_id are documents or items of their own. Other columns are ignored; an empty table on either side gives an
    empty result. Terms are equal if their 128-bit hashes are.
    """
    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    id_type = items.schema["item_id"].dataType.simpleString()
    found = []
    for wanted, ids in _blocks(items, block):
        if not len(wanted.one):
            continue
        vectors = materialise(plain.mapInArrow(_vectors(wanted), "doc_id long, n long, terms array<int>, counts array<int>"), "term-vectors")
        totals = vectors.where("n > 0").agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("terms")).first()
        if not totals["documents"]:
            continue
        best = _best_rows(wanted, totals["documents"], totals["terms"], _frequencies(vectors, len(wanted.one)), entries)
        rows = vectors.where(F.size("terms") > 0).mapInArrow(best, "item long, score long, doc_id long, part int")
        order = [F.desc("score"), F.col("doc_id").asc_nulls_last()]
        some = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("rank") <= TOP)
        all_parts = some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= TOP)
        found.append(materialise(all_parts.join(ids, "item").select("item_id", "rank", "doc_id", "score"), "best-rows"))
    if not found:
        return docs.sparkSession.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
#: DuckDB SQL for the same rows.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_TERMS} AS ts FROM documents),
i AS (SELECT row_number() OVER () AS iid, item_id, {_TERMS} AS ts FROM benchmark),
s AS (SELECT count(*) AS nd, sum(len(ts))::BIGINT AS l FROM d WHERE len(ts) > 0),
q AS (SELECT iid, t, count(*) AS c FROM (SELECT iid, unnest(ts) AS t FROM i) GROUP BY 1, 2),
f AS (SELECT rid, t, count(*) AS tf FROM (SELECT rid, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY 1, 2),
w AS (SELECT t, floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM f, s GROUP BY 1),
m AS (SELECT rid, doc_id, 75 + (25 * len(ts) * nd) // l AS m FROM d, s WHERE len(ts) > 0),
r AS (SELECT iid, rid, any_value(doc_id) AS doc_id, sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
      FROM q JOIN w USING (t) JOIN f USING (t) JOIN m USING (rid) GROUP BY 1, 2),
k AS (SELECT iid, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k JOIN i USING (iid) WHERE rank <= {TOP}"""
