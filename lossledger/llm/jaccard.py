"""Jaccard join of documents' five-word shingle sets by chosen paths.

Documents with equal sets are one class. For the classes each run samples tokens: a set keeps a shared token if the run's
hash of it is small for the set's size, which picks 1 / 0.8 tokens of a set on average and at least one common token of a
similar pair. Sets with a picked token in common share a bucket. A bucket of few sets is compared by brute force; a larger
one is split by tokens picked anew within it, down to a fixed depth. A pair that is as similar as asked for follows the
same path to the bottom of a run with a known probability, and the number of runs follows from the recall asked for.

Of buckets with the same members one is kept. A pair is compared in the first bucket, by size, that both members share, so
each link counts once without listing pairs: a task compares the sets of a bucket (a large one goes in pairs of blocks) and
returns for each set its number of links and the least set it is linked to.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossledger.llm import anchors as an
from lossledger.llm.columns import SHORT_SLICE, flat, slices, word_spans
from lossledger.llm.hashing import Spans, mix
from lossledger.sources.tables import materialise

SHINGLE = 5
#: The least similarity, as a fraction.
SIMILAR = (4, 5)
RECALL = 0.99999
DEPTH = 3
#: Sets that are compared at once; larger buckets are split by further tokens, and at the last depth into blocks.
SMALL = 64
BLOCK = 1024
#: Values that a comparison of sets holds at once.
COLUMNS = 2048
#: Elements of sets that are hashed at once while paths are sampled (few enough to stay in a core's cache), or compared at once.
SAMPLED, AT_ONCE = 1 << 16, 1_000_000
_TOP = 2.0**64


def runs_for(recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the least similarity has met with this probability, even if all its buckets are split
    down to ``depth``: a path survives a level if one of a Poisson number (mean 1) of common tokens does."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def shingle_sets(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, sorted, one after the other, and where each text's begin. A text of one
    to four words has one shingle, of all its words."""
    data, offsets = flat(texts)
    starts, ends, row = word_spans(data, offsets)
    words, at = Spans(data).hash(starts, ends), np.searchsorted(row, np.arange(len(texts) + 1))
    begin = np.arange(len(words))
    end = np.minimum(begin + SHINGLE, at[row + 1]) if len(words) else begin
    good = (end - begin == SHINGLE) | (begin == at[row]) if len(words) else np.zeros(0, bool)
    hashes, row = Spans(words).hash(begin[good], end[good]), row[good]
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    once = np.r_[True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])] if len(row) else np.zeros(0, bool)
    return hashes[once], np.searchsorted(row[once], np.arange(len(texts) + 1))


def _sampled(hashes: np.ndarray, at: np.ndarray, runs: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each level: row, parent (the run, or the number of the row's path one level up) and token of each path."""
    sizes = np.diff(at)
    limit = np.minimum(_TOP * SIMILAR[1] / SIMILAR[0] / np.maximum(sizes, 1), _TOP - 2048).astype(np.uint64)
    row_of = np.repeat(np.arange(len(sizes)), sizes)
    tokens = (hashes >> np.uint64(32)).astype(np.uint32)
    rows, parents, picked = [], [], []
    for run in range(runs):
        hit = np.flatnonzero(mix(hashes + mix(np.array([run + 1], np.uint64))) <= limit[row_of])
        rows.append(row_of[hit])
        parents.append(np.full(len(hit), run))
        picked.append(tokens[hit])
    row, parent, token = np.concatenate(rows), np.concatenate(parents), np.concatenate(picked)
    order = np.argsort(row, kind="stable")
    levels = [(row[order], parent[order], token[order])]
    seed = mix(levels[0][1].astype(np.uint64) << np.uint64(32) | levels[0][2].astype(np.uint64))
    for _ in range(DEPTH - 1):
        row = levels[-1][0]
        nth = np.arange(len(row)) - np.searchsorted(row, row)  # of the path in its row
        done, n = [], np.cumsum(sizes[row])
        cuts = np.unique(np.r_[0, np.searchsorted(n, np.arange(SAMPLED, n[-1] if len(n) else 0, SAMPLED)), len(row)])
        for a, b in zip(cuts[:-1], cuts[1:]):
            size = sizes[row[a:b]]
            path = np.repeat(np.arange(a, b), size)
            element = np.arange(len(path)) - np.repeat(np.cumsum(size) - size, size) + at[row[path]]
            hit = mix(hashes[element] ^ seed[path]) <= limit[row[path]]
            done.append((path[hit], tokens[element[hit]]))
        path = np.concatenate([p for p, _ in done]) if done else np.zeros(0, np.int64)
        token = np.concatenate([t for _, t in done]) if done else np.zeros(0, np.uint32)
        levels.append((row[path], nth[path], token))
        seed = mix(seed[path] ^ token.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return levels


_PATHS = "id long, doc_id long, n int, one long, two long, p1 array<short>, t1 array<int>, p2 array<short>, t2 array<int>, p3 array<short>, t3 array<int>"


def _lists(row: np.ndarray, values: np.ndarray, n: int, kind) -> pa.Array:
    offsets = np.searchsorted(row, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def _paths(texts: DataFrame, runs: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SHORT_SLICE):
            hashes, at = shingle_sets(batch.column(2))
            keys = [Spans(hashes, lane).hash(at[:-1], at[1:]).astype(np.int64) for lane in (0, 1)]
            columns = [batch.column(0), batch.column(1), pa.array(np.diff(at), pa.int32()), *map(pa.array, keys)]
            for row, parent, token in _sampled(hashes, at, runs):
                columns += [_lists(row, parent.astype(np.int16), len(batch), pa.int16()), _lists(row, token.view(np.int32), len(batch), pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _PATHS.split(", ")])

    return texts.select("id", "doc_id", "text").mapInArrow(work, _PATHS)


# --- buckets -------------------------------------------------------------------------------------------------------


def _keys(parents: Column, tokens: Column) -> Column:
    return F.transform(F.arrays_zip(parents.alias("p"), tokens.alias("t")), lambda x: F.xxhash64(x["p"], x["t"]))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it for every element; a plain column would be computed again for each."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _below(parents: Column, tokens: Column, above: Column) -> Column:
    return F.transform(F.arrays_zip(parents.alias("p"), tokens.alias("t")), lambda x: F.xxhash64(F.get(above, x["p"].cast("int")), x["t"]))


def _under(parents: Column, tokens: Column, above: Column) -> Column:
    """(key above, key) of each path."""
    pairs = F.arrays_zip(parents.alias("p"), tokens.alias("t"))
    return _let(above, lambda keys: F.transform(pairs, lambda x: F.struct(F.get(keys, x["p"].cast("int")).alias("above"), F.xxhash64(F.get(keys, x["p"].cast("int")), x["t"]).alias("key"))))


def _buckets(reps: DataFrame) -> DataFrame:
    """(rep, bucket, n) of every bucket with two sets or more, none of which has the members of another."""
    first = _keys(F.col("p1"), F.col("t1"))
    second = _let(first, lambda keys: _below(F.col("p2"), F.col("t2"), keys))
    under = {2: _under(F.col("p2"), F.col("t2"), first), 3: _under(F.col("p3"), F.col("t3"), second)}
    rows = reps.select("rep", F.explode(first).alias("key"))
    done = None
    for level in range(1, DEPTH + 1):
        rows = materialise(rows.distinct(), f"paths-{level}")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("rep")).alias("a"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("b"))
        sizes = materialise(sizes.where("n > 1"), f"sizes-{level}")
        final = F.col("n") > 1 if level == DEPTH else F.col("n") <= SMALL
        kept = sizes.where(final).groupBy("n", "a", "b").agg(F.min("key").alias("key")).select("key", "n", F.lit(True).alias("final"))
        if level < DEPTH:
            kept = kept.unionByName(sizes.where(~final).select("key", "n", F.lit(False).alias("final")))
        shared = materialise(rows.join(kept, "key"), f"shared-{level}")
        here = shared.where("final").select("rep", F.col("key").alias("bucket"), "n")
        done = here if done is None else done.unionByName(here)
        if level < DEPTH:  # a set goes on with the paths below its large buckets
            large = shared.where("NOT final").groupBy("rep").agg(F.collect_set("key").alias("large"))
            below = reps.join(large, "rep").select("rep", "large", F.explode(under[level + 1]).alias("u"))
            rows = below.where(F.array_contains("large", F.col("u.above"))).select("rep", "u.key")
    return materialise(done, "buckets")


def _groups(buckets: DataFrame, tasks: int) -> DataFrame:
    """(task, bucket, i, j, rep, block, earlier): the sets to compare. A bucket of several blocks is a group for each pair
    of blocks; ``earlier`` are the set's buckets that come first for a pair which shares them."""
    order = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("m"), "bucket", "n")))
    listed = buckets.groupBy("rep").agg(order.alias("l")).select("rep", "l", F.posexplode("l").alias("k", "b"))
    blocks = F.ceil(F.col("b.n") / BLOCK).cast("int")
    rows = listed.select("rep", F.slice(F.col("l.bucket"), F.lit(1), F.col("k")).alias("earlier"), F.col("b.bucket").alias("bucket"), blocks.alias("blocks"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep", F.lit(2)), F.col("blocks").cast("long")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("rep", "earlier", "bucket", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return rows.withColumn("task", F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(tasks)).cast("int"))


def _in_common(lists: list[np.ndarray]) -> np.ndarray:
    """How many values each two lists (of distinct values) have in common; counted for a few thousand values at a time."""
    values = np.concatenate(lists) if lists else np.zeros(0)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    _, at, n = np.unique(values, return_inverse=True, return_counts=True)
    column = (np.cumsum(n > 1) - 1)[at]
    shared = n[at] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(lists), len(lists)), np.float32)
    for first in range(0, int((n > 1).sum()), COLUMNS):
        a, b = np.searchsorted(column, [first, first + COLUMNS])
        held = np.zeros((len(lists), COLUMNS), np.float32)
        held[owner[a:b], column[a:b] - first] = 1
        out += held @ held.T
    return out


def _tokens_in_common(sets: list[np.ndarray]) -> np.ndarray:
    """The same for sorted tokens, however many: a range of their values at a time, so that a comparison of long texts
    holds little more than the tokens themselves."""
    parts = sum(map(len, sets)) // AT_ONCE + 1
    if parts == 1:
        return _in_common(sets)
    bounds = [(1 << 32) * k // parts for k in range(parts + 1)]
    cuts = [np.searchsorted(x, bounds) for x in sets]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for k in range(parts):
        out += _in_common([x[c[k] : c[k + 1]] for x, c in zip(sets, cuts)])
    return out


def _candidates(block: np.ndarray | None, earlier: list[np.ndarray]) -> np.ndarray:
    """Pairs of a group that belong to it: of different blocks, if it has two, and without an earlier bucket in common."""
    pairs = _in_common(earlier) < 0.5
    if block is not None:
        pairs &= block[:, None] != block[None, :]
    return np.triu(pairs, 1)


def _group_cuts(table: pa.Table) -> list[np.ndarray]:
    bucket, i, j = (table[c].to_numpy() for c in ("bucket", "i", "j"))
    order = np.lexsort((j, i, bucket))
    if not len(order):
        return []
    b, x, y = bucket[order], i[order], j[order]
    return np.split(order, np.flatnonzero((b[1:] != b[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])) + 1)


def _needed(table: pa.Table) -> pa.Table:
    """The rows of those sets that have a pair to compare in their group."""
    block, earlier, i, j = table["block"].to_numpy(), table["earlier"].to_pylist(), table["i"].to_numpy(), table["j"].to_numpy()
    keep = []
    for rows in _group_cuts(table):
        one = i[rows[0]] == j[rows[0]]
        pairs = _candidates(None if one else block[rows], [np.array(earlier[r], np.int64) for r in rows])
        keep.append(rows[pairs.any(0) | pairs.any(1)])
    return table.take(pa.array(np.concatenate(keep) if keep else np.zeros(0, np.int64)))


def _linked(table: pa.Table) -> pa.Table:
    """rep, n_links (rows of linked classes) and least (the least set it is connected with here) of sets with a link."""
    rep, size, n = table["rep"].to_numpy(), table["size"].to_numpy(), table["n"].to_numpy().astype(np.int64)
    block, earlier, i, j = table["block"].to_numpy(), table["earlier"].to_pylist(), table["i"].to_numpy(), table["j"].to_numpy()
    sets = [np.frombuffer(s.as_py(), "<u4") for s in table["tokens"]]
    out: list[list] = [[], [], []]
    for rows in _group_cuts(table):
        if len(rows) < 2:
            continue
        one = i[rows[0]] == j[rows[0]]
        pairs = _candidates(None if one else block[rows], [np.array(earlier[r], np.int64) for r in rows])
        common = np.rint(_tokens_in_common([sets[r] for r in rows])).astype(np.int64)
        total = n[rows][:, None] + n[rows][None, :] - common
        pairs &= SIMILAR[1] * common >= SIMILAR[0] * total
        a, b = np.nonzero(pairs)
        if not len(a):
            continue
        links = np.bincount(a, size[rows[b]], len(rows)) + np.bincount(b, size[rows[a]], len(rows))
        least = rep[rows].copy()
        while True:
            new = least.copy()
            np.minimum.at(new, a, least[b])
            np.minimum.at(new, b, new[a])
            if (new == least).all():
                break
            least = new
        for k in np.flatnonzero(links):
            for column, value in zip(out, (rep[rows[k]], int(links[k]), least[k])):
                column.append(value)
    return pa.table([pa.array(c, pa.int64()) for c in out], ["rep", "n_links", "least"])


# --- components ----------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for edges (a, b): the least node that each can reach. Labels of neighbours are taken on, then labels
    of labels, until none changes; every round is written, so a lost executor costs at most one round."""
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near"))
        stepped = labels.join(near, F.col("node") == F.col("a"), "left").select("node", "label", F.least("label", F.coalesce("near", "label")).alias("new"))
        stepped = materialise(stepped, "labels-step")
        jump = stepped.select(F.col("node").alias("to"), F.col("new").alias("jumped"))
        after = materialise(stepped.join(jump, stepped["new"] == jump["to"], "left").select("node", "label", F.least("new", F.coalesce("jumped", "new")).alias("new")), "labels-jump")
        labels = after.select("node", F.col("new").alias("label"))
        if not after.where("new != label").limit(1).count():
            return labels


# --- the join ------------------------------------------------------------------------------------------------------


def _tokens(rows: DataFrame) -> DataFrame:
    """A row for each group a set is needed in, with the set's tokens (the upper half of its shingles' hashes)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SHORT_SLICE):
            hashes, at = shingle_sets(batch.column(batch.schema.get_field_index("text")))
            tokens = (hashes >> np.uint64(32)).astype("<u4")
            sets = pa.array([tokens[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), sets], ["rep", "groups", "tokens"])

    group = "array<struct<task:int,bucket:long,i:int,j:int,block:int,earlier:array<long>,size:long,n:int>>"
    return rows.select("rep", "groups", "text").mapInArrow(work, f"rep long, groups {group}, tokens binary").select("rep", "tokens", F.inline("groups"))


def _classified(texts: DataFrame, size: int, recall: float) -> DataFrame:
    """id, doc_id, class_id, n_links, n_shingles, first."""
    tasks = an.buckets_for(size, an.ANCHOR_BUCKET)
    paths = materialise(_paths(texts, runs_for(recall)), "paths")
    full = paths.where("n > 0")
    classes = materialise(full.groupBy("one", "two", "n").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size")), "classes")
    reps = full.join(classes.select("rep", "size"), F.col("id") == F.col("rep"))
    groups = materialise(_groups(_buckets(reps), tasks), "groups")
    shape = "task int, bucket long, i int, j int, block int, rep long, earlier array<long>"
    needed = groups.select("task", "bucket", "i", "j", "block", "rep", "earlier").groupBy("task").applyInArrow(_needed, shape)
    wanted = needed.join(classes.select("rep", "size", "n"), "rep")
    wanted = wanted.groupBy("rep").agg(F.collect_list(F.struct("task", "bucket", "i", "j", "block", "earlier", "size", "n")).alias("groups"))
    wanted = materialise(wanted, "compared")
    compared = _tokens(texts.select("id", "text").join(wanted, F.col("id") == F.col("rep")))
    linked = compared.groupBy("task").applyInArrow(_linked, "rep long, n_links long, least long")
    linked = materialise(linked, "links")
    labels = components(linked.select(F.col("rep").alias("a"), F.col("least").alias("b")))
    per_rep = linked.groupBy("rep").agg(F.sum("n_links").alias("linked"))
    labelled = classes.join(per_rep, "rep", "left").join(labels, F.col("rep") == F.col("node"), "left")
    labelled = labelled.select("one", "two", F.col("n").alias("m"), F.coalesce("label", "rep").alias("label"), (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    names = paths.select(F.col("id").alias("label"), F.col("doc_id").alias("class_id"))
    labelled = labelled.join(names, "label")
    rows = paths.select("id", "doc_id", "n", "one", "two")
    rows = rows.join(labelled, (rows["one"] == labelled["one"]) & (rows["two"] == labelled["two"]) & (rows["n"] == labelled["m"]), "left")
    alone = F.col("m").isNull()
    class_id = F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id")
    return rows.select("id", "doc_id", class_id, F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("n").cast("long").alias("n_shingles"), (alone | (F.col("id") == F.col("label"))).alias("first"))


def similar_documents(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """Per row: doc_id, class_id, n_links, n_shingles and first.

    Two rows are linked if the Jaccard similarity of their shingle sets is 0.8 or more; ``n_links`` counts the other rows
    linked to a row (a pair just at 0.8 is found with probability ``recall``, more similar ones almost surely).
    ``class_id`` is the least doc_id among the rows connected by links, ``first`` marks the one row of each class that
    has it. Shingles are five consecutive words ``[^\\x20\\x09-\\x0D]+`` as they stand; a text of one to four words is one
    shingle; null and empty texts have none, are linked to nothing and each is a class of its own. A null doc_id is
    less than all others; rows may repeat ids and texts; other columns are ignored; an empty table gives an empty one.
    """
    return _classified(*an.numbered(docs), recall).drop("id")


def first_of_each_class(docs: DataFrame, recall: float = RECALL) -> DataFrame:
    """``docs`` without the rows that belong to a class of similar ones but are not its first."""
    texts, size = an.numbered(docs, tuple(docs.columns))
    kept = _classified(texts.select("id", "doc_id", "text"), size, recall).where("first").select("id")
    return texts.join(kept, "id", "left_semi").select("_keep.*")
