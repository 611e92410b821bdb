"""Exact deduplication by Grace hashing.

Equal texts of one task are found first, in an open-addressing table that compares complete texts, and only one of them
travels on. These are dealt by hash into buckets and written; a bucket that fits is worked on in one such table. One that
doesn't fit is dealt again: by further bits if it holds several hashes, and if a single text fills it (many tasks sent the
same one), its copies are dealt out evenly, each part keeps one, and those meet at the next level. So what a task holds is
bounded however often a text occurs.

What travels back is small: a row's task-local copy, that copy's group, and the group's size and standing row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossledger.llm.columns import text_of
from lossledger.operators.ordered import join_summary
from lossledger.sources.tables import materialise

#: Bytes of text that a bucket should hold, the most it may hold before it is dealt again, and those of a task's own table.
BUCKET, MOST, HELD = 2_000_000, 16_000_000, 32_000_000


class ContentTable:
    """Open addressing with linear probing. Equal hashes are told apart by comparing the complete contents."""

    def __init__(self) -> None:
        self._slots = [-1] * 1024
        self._hashes: list[int] = []
        self._contents: list[bytes] = []
        self.bytes = 0

    def entry(self, hashed: int, content: bytes) -> int:
        """The number of this content; contents are numbered as they come."""
        if 2 * len(self._contents) >= len(self._slots):
            self._grow()
        at = self._free(hashed, content)
        if self._slots[at] < 0:
            self._slots[at] = len(self._contents)
            self._hashes.append(hashed)
            self._contents.append(content)
            self.bytes += len(content)
        return self._slots[at]

    def _free(self, hashed: int, content: bytes) -> int:
        slots, last = self._slots, len(self._slots) - 1
        at = hashed & last
        while (held := slots[at]) >= 0 and not (self._hashes[held] == hashed and self._contents[held] == content):
            at = (at + 1) & last
        return at

    def _grow(self) -> None:
        self._slots = [-1] * (2 * len(self._slots))
        last = len(self._slots) - 1
        for number, hashed in enumerate(self._hashes):  # all differ, so any free slot on the way will do
            at = hashed & last
            while self._slots[at] >= 0:
                at = (at + 1) & last
            self._slots[at] = number


def _local_copies(held: int):
    """Rows with rid (task and number) and rep, the rid of the first row of the task's table with the same text. Only that
    row carries the text on. A table that holds ``held`` bytes is given up for a new one."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        table, first = ContentTable(), []
        for batch in batches:
            rids, reps, digests, sizes, texts = [], [], [], [], []
            for text in batch.column(1):
                text = text.as_py()
                digest = hashlib.sha256(text).digest()
                entry = table.entry(int.from_bytes(digest[8:16], "little"), text)
                new = entry == len(first)
                if new:
                    first.append(rid)
                rids.append(rid)
                reps.append(first[entry])
                digests.append(digest)
                sizes.append(len(text))
                texts.append(text if new else None)
                rid += 1
                if table.bytes > held:
                    table, first = ContentTable(), []
            hashes = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
            columns = [batch.column(0), pa.array(rids, pa.int64()), pa.array(reps, pa.int64()), pa.array(hashes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "rid", "rep", "hash", "digest", "size", "text"])

    return work


_LOCAL = "doc_id long, rid long, rep long, hash long, digest binary, size long, text binary"


def _equal_in_bucket(rows: pa.Table) -> pa.Table:
    table, first, leaders = ContentTable(), [], []
    for rep, digest, text in zip(rows["rep"].to_pylist(), rows["digest"].to_pylist(), rows["text"]):
        entry = table.entry(int.from_bytes(digest[8:16], "little"), text.as_py())
        if entry == len(first):
            first.append(rep)
        leaders.append(first[entry])
    return pa.table([rows["rep"], pa.array(leaders, pa.int64())], ["rep", "leader"])


def _leaders(rows: DataFrame) -> DataFrame:
    """(rep, leader): the first row of each text in every bucket stands for the others."""
    return rows.select("bucket", "rep", "digest", "text").groupBy("bucket").applyInArrow(_equal_in_bucket, "rep long, leader long")


def same_text(rows: DataFrame, buckets: int, most: int = MOST) -> DataFrame:
    """(rep, leader) for rows with rep, hash, digest, size and text: rows of equal texts share a leader."""
    rest = rows.withColumn("bucket", F.pmod("hash", F.lit(buckets).cast("long")))
    found, dealt, level = [], [], 0
    while True:
        sizes = rest.groupBy("bucket").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), (F.min("hash") == F.max("hash")).alias("one"))
        parts = F.ceil(F.col("bytes") / F.lit(most))
        over = sizes.where((F.col("bytes") > most) & (F.col("n") > 1)).select("bucket", "one", F.when(F.col("one"), F.least(parts, F.floor(F.col("n") / 2))).otherwise(2 * parts).alias("parts"))
        over = materialise(over, "large-buckets")
        if over.isEmpty():
            found.append(_leaders(rest))
            break
        found.append(_leaders(rest.join(over.select("bucket"), "bucket", "left_anti")))
        large, level = rest.join(over, "bucket"), level + 1
        part = F.pmod(F.xxhash64(F.when(F.col("one"), F.col("rep")).otherwise(F.col("hash")), F.lit(level)), F.col("parts"))
        spilled = materialise(large.select("rep", "hash", "digest", "size", "text", "one", F.xxhash64("bucket", part, F.lit(level)).alias("bucket")), "spilled")
        several, single = spilled.where("not one").drop("one"), spilled.where("one").drop("one")
        edges = materialise(_leaders(single), "dealt-copies")
        dealt.append(edges.where("rep <> leader"))
        standing = edges.where("rep = leader").select("rep")
        again = single.join(standing, "rep").withColumn("bucket", F.xxhash64("hash", F.lit(-level)))
        rest = materialise(several.unionByName(again), "spilled")
    out = reduce(DataFrame.unionByName, found)
    for edges in reversed(dealt):
        out = materialise(out, "same-text")
        upper = out.select(F.col("rep").alias("_rep"), F.col("leader").alias("_leader"))
        out = out.unionByName(edges.join(upper, F.col("leader") == F.col("_rep")).select("rep", F.col("_leader").alias("leader")))
    return out


def exact_copies(docs: DataFrame, bucket: int = BUCKET, most: int = MOST, held: int = HELD) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept and text_sha256. Rows are copies if their whole texts are the same
    bytes; of these the row with the largest doc_id stays.

    A null text is an empty one. A null doc_id is smaller than any other; a group of null ids only keeps one row, with a
    null keep_id. Of rows that share text and doc_id exactly one is kept. Other columns are ignored; an empty table gives
    an empty one. Texts may be of any length: one beyond ``most`` is a bucket of its own.
    """
    plain = docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_of(docs).alias("text"))
    local = materialise(plain.mapInArrow(_local_copies(held), _LOCAL), "local-copies")
    travelling = local.where(F.col("text").isNotNull()).select("rep", "hash", "digest", "size", "text")
    buckets = (travelling.agg(F.sum("size")).first()[0] or 0) // bucket + 1
    own = local.groupBy("rep").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("doc_id", "rid")).alias("best"))
    found = materialise(own.join(same_text(travelling, buckets, most), "rep"), "copy-groups")
    groups = found.groupBy("leader").agg(F.sum("n").alias("group_size"), F.max("best").alias("stays"), F.count(F.lit(1)).alias("_n"))
    answers = join_summary(found.select("rep", "leader"), groups, ["leader"], "_n")
    rows = local.select("doc_id", "rid", "rep", "digest").join(answers.select("rep", "group_size", "stays"), "rep")
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return rows.select("doc_id", F.col("stays.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("stays.rid")).alias("kept"), digest)


#: DuckDB SQL for the same rows.
SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""
