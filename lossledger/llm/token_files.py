"""Token counts from flat token files that have no index.

A flat file is nothing but fixed-width ids, each document closed by the end-of-document id. It is read as blocks of equal
size that know their file and number. Every block is searched for the end id in one vectorised comparison, wherever
documents begin; a prefix scan over the blocks (tokens before, ends before, last end before) then stitches documents
that run across them. The scan goes over small groups of blocks first and over the groups after, so that one very large
file isn't one task's window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossledger.llm.tokens import packed_ids, vocabulary_path
from lossledger.sources.tables import materialise

#: Fixed value: the end-of-document id of the default vocabulary.
END_OF_DOCUMENT = 49407
BLOCK_BYTES = 1 << 19
WIDTH = 2
#: Blocks scanned together before the scan over groups.
GROUP = 1024
#: Bytes of a file that a task reads in one go, and the most tasks that read files.
STRETCH, MOST_TASKS = 1 << 27, 100_000


def write_token_files(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_OF_DOCUMENT, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Tokenize documents into one flat file per task, and list what each file holds.

    Returns the blocks (file, block, data) and the listing (file, ordinal, doc_id) of documents in the order in which
    they stand in their file. Spellings of special tokens in a text are plain text, so the end id never comes from one.
    A null text has no tokens but its end id. Blocks are rows of a table, since every store that Spark reaches can hold
    those; ``read_flat_files`` gives the same rows for files made elsewhere, of any length.
    """
    path = vocabulary_path(vocabulary)
    kind = f"<u{width}"
    end = np.array([end_id], kind).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = packed_ids(path, True).of
        file = TaskContext.get().partitionId()
        held, block, ids = bytearray(), 0, []

        def full(most: int) -> Iterator[pa.RecordBatch]:
            nonlocal block, held, ids
            while len(held) > most:
                columns = [pa.array([file]), pa.array([block]), pa.array([bytes(held[:block_bytes])], pa.binary()), pa.array([ids], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["file", "block", "data", "doc_ids"])
                del held[:block_bytes]
                block, ids = block + 1, []

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held += np.frombuffer(of(text.as_py()), "<u4").astype(kind).tobytes() + end
                ids.append(doc)
                yield from full(block_bytes)
        yield from full(0)

    plain = docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string"))
    written = materialise(plain.mapInArrow(write, "file long, block long, data binary, doc_ids array<long>"), "token-files")
    first = F.sum(F.size("doc_ids")).over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    listed = written.select("file", "doc_ids", F.coalesce(first, F.lit(0)).alias("first"))
    listing = listed.select("file", "first", F.posexplode("doc_ids").alias("at", "doc_id"))
    return written.select("file", "block", "data"), listing.select("file", (F.col("first") + F.col("at")).alias("ordinal"), "doc_id")


def _open(path: str):
    """A file of any store that Arrow knows, to seek in."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    store, inside = pafs.FileSystem.from_uri(path)
    return store.open_input_file(inside)


def read_flat_files(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, stretch: int = STRETCH, opened: Callable = _open) -> DataFrame:
    """Blocks (file, block, data) of the flat files under ``path``, however long. Only names and lengths are listed; a task
    opens the file (``opened(path)`` gives something to seek and read in), goes to its own stretch and reads that."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select(F.col("path").alias("file"), "length")
    each = max(1, stretch // block_bytes)
    starts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / block_bytes), F.lit(each).cast("long"))
    stretches = files.select("file", F.explode(starts).alias("first"))
    # as many tasks as stretches, up to a bound
    parts = max(1, min(stretches.count(), MOST_TASKS))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with opened(file) as f:
                    f.seek(first * block_bytes)
                    for block in range(first, first + each):
                        data = f.read(block_bytes)
                        if data:
                            yield pa.RecordBatch.from_arrays([pa.array([file]), pa.array([block]), pa.array([data], pa.binary())], ["file", "block", "data"])

    return stretches.repartition(parts, "file", "first").mapInArrow(read, "file string, block long, data binary")


def document_spans(blocks: DataFrame, end_id: int = END_OF_DOCUMENT, width: int = WIDTH, group: int = GROUP) -> DataFrame:
    """One row per document: file, ordinal (its number in the file), start (in tokens), n_tokens (without the end id),
    ended.

    ``blocks`` has file, block (0, 1, ... in each file, none missing) and data, a whole number of ids. Tokens after the
    last end id of a file are a document with ``ended`` false. A null file is a file; null data is empty; an empty table
    has no documents. Other columns are ignored.
    """
    kind = f"<u{width}"

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(d.as_py() or b"", kind) for d in batch.column(2)]
            ends = pa.array([np.flatnonzero(x == end_id) for x in found], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([len(x) for x in found], pa.int64()), ends], ["file", "block", "n", "ends"])

    file_type = blocks.schema["file"].dataType.simpleString()
    searched = blocks.select("file", F.col("block").cast("long").alias("block"), F.col("data").cast("binary").alias("data"))
    found = materialise(searched.mapInArrow(search, f"file {file_type}, block long, n long, ends array<long>"), "block-ends")
    found = found.withColumn("part", F.floor(F.col("block") / group))

    # over the groups: what lies before each of them; the last end counts from the group's own begin
    in_part = Window.partitionBy("file", "part").orderBy("block")
    earlier = in_part.rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    scanned = found.withColumn("base", base)
    scanned = scanned.withColumn("last", F.col("base") + F.get("ends", F.size("ends") - 1))
    scanned = scanned.withColumns({"nth": F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)), "open": F.max("last").over(earlier)})
    parts = scanned.groupBy("file", "part").agg(F.sum("n").alias("n"), F.sum(F.size("ends")).alias("n_ends"), F.max("last").alias("last"))
    before = Window.partitionBy("file").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("part_base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    parts = parts.withColumns({"part_nth": F.coalesce(F.sum("n_ends").over(before), F.lit(0)), "part_open": F.max(F.col("part_base") + F.col("last")).over(before)})
    parts = materialise(parts, "block-groups")

    keys = parts.select(F.col("file").alias("_file"), F.col("part").alias("_part"), "part_base", "part_nth", "part_open")
    joined = scanned.join(keys, scanned["file"].eqNullSafe(keys["_file"]) & (scanned["part"] == keys["_part"]))
    opened = F.coalesce(F.col("part_base") + F.col("open"), F.col("part_open"), F.lit(-1)) + 1
    rows = joined.select("file", (F.col("part_nth") + F.col("nth")).alias("first"), (F.col("part_base") + F.col("base")).alias("base"), opened.alias("opened"), "ends")
    ended = rows.select("file", "first", "base", "opened", "ends", F.posexplode("ends").alias("k", "end"))
    start = F.when(F.col("k") == 0, F.col("opened")).otherwise(F.col("base") + F.get("ends", F.col("k") - 1) + 1)
    ended = ended.select("file", (F.col("first") + F.col("k")).alias("ordinal"), start.alias("start"), (F.col("base") + F.col("end") - start).alias("n_tokens"), F.lit(True).alias("ended"))

    total = parts.groupBy("file").agg(F.sum("n").alias("n"), F.sum("n_ends").alias("ordinal"), F.coalesce(F.max(F.col("part_base") + F.col("last")) + 1, F.lit(0)).alias("start"))
    tail = total.where("n > start").select("file", "ordinal", "start", (F.col("n") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(tail)


def token_counts(docs: DataFrame, vocabulary: str | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens, file and start of every document, from its flat token file. Rows that repeat a doc_id are
    documents of their own; a null doc_id stays null; null and empty texts count 0."""
    blocks, listing = write_token_files(docs, vocabulary, block_bytes=block_bytes)
    spans = document_spans(blocks)
    return spans.join(listing, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")
