"""Best-fit packing of token sequences, in bulk rounds.

Documents longer than a sequence are cut; all pieces are then placed whole. Lengths are integers of at most
``sequence_tokens``, so documents sorted by length and gaps sorted by size are runs: at most that many of each, however
many rows stand behind them. A round takes all documents of one length, longest first. The successor sweep finds the
smallest gaps that hold them, a gap takes as many of them as it can, the documents' ranks say which goes where, the gaps
shrink, and the next round follows. New sequences are opened only when no gap is left. A gap that takes a document of
length x ends below x and below half its size, so a run is touched at most log2(sequence_tokens) times and the rounds
make a table whose size depends on ``sequence_tokens`` alone.

The rows stay distributed: a document's rank among those of its length is its number within its task plus the counts of
the tasks before, and its place follows from the rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lossledger.llm.tokens import packed_ids, vocabulary_path
from lossledger.sources.tables import materialise

SEQUENCE_TOKENS = 4096
END_ID = 1

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def token_pieces(docs: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID, vocabulary: str | None = None, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, task and nth (the number among the task's pieces of
    this length); with ``ids`` also the ids as little-endian unsigned 32-bit bytes. A null text is empty: its piece is
    the end id alone."""
    path = vocabulary_path(vocabulary)
    end = np.array([end_id], "<u4").tobytes()
    schema = _PIECES + (", ids binary" if ids else "")
    width = 4 * sequence_tokens

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = packed_ids(path).of
        task = TaskContext.get().partitionId()
        seen = [0] * (sequence_tokens + 1)
        for batch in batches:
            out: list[list] = [[] for _ in range(8 if ids else 7)]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                whole = of(text.as_py()) + end
                for piece, at in enumerate(range(0, len(whole), width)):
                    part = whole[at : at + width]
                    n = len(part) // 4
                    for column, value in zip(out, (doc, piece, at // 4, n, zlib.crc32(part), task, seen[n], part)):
                        column.append(value)
                    seen[n] += 1
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids"]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, types)], names[: len(out)])

    return docs.select(docs["doc_id"].cast("long"), docs["text"].cast("string")).mapInArrow(cut, schema)


def rounds(counts: dict[int, int], size: int) -> np.ndarray:
    """The rounds as rows (length, first rank, ranks, first sequence, per sequence, offset): documents of ``length``
    from ``first rank`` on go to consecutive sequences, ``per sequence`` to each, from ``offset``."""
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(size + 1)]  # by gap: runs (first sequence, how many)
    open_gaps, opened, out = 0, 0, []

    def put(gap: int, first: int, n: int) -> None:
        nonlocal open_gaps
        if gap and n:
            gaps[gap].append((first, n))
            open_gaps |= 1 << gap

    for x in sorted(counts, reverse=True):
        need, rank = counts[x], 0
        while need:
            fitting = open_gaps >> x
            if fitting:
                gap = x + (fitting & -fitting).bit_length() - 1
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    open_gaps &= ~(1 << gap)
            else:
                gap, first = size, opened
                n = -(-need // (size // x))
                opened += n
            per = gap // x
            full = min(n, need // per)
            rest = min(need - full * per, per) if full < n else 0
            if full:
                out.append((x, rank, full * per, first, per, size - gap))
            if rest:
                out.append((x, rank + full * per, rest, first + full, rest, size - gap))
                put(gap - rest * x, first + full, 1)
            put(gap - per * x, first, full)
            used = full + (rest > 0)
            put(gap, first + used, n - used)
            rank += full * per + rest
            need -= full * per + rest
    return np.array(out, np.int64).reshape(-1, 6)


def pack(pieces: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS) -> DataFrame:
    """Adds sequence_id and offset to rows with length, task and nth (as ``token_pieces`` gives them). Every length must
    be from 1 to ``sequence_tokens``; equal lengths are placed in order of task and nth. An empty table gives an empty
    one; other columns pass through. ``pieces`` is read three times, so pass a written table."""
    per_task = pieces.groupBy("task", "length").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = materialise(per_task.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "length-counts")
    # at most sequence_tokens rows
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = rounds(counts, sequence_tokens)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    lengths, ranks = table[:, 0], table[:, 1]

    @F.pandas_udf("sequence_id long, offset long")
    def place(length, rank):
        import pandas as pd

        length, rank = length.to_numpy(), rank.to_numpy()
        lo = np.searchsorted(lengths, length, "left")
        hi = np.searchsorted(lengths, length, "right")
        while (wide := hi - lo > 1).any():  # the last run of this length that begins at or before the rank
            mid = (lo + hi) // 2
            right = wide & (ranks[np.minimum(mid, len(ranks) - 1)] <= rank)
            lo, hi = np.where(right, mid, lo), np.where(wide & ~right, mid, hi)
        run = table[lo]
        nth = rank - run[:, 1]
        return pd.DataFrame({"sequence_id": run[:, 3] + nth // run[:, 4], "offset": run[:, 5] + nth % run[:, 4] * length})

    keys = per_task.select(F.col("task").alias("_task"), F.col("length").alias("_length"), F.col("before").alias("_before"))
    # a merge join: the table of counts grows with the tasks, so it is never sent to all of them
    ranked = pieces.join(keys.hint("merge"), (pieces["task"] == keys["_task"]) & (pieces["length"] == keys["_length"]))
    placed = ranked.withColumn("_place", place(F.col("length"), F.col("nth") + F.col("_before")))
    kept = [F.col(c) for c in pieces.columns if c not in ("task", "nth")]
    return placed.select(*kept, F.col("_place.sequence_id").alias("sequence_id"), F.col("_place.offset").alias("offset"))


def pack_documents(docs: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """Where every piece of every document goes. Rows that repeat a doc_id are documents of their own; a null doc_id
    stays null; null and empty texts take one token."""
    return pack(materialise(token_pieces(docs, sequence_tokens, end_id, vocabulary), "pieces"), sequence_tokens)


def sequences(docs: DataFrame, sequence_tokens: int = SEQUENCE_TOKENS, end_id: int = END_ID, vocabulary: str | None = None) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (one array), and the documents' starts in it. A sequence holds
    at most ``sequence_tokens`` tokens, so its group is bounded."""
    pieces = materialise(token_pieces(docs, sequence_tokens, end_id, vocabulary, ids=True), "pieces")
    members = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))

    @F.pandas_udf("array<long>")
    def join(parts):
        return parts.map(lambda p: np.frombuffer(b"".join(bytes(x) for x in p), "<u4").astype(np.int64))

    grouped = pack(pieces, sequence_tokens).groupBy("sequence_id").agg(members.alias("m"))
    return grouped.select("sequence_id", join(F.col("m.ids")).alias("ids"), F.col("m.offset").alias("starts"), F.col("m.doc_id").alias("doc_ids"))
