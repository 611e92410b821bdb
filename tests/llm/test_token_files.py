"""Token counts against the tokenizer and a plain loop over the ids."""

from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from lossledger.llm import token_files
from lossledger.llm.tokens import vocabulary_path
from tests.conftest import SMALL

SPANS = "file string, block long, data binary, extra int"


def plain_spans(file, ids, end):
    out, start = [], 0
    for i, x in enumerate(ids):
        if x == end:
            out.append((file, len(out), start, i - start, True))
            start = i + 1
    return out + ([(file, len(out), start, len(ids) - start, False)] if start < len(ids) else [])


def test_spans_across_blocks_and_groups(spark):
    rng = np.random.default_rng(5)
    files = {
        "a": rng.integers(0, 4, 500), "b": np.full(40, 3), "none": np.arange(10) + 10, "long": np.r_[np.full(300, 9), 3, np.full(90, 8), 3], None: np.array([3, 1, 3]),
        "empty": np.zeros(0, int),
    }
    rows, want = [], []
    for f, ids in files.items():
        data = ids.astype("<u2").tobytes()
        rows += [(f, k, data[at : at + 14], 1) for k, at in enumerate(range(0, max(1, len(data)), 14))]
        want += plain_spans(f, ids.tolist(), 3)
    got = token_files.document_spans(spark.createDataFrame(rows, SPANS).repartition(4), end_id=3, group=3).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_files.document_spans(spark.createDataFrame([], SPANS)).collect() == []


def test_flat_files_on_disk(spark, tmp_path):
    ids = np.array([5, 6, 3, 7, 3, 8] * 50, "<u2")
    (tmp_path / "x.bin").write_bytes(ids.tobytes())
    got = token_files.document_spans(token_files.read_flat_files(spark, str(tmp_path), 22), end_id=3).drop("file").collect()
    assert sorted(map(tuple, got)) == sorted(r[1:] for r in plain_spans("", ids.tolist(), 3))


def test_a_file_beyond_two_gigabytes(spark, tmp_path):
    """Most of the file is a hole; ends of documents lie before, in and after what fits into one row."""
    end, size = 49407, (1 << 31) + (1 << 28)
    places = [10, 1 << 20, (1 << 30) - 1, (1 << 30) + 5, size // 2 - 1]  # in tokens of two bytes
    with open(tmp_path / "large file.bin", "wb") as f:
        f.truncate(size)
        for at in places:
            f.seek(2 * at)
            f.write(np.array([end], "<u2").tobytes())
    (tmp_path / "small.bin").write_bytes(np.array([1, 2, end], "<u2").tobytes())
    blocks = token_files.read_flat_files(spark, str(tmp_path), block_bytes=1 << 24)
    got = sorted((r["start"], r["n_tokens"], r["ended"]) for r in token_files.document_spans(blocks).where("n_tokens <> 2").collect())
    starts = [0, *(p + 1 for p in places[:-1])]
    assert got == [(a, b - a, True) for a, b in zip(starts, places)]


def test_counts_of_documents(spark):
    full = Tokenizer.from_file(vocabulary_path())
    full.encode_special_tokens = True
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    docs += [(900, None), (901, ""), (None, "x"), (1, "twice"), (1, "twice"), (902, "a <|endoftext|> b"), (903, "long " * 40_000)]
    df = spark.createDataFrame([(d, t, 3) for d, t in docs], "doc_id long, text string, start int").repartition(3)
    got = token_files.token_counts(df, block_bytes=1 << 12).collect()
    want = Counter((d, len(full.encode(t, add_special_tokens=False).ids) if t else 0) for d, t in docs)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == want
