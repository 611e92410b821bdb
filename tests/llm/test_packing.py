"""Packing against the tokenizer itself and an exact check of every sequence."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lossledger.llm import packing
from lossledger.llm.tokens import PackedIds, vocabulary_path
from tests.conftest import SMALL

ODD = [
    None, "", " ", "It's <|endoftext|> a\x1cb é é ﬁ İstanbul ΣΑΣ 日本語 naïve3.14!! don't we'll", "<|startoftext|>x",
    " a b c\x85d", "x" * 30_000, "the " * 9000, "Straße ÀÉ ÿ ŉ", "a" * 4095,
]


@pytest.fixture(scope="module")
def full():
    return Tokenizer.from_file(vocabulary_path())


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdeéèßñü ThE'.,!?123\n\t<|>İΣµªº́中\x1c\xa0"), max_size=60))
def test_ids_equal_the_tokenizers(text):
    ids = test_ids_equal_the_tokenizers
    if not hasattr(ids, "both"):
        ids.both = PackedIds(vocabulary_path(), remembered=50), Tokenizer.from_file(vocabulary_path())
    fast, slow = ids.both
    assert np.frombuffer(fast.of(text), "<u4").tolist() == slow.encode(text, add_special_tokens=False).ids


def check(rows, size):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def best_fit_decreasing(lengths, size):
    gaps: list[int] = []
    for x in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= x]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - x)
        else:
            gaps.append(size - x)
    return len(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_rounds_open_as_many_sequences_as_best_fit(lengths):
    counts = Counter(lengths)
    table = packing.rounds(counts, 30)
    rows = []
    for x, rank, n, first, per, offset in table.tolist():
        rows += [{"sequence_id": first + i // per, "offset": offset + i % per * x, "length": x} for i in range(n)]
    assert Counter(r["length"] for r in rows) == counts
    assert check(rows, 30) == best_fit_decreasing(lengths, 30)


def test_documents(spark, full):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").limit(80).collect()
    docs = [(r["doc_id"], r["text"]) for r in docs] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "x y"), (1, "again"), (1, "again")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, length int, task int").repartition(3)
    rows = packing.pack_documents(df).collect()
    want = Counter()
    for d, t in docs:
        ids = (full.encode(t, add_special_tokens=False).ids if t else []) + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[d, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    check(rows, 4096)


def test_sequences_hold_the_ids(spark, full):
    df = spark.createDataFrame([(1, "a b c"), (2, None), (3, "the end")], "doc_id long, text string")
    got = sorted(packing.sequences(df, sequence_tokens=6).collect(), key=lambda r: r["sequence_id"])
    ids = [i for r in got for i in r["ids"]]
    want = [full.encode(t, add_special_tokens=False).ids + [1] if t else [1] for t in ("a b c", None, "the end")]
    assert sorted(ids) == sorted(i for w in want for i in w)
    for r in got:
        for at, doc in zip(r["starts"], r["doc_ids"]):
            assert r["ids"][at : at + len(want[doc - 1])] == want[doc - 1]


def test_empty(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
