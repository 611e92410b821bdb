"""Exact copies against a dictionary of whole texts, at every level of the recursion."""

import hashlib
import random
from collections import defaultdict

import pytest

from lossledger.llm import grace

RNG = random.Random(4)


def plain(rows):
    groups = defaultdict(list)
    for i, (doc, text) in enumerate(rows):
        groups[text or ""].append((doc is not None, doc or 0, i))
    out = []
    for text, members in groups.items():
        known, best, _ = max(members)
        for has, doc, _ in members:
            out.append((doc if has else None, best if known else None, len(members), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def shown(result):
    rows = result.collect()
    kept = [r for r in rows if r.kept]
    assert len({r.text_sha256 for r in rows}) == len(kept) and all(r.doc_id == r.keep_id for r in kept)
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=repr)


def frame(spark, rows, parts=7):
    return spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, rep int, digest string").repartition(parts)


ROWS = [(None, None), (None, ""), (3, ""), (3, ""), (4, " "), (None, "only"), (None, "only"), (9, "Ä"), (10, "Ä"), (11, "Ä"), (2, "x" * 300_000), (1, "x" * 300_000), (12, "x" * 300_001)]
ROWS += [(100 + i, "hot text " * 40) for i in range(400)] + [(1000 + i, f"text {RNG.randrange(300)} " * 20) for i in range(600)]


@pytest.mark.parametrize("sizes", [{}, {"held": 1}, {"held": 1, "bucket": 10**9, "most": 4000}, {"held": 2000, "bucket": 5000, "most": 700}, {"held": 1, "bucket": 10**9, "most": 1}])
def test_against_whole_texts(spark, sizes):
    """With a table of its own for each row (held=1) every copy travels, so that one text fills buckets many times over."""
    assert shown(grace.exact_copies(frame(spark, ROWS), **sizes)) == plain(ROWS)


def test_same_hash_different_texts():
    table = grace.ContentTable()
    texts = [f"{i}".encode() for i in range(3000)]
    assert [table.entry(i % 5, t) for i, t in enumerate(texts)] == list(range(3000))
    assert [table.entry(i % 5, t) for i, t in enumerate(texts)] == list(range(3000)) and table.bytes == sum(map(len, texts))


def test_empty_and_clashing(spark):
    assert grace.exact_copies(frame(spark, [])).collect() == []
    one = spark.createDataFrame([(5, "a", 1, True, 2)], "doc_id int, text string, keep_id int, kept boolean, group_size int")
    assert [tuple(r) for r in grace.exact_copies(one).collect()] == [(5, 5, 1, True, hashlib.sha256(b"a").hexdigest())]
