"""The Jaccard join against all pairs."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from lossledger.llm import jaccard

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, id int, n int"


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def plain(docs):
    sets = [shingles(t) for _, t in docs]
    by = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            by[x].append(k)
    common = Counter()
    for members in by.values():
        for a in range(len(members)):
            for b in range(a):
                common[members[b], members[a]] += 1
    root, links = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), n in common.items():
        if 5 * n >= 4 * (len(sets[a]) + len(sets[b]) - n):
            links[a] += 1
            links[b] += 1
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return sorted((d, docs[find(k)][0], links[k], len(sets[k])) for k, (d, _) in enumerate(docs))


def edited(rng, text, edits):
    words = text.split(" ")
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(99)}"
    return " ".join(words)


@pytest.mark.parametrize("small", [64, 2])
def test_documents(spark, monkeypatch, small):
    monkeypatch.setattr(jaccard, "SMALL", small)
    if small == 2:
        monkeypatch.setattr(jaccard, "BLOCK", 7)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 500").collect()]
    rng = random.Random(4)
    long = max((t for _, t in docs[:50]), key=len)[:4000]
    for k in range(90):
        docs.append((1000 + k, edited(rng, rng.choice(docs)[1], rng.randrange(4))))
    for k in range(45):
        docs.append((2000 + k, edited(rng, long, rng.randrange(9))))
    docs += [(3000, "a b"), (3001, "a b"), (3002, "a b c"), (3003, "a b c d e"), (3004, "a b c d e f"), (3005, "one two three four five six seven eight nine"), (3006, "one two three four five six seven eight")]
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], SCHEMA).repartition(4)
    got = sorted(tuple(r) for r in jaccard.similar_documents(df).select("doc_id", "class_id", "n_links", "n_shingles").collect())
    assert got == plain(docs)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (4, "z"), (5, " ")]
    df = spark.createDataFrame([(d, t, "x", 1, 2) for d, t in docs], SCHEMA)
    got = sorted(((r["doc_id"], r["class_id"], r["n_links"], r["first"]) for r in jaccard.similar_documents(df).collect()), key=repr)
    assert got == sorted([(1, 1, 0, True), (2, 2, 0, True), (5, 5, 0, True), (4, 4, 0, True), (None, None, 2, True), (4, None, 2, False), (4, None, 2, False)], key=repr)
    kept = jaccard.first_of_each_class(df)
    assert kept.columns == df.columns and kept.count() == 5
    assert jaccard.similar_documents(df.limit(0)).collect() == []


def test_sampling_meets_its_recall():
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(10**6)]
    missed, pairs = 0, 150
    for _ in range(pairs):  # all but a tenth in common: similarity just above 0.8
        base = [words[i] for i in rng.integers(0, 10**6, 200)]
        a = pa.array([" ".join(base).encode(), " ".join(base[:179] + [words[i] for i in rng.integers(0, 10**6, 21)]).encode()])
        hashes, at = jaccard.shingle_sets(a)
        row, parent, token = jaccard._sampled(hashes, at, 3)[0]
        missed += not {*zip(parent[row == 0].tolist(), token[row == 0].tolist())} & {*zip(parent[row == 1].tolist(), token[row == 1].tolist())}
    assert missed / pairs < 0.37**3 + 0.05  # three runs at the first level
    assert 1 - (1 - 0.374) ** jaccard.runs_for() >= jaccard.RECALL


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (4, 5), (5, 6), (7, 6), (20, 20)]
    got = {r["node"]: r["label"] for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 1 for k in range(1, 8)}, 10: 10, 11: 10}


def test_long_sets_are_compared_in_bounded_memory():
    import tracemalloc

    rng = np.random.default_rng(3)
    common = rng.integers(0, 2**32, 6000, dtype=np.uint32)
    sets = [np.unique(np.r_[common, rng.integers(0, 2**32, 2000 + k, dtype=np.uint32)]) for k in range(500)]
    tracemalloc.start()
    got = jaccard._tokens_in_common(sets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150e6  # 4,000,000 tokens
    for a, b in ((0, 1), (3, 490), (77, 78)):
        assert got[a, b] == len(np.intersect1d(sets[a], sets[b]))
