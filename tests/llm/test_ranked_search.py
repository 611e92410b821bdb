"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import pytest

from lossledger.llm import ranked_search as S

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items):
    split = [(d, Counter(terms(t))) for d, t in docs]
    split = [(d, c, c.total()) for d, c in split if c]
    n, total = len(split), sum(x for _, _, x in split)
    df = Counter(t for _, c, _ in split for t in c)
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        rows = []
        for d, c, length in split:
            m = 75 + 25 * length * n // total
            score = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m)) for t, k in asked.items() if t in c)
            if score > 0:
                rows.append((-score, d is None, d or 0))
        for rank, (score, absent, d) in enumerate(sorted(rows)[:20], 1):
            out.append((item, rank, None if absent else d, -score))
    return sorted(out, key=repr)


def run(spark, docs, items, **sizes):
    d = spark.createDataFrame([(a, b, 1, "r") for a, b in docs], "doc_id long, text string, rank int, item_id string").repartition(5)
    i = spark.createDataFrame([(a, b, "d") for a, b in items], "item_id long, text string, doc_id string")
    return sorted((tuple(r) for r in S.search(d, i, **sizes).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def corpus(seed, n=900):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(4000)] + ["Straße", "naïve", "日本", "X1", "x1", "İ", "É"]
    text = lambda k: rng.choice([" ", ", ", "-", "_", "\n"]).join(rng.choices(words, k=k))
    docs = [(i, text(rng.choice([1, 3, 30, 200]))) for i in range(n)]
    items = [(i, text(rng.choice([1, 5, 40]))) for i in range(25)]
    copied = text(60)
    docs += [(5000 + 3 * i, copied) for i in range(300)] + [(8000 + i, f"{copied} {items[3][1]}") for i in range(150)]
    docs += [(None, None), (None, copied), (1, ""), (2, " .,-"), (7, docs[7][1]), (9999, "w1 " * 20000)] + [(9000 + i, "w1 w2 " + "w3 " * (i % 90)) for i in range(400)]
    items += [(None, items[0][1]), (3, items[3][1]), (100, None), (101, "..."), (102, "zzzunknown"), (103, copied), (104, "w1 w1 w1"), (105, "w3 w2")]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("sizes", [{}, {"entries": 500}, {"block": 200}])
def test_against_all_pairs(spark, sizes):
    docs, items = corpus(2)
    assert run(spark, docs, items, **sizes) == plain(docs, items)


@pytest.mark.parametrize("docs, items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a")], [(1, None)])])
def test_empty_sides(spark, docs, items):
    assert run(spark, docs, items) == []


def test_bounds_leave_out_subtrees(spark):
    """With items that some documents hold in full, most leaves are never scored."""
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [np.unique(np.minimum(rng.zipf(1.3, 60), 3000) - 1) for _ in range(6000)]
    at = np.r_[0, np.cumsum([len(r) for r in rows])]
    tree = S.Tree(list(range(len(rows))), np.full(len(rows), 100), at, np.concatenate(rows), np.ones(at[-1], np.int64))
    weights = np.floor(1000 * np.log(6000 / (1 + np.bincount(np.concatenate(rows), minlength=3000)))).astype(np.int64)
    scored = []
    reduceat = np.add.reduceat

    class Counting:
        def __getitem__(self, at):
            scored.append(1)
            return self.dense[at]

    ranks = max(rows, key=len)
    counting = Counting()
    counting.dense = np.zeros(3000, np.int64)
    counting.dense[ranks] = weights[ranks]
    best = []
    tree.search(ranks, weights[ranks], counting, best)
    leaves = sum(not c for c in tree.children)
    all_scores = sorted(((-int(reduceat(counting.dense[r] * S._part(np.ones(len(r), np.int64), np.full(len(r), 100)), [0])[0]), i) for i, r in enumerate(rows)))[:20]
    assert [(s, d) for s, _, d in best] == all_scores
    assert len(scored) < leaves
