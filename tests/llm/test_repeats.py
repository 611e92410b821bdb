"""Byte repeats against a plain pass over all windows."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from lossledger.llm import anchors as an
from lossledger.llm import repeats

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, id int, bucket int"


def plain(docs):
    places, datas = defaultdict(list), [(t or "").encode() for _, t in docs]
    for k, data in enumerate(datas):
        for s in range(len(data) - repeats.WINDOW + 1):
            places[data[s : s + repeats.WINDOW]].append((k, s))
    gone = [np.zeros(len(d), bool) for d in datas]
    for found in places.values():
        if len(found) > 1:
            for k, s in found:
                gone[k][s : s + repeats.WINDOW] = True
    out = []
    for (doc_id, _), data, g in zip(docs, datas, gone):
        kept = bytes(b for b, x in zip(data, g) if not x)
        out.append((doc_id, len(data), int(g.sum()), int((np.diff(np.r_[0, g.astype(int)]) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def got(spark, docs, parts=4):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], SCHEMA).repartition(parts)
    return [tuple(r) for r in repeats.without_repeats(df).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()]


@pytest.mark.parametrize("common", [False, True])
def test_documents(spark, monkeypatch, common):
    monkeypatch.setattr(an, "ANCHOR_BUCKET", 30_000)
    monkeypatch.setattr(an, "TEXT_BUCKET", 100_000)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 130 AND length(text) < 6000").collect()]
    rng = random.Random(2)
    passage = docs[3][1][:420]
    for k in range(80):
        source = rng.choice(docs)[1] if k % 2 else passage
        a, n = rng.randrange(max(1, len(source) // 3)), rng.randrange(150, 500)
        docs.append((10_000 + k, f"{rng.random()} " * rng.randrange(9) + source[a : a + n] + f" {rng.random()}" * rng.randrange(9)))
    if common:
        monkeypatch.setattr(an, "COMMON", 2)
        monkeypatch.setattr(repeats, "SORTED", 2)
    assert Counter(got(spark, docs)) == Counter(plain(docs))


def test_odd_rows(spark):
    base = "".join(chr(97 + i * i % 26) + str(i) for i in range(90))
    docs = [(1, None), (2, ""), (3, "a" * 2000), (4, "b" * 200), (5, "b" * 199), (6, "c" * 200), (None, base), (7, base), (7, base), (8, "é" * 150), (9, "x\x00" * 150 + base[:150]), (10, "x\x00" * 150), (11, base[:199]), (None, "z")]
    assert Counter(got(spark, docs)) == Counter(plain(docs))
    assert got(spark, []) == []


def test_extents_against_all_pairs():
    rng = np.random.default_rng(7)
    for _ in range(60):
        n = rng.integers(2, 14)
        context = np.full((n, repeats.LEFT + repeats.WINDOW), 9, np.uint8)
        for row in context:
            for _ in range(rng.integers(0, 3)):
                row[rng.integers(0, repeats.LEFT)] = rng.integers(1, 4)
                row[repeats.LEFT + rng.integers(repeats.ANCHOR, repeats.WINDOW)] = rng.integers(1, 4)
            if rng.random() < 0.3:
                row[: rng.integers(0, 100)] = 0
            if rng.random() < 0.3:
                row[len(row) - rng.integers(1, 100) :] = 0
        key = rng.integers(0, 2, n).astype(np.uint64)
        order, left, right = repeats.extents(key, context)
        for k, i in enumerate(order):
            want = (0, 0)
            for j in range(n):
                if j != i and key[i] == key[j]:
                    before = repeats._common(context[i, repeats.LEFT - 1 :: -1], context[j, repeats.LEFT - 1 :: -1])
                    after = repeats._common(context[i, repeats.LEFT :], context[j, repeats.LEFT :])
                    if before + after >= repeats.WINDOW:
                        want = (max(want[0], before), max(want[1], after))
            assert (left[k], right[k]) == want


def test_equal_windows_share_an_anchor():
    rng = np.random.default_rng(3)
    text = rng.integers(97, 100, 900).astype(np.uint8)
    data = np.r_[text, text[300:700], text[:500]]
    own, _, _ = repeats.anchors_of(data, np.array([0, 900, 1300, 1800]))
    own = set(own.tolist())
    for a, b in ((300, 900), (0, 1300)):
        for s in range(0, 200, 7):
            assert {p - a for p in own if a + s <= p <= a + s + repeats.LEFT} & {p - b for p in own if b + s <= p <= b + s + repeats.LEFT}
