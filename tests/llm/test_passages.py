"""Passage dedup against a plain pass over all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from lossledger.llm import anchors as an
from lossledger.llm import passages

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, id int, bucket int"


def plain(docs):
    """docs in their order -> (doc_id, n_words, n_removed, kept_sha256)"""
    seen, out = set(), []
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for s in range(len(words) - passages.WINDOW + 1):
            w = tuple(words[s : s + passages.WINDOW])
            if w in seen:
                gone[s : s + passages.WINDOW] = [True] * passages.WINDOW
            seen.add(w)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def got(spark, docs, parts=4):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], SCHEMA).repartition(parts)
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in passages.without_repeats(df).collect()]


def test_cover():
    assert {(a - b) % passages.PERIOD for a in passages.COVER for b in passages.COVER} == set(range(passages.PERIOD))


@pytest.mark.parametrize("common", [8, 0])
def test_documents(spark, monkeypatch, common):
    monkeypatch.setattr(an, "ANCHOR_BUCKET", 50_000)
    monkeypatch.setattr(an, "TEXT_BUCKET", 200_000)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400").collect()]
    rng = random.Random(1)
    for k in range(60):  # pieces of other texts, of every length around the window, at every shift
        source = rng.choice(docs)[1].split()
        a, n = rng.randrange(len(source)), rng.randrange(15, 60)
        docs.append((rng.randrange(-500, 900_000) * 2 + 1_000_001, " ".join(["new%d" % rng.randrange(9) for _ in range(rng.randrange(30))] + source[a : a + n] + ["end%d" % rng.randrange(5)] * rng.randrange(25))))
    if not common:
        monkeypatch.setattr(an, "COMMON", 1)
    assert Counter(got(spark, docs)) == Counter(plain(sorted(docs)))


def test_odd_rows(spark):
    line = " ".join(f"w{i}" for i in range(25))
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "x " * 5000), (5, line), (7, line + " tail"), (6, "\xa0" + line), (8, " ".join(["a b c"] * 40)), (9, "\x85".join("abc") + " " + line)]
    assert Counter(got(spark, docs)) == Counter(plain(sorted(docs)))
    assert got(spark, []) == []


def test_nulls_and_repeated_ids(spark):
    line = " ".join(f"w{i}" for i in range(25))
    rows = got(spark, [(5, line), (5, line), (None, line), (None, "short")])
    assert sorted((str(d), n, k) for d, n, k, _ in rows) == [("5", 25, 25), ("5", 25, 25), ("None", 1, 0), ("None", 25, 0)]


def test_texts_of_one_id_come_in_their_order(spark):
    line = " ".join(f"w{i}" for i in range(25))
    start = "the same beginning of more than sixty-four bytes, so that rows share a range "
    docs = [(d, f"{head}{x} {line} {d}") for d in (None, 5, 6, 7, 8) for x in ("b", "a", "c") for head in ("", start)]
    want = plain(sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())))
    assert Counter(got(spark, docs)) == Counter(want)
    assert sum(n == 0 for _, _, n, _ in want) == 1


def test_packing_round_trip():
    a, b, c, d = np.array([5, 2**63 + 1], np.uint64), np.array([-7, 9], np.int64), np.array([3, -4], np.int32), np.array([1, 0], np.uint8)
    for x, y in zip((a, b, c, d), an.unpack(an.pack(a, b, c, d))):
        assert x.tolist() == y.tolist()
