"""Leaks: planted, edited and absent; the alignment against a plain one."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lossledger.llm import decontamination as dc

SF = "/root/testdata/sf0.01"
DOCS, ITEMS = "doc_id long, text string, leaks int", "item_id long, text string"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=8), st.lists(st.integers(0, 3), max_size=20))
def test_alignment(item, passage):
    h = np.zeros((len(item) + 1, len(passage) + 1), int)
    for i in range(1, len(item) + 1):
        for j in range(1, len(passage) + 1):
            s = dc.MATCH if item[i - 1] == passage[j - 1] else dc.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + s, h[i - 1, j] + dc.GAP, h[i, j - 1] + dc.GAP)
    score, a, b, same = dc.align(np.array(item, np.uint64), np.array(passage, np.uint64))
    assert score == h.max() and 0 <= a <= b <= len(passage) and same * dc.MATCH >= score


def plain_score(item, text):
    import re

    def words(t):
        return re.findall(r"[^\W_]+", t.lower())

    a, b = words(item), words(text)
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h)) / (2 * len(a))


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(3)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = []
    for k, (item_id, text) in enumerate(items):
        words = text.split()
        for edits in (0, 1, 5, 7):
            new = list(words)
            for at in range(edits and rng.randrange(edits), len(words), edits or len(words)):
                if edits:
                    new[at] = rng.choice(["", "other", new[at] + " added"])
            out.append((10_000 + 10 * k + edits, f"{docs[k][1]} {' , '.join(new).replace('e', 'E')} {docs[k + 1][1]}"))
    return docs, items, out


def test_planted_copies(spark, planted):
    docs, items, out = planted
    df = spark.createDataFrame([(d, t, 1) for d, t in docs + out], DOCS).repartition(5)
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in dc.leak_rows(df, spark.createDataFrame(items, ITEMS)).collect()}
    for k, (item_id, _) in enumerate(items):
        for edits, least in ((0, 1.0), (5, 0.5), (7, 0.6)):
            assert got.get((10_000 + 10 * k + edits, item_id), 0) >= least
        assert (10_000 + 10 * k + 1, item_id) not in got  # every word changed
    texts = dict(docs + out)
    for (doc, item), score in [*got.items()][::7]:
        assert score == pytest.approx(plain_score(dict(items)[item], texts[doc]))
    clean = [d for d, t in docs if all(plain_score(i, t) < 0.5 for _, i in items[:5])]
    assert not any((d, i) in got for d in clean for i, _ in items[:5])


def test_three_untouched_words_suffice(spark):
    """Copies with an edit after every third or fourth word, alone and beside fuller copies that hold their n-grams too."""
    rng = random.Random(5)
    items = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(12 + k))) for k in range(8)]

    def edited(text, every, replace):
        if replace:  # every so many words, one is another
            return " ".join("other" if i % (every + 1) == every else w for i, w in enumerate(text.split()))
        return " ".join(f"{w} extra" if i % every == every - 1 else w for i, w in enumerate(text.split()))

    copies = [(1000 + 10 * k + j, f"lead in {edited(t, n, r)} and out", 1) for k, t in items for j, (n, r) in enumerate([(3, False), (4, False), (3, True)])]
    fuller = [(2000 + k, t, 1) for k, t in items] + [(3000 + k, " ".join(t.split()[k % 3 :]), 1) for k, t in items]
    b = spark.createDataFrame(items, ITEMS)
    for docs in (copies, copies + fuller):
        got = {(r["doc_id"], r["item_id"]): r["score"] for r in dc.leak_rows(spark.createDataFrame(docs, DOCS).repartition(3), b).collect()}
        want = {(d, k): s for d, t, _ in docs for k, i in items if (s := plain_score(i, t)) >= dc.LEAKED}
        assert len(want) >= len(docs) and got == pytest.approx(want)


def test_many_items_that_share_an_opening(spark, monkeypatch):
    """5,000 items that begin alike, and a text that holds the opening 50 times: little time, and the same leaks in parts."""
    import time

    rng = random.Random(9)
    opening = "which of the following"
    items = [(k, f"{opening} {' '.join(f'w{rng.randrange(10**6)}' for _ in range(14))}") for k in range(5000)]
    text = " ".join(f"{opening} {' '.join(f'v{rng.randrange(10**4)}' for _ in range(60))}" for _ in range(50))
    text += " " + items[17][1] + " filler " + " ".join(items[40][1].split()[:14])
    own = dc.Items.of(items)

    def leaks():
        import pyarrow as pa

        batch = pa.RecordBatch.from_arrays([pa.array([text])], ["text"])
        began = time.perf_counter()
        rows = next(dc._leaks(own, dc.LEAKED, None)(iter([batch]))).column(1).to_pylist()[0]
        return [(r["item_id"], r["score"]) for r in rows], time.perf_counter() - began

    found, seconds = leaks()
    assert found == [(17, 1.0), (40, pytest.approx(14 / 18))] and seconds < 4
    monkeypatch.setattr(dc, "HITS", 7000)
    monkeypatch.setattr(dc, "PASSAGES", 1000)
    assert leaks()[0] == found


def test_blocks_change_nothing(spark, planted):
    docs, items, out = planted
    df, bench = spark.createDataFrame([(d, t, 1) for d, t in out], DOCS), spark.createDataFrame(items, ITEMS)

    def rows(**k):
        return sorted((r["doc_id"], r["text"], sorted(tuple(x) for x in r["leaks"])) for r in dc.with_leaks(df, bench, **k).collect())

    assert rows() == rows(block_chars=3000)


def test_odd_rows(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, None, 0), (2, "", 0), (None, item, 0), (3, item, 0), (3, item, 0), (4, "x " * 50_000 + item + " y" * 50_000, 0), (5, (item + " ") * 2000, 0)]
    bench = [(1, item), (1, item), (None, item), (2, None), (3, ""), (4, "one two")]
    df, b = spark.createDataFrame(docs, DOCS), spark.createDataFrame(bench, ITEMS)
    got = sorted(((r["doc_id"], r["item_id"], r["score"]) for r in dc.leak_rows(df, b).collect()), key=repr)
    assert got == sorted(((d, i, 1.0) for d in (None, 3, 3, 4, 5) for i in (1, 1, None)), key=repr)
    assert dc.with_leaks(df, b).columns == ["doc_id", "text", "leaks"]
    assert dc.leak_rows(df.limit(0), b).count() == 0 and dc.leak_rows(df, b.limit(0)).count() == 0
