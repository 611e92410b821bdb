"""Language models: the smoothing against a plain one, held-out accuracy, and odd texts."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lossledger.llm import language

SF = "/root/testdata/sf0.01"


def plain_kneser_ney(text_grams):
    """The same estimate with dictionaries: {gram tuple: probability} for grams of the highest order."""
    counts = {language.ORDER: Counter(text_grams)}
    for k in range(language.ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount, total, kinds = {}, defaultdict(Counter), defaultdict(Counter)
    for k, c in counts.items():
        ones, twos = sum(v == 1 for v in c.values()), sum(v == 2 for v in c.values())
        discount[k] = min(0.95, max(0.1, ones / (ones + 2 * twos) if ones + twos else 0.5))
        for g, v in c.items():
            total[k][g[:-1]] += v
            kinds[k][g[:-1]] += 1

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / (1 << language.BITS)
        if not total[k][g[:-1]]:
            return p(g[1:])
        return max(counts[k][g] - discount[k], 0) / total[k][g[:-1]] + discount[k] * kinds[k][g[:-1]] / total[k][g[:-1]] * p(g[1:])

    return p


def unpack(x):
    return tuple(int(x) >> language.BITS * k & language._MASK for k in reversed(range(language.ORDER)))


def test_models_equal_a_plain_estimate():
    texts = {"a": "the cat sat on the mat and the rat", "b": "der hund und die katze unter dem tisch"}
    grams = {g: language._grams_by_text([t])[0] for g, t in texts.items()}
    langs = np.array([g for g, x in grams.items() for _ in x], dtype=object)
    models = language.LanguageModels.fit(langs, np.concatenate([*grams.values()]), np.ones(len(langs)))
    for text in ("the hat", "katze", "Ümlaut 日本", "x"):
        got, n = models.entropies([text])
        seen = [unpack(x) for x in language._grams_by_text([text])[0]]
        for j, g in enumerate(models.languages):
            p = plain_kneser_ney([unpack(x) for x in grams[g]])
            assert got[0, j] == pytest.approx(-sum(np.log(p(x)) for x in seen) / len(seen), rel=1e-5)
    p = plain_kneser_ney([unpack(x) for x in grams["a"]])
    assert sum(p(unpack(grams["a"][5])[:-1] + (c,)) for c in range(1 << language.BITS)) == pytest.approx(1)


def test_symbols_keep_texts_apart():
    grams, text = language._grams_by_text(["Ab, c", None, "", "12", "d"])
    assert Counter(text.tolist()) == {0: 7, 4: 4} and unpack(grams[0]) == (0, 0, 0, ord("a"))


def test_held_out_accuracy_and_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    more = [(-1, None, "en"), (-2, "", "en"), (-3, "12 34!?", None), (None, "the and of that", None), (-4, "q" * 300, None), (-5, "жук и щука в пруду " * 40, None), (-6, "the and of " * 30_000, None)]
    extra = spark.createDataFrame([(*r, "zz") for r in more], "doc_id long, text string, lang string, lang_pred string")
    from pyspark.sql import functions as F

    out = language.identify(docs.withColumn("lang_pred", F.lit("x")).unionByName(extra))
    rows = out.collect()
    assert len(rows) == 1007 and out.columns[:3] == ["doc_id", "text", "lang"]
    known = [r for r in rows if r["lang"] and r["doc_id"] is not None and r["doc_id"] >= 0]
    held = [r for r in known if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in known)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    odd = {r["doc_id"]: r for r in rows if r["doc_id"] is None or r["doc_id"] < 0}
    assert all(odd[k]["lang_pred"] == "und" and odd[k]["rejected"] for k in (-1, -2, -3))
    assert odd[None]["lang_pred"] == "en" and odd[-6]["lang_pred"] == "en" and odd[-5]["rejected"]
    assert sum(r["rejected"] for r in known) <= 2


def test_nothing_to_learn(spark):
    none = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [(r["lang_pred"], r["score"], r["rejected"]) for r in language.identify(none).collect()] == [("und", 0.0, True)]
    assert language.identify(none.limit(0)).collect() == []


def test_tables_answer_as_the_shared_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").where("doc_id < 150")
    odd = [(-1, None, None), (-2, "", None), (-3, "12 34!?", None), (None, "the and of that", None), (-4, "日本 unseen Ümlaut", None), (-4, "日本 unseen Ümlaut", None)]
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id long, text string, lang string"))
    tables = language.fit(docs, shared=1000)
    assert isinstance(tables, language.ModelTables)
    want = language.predict(docs, language.fit(docs))
    for shared in (0, 4000):  # without and with n-grams that go to every task
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(language, "SHARED_VALUES", shared)
            got = language.predict(docs, tables).collect()
        key = lambda r: (str(r["doc_id"]), r["text"] or "")
        pairs = [*zip(sorted(want.collect(), key=key), sorted(got, key=key), strict=True)]
        assert all(a["lang_pred"] == b["lang_pred"] and a["n_grams"] == b["n_grams"] for a, b in pairs)
        assert all(a["entropy"] == b["entropy"] and a["score"] == b["score"] for a, b in pairs)  # to the last bit


def test_a_rare_language_stays_beside_a_large_one(spark):
    rng = np.random.default_rng(1)
    large = [(k, "".join(map(chr, rng.integers(0x4E00, 0x9FFF, 100_000))), "zh") for k in range(15)]
    rare = [(100, "mi amas vian hundon", "eo")]  # a training row in which no n-gram occurs twice
    docs = spark.createDataFrame(large + rare + [(200, "amas vian hundon", None)], "doc_id long, text string, lang string").repartition(4)
    got = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert len(got) == 17 and got[200]["lang_pred"] == "eo" and not got[200]["rejected"]
    assert all(got[d]["lang_pred"] == g for d, _, g in rare)


def test_bounds_come_from_all_training_rows(spark):
    """Forty languages with a text each and one with 1,500: none of its rows is left out of its classes."""
    rng = np.random.default_rng(3)
    rows = [(i, f"l{i}", " ".join(chr(0x400 + 5 * i + j) * 3 for j in range(5))) for i in range(40)]
    rows += [(100 + i, "many", " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(10))) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    models = language.fit(docs)
    kept = [t for i, g, t in rows if g == "many" and zlib.crc32(str(i).encode()) % 5]
    entropy, n = models.entropies(kept)
    j = models.languages.index("many")
    entropy, size = entropy[entropy.argmin(1) == j, j], np.floor(np.log2(n[entropy.argmin(1) == j])).astype(int)
    bounds = language.calibrate(docs, models)
    for k in set(size.tolist()):
        own = entropy[size == k]
        bound = own.mean() + language.REJECT_BEYOND * max(own.std(), 0.05) + 2 / np.sqrt(len(own))
        assert bounds["many", k] == pytest.approx(bound, abs=1e-5)
