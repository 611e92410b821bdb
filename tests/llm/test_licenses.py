"""License scans against a plain search for every template in every text."""

import re

import numpy as np

from lossledger.llm import licenses as ls

SF = "/root/testdata/sf0.01"


def shingles(text, size):
    words = re.findall(r"[^\W_]+", text.lower())
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def plain(text, templates=None):
    """Every stretch within reach, each counted anew; the fullest first, of equal ones the shorter, then the earlier."""
    out = []
    for name, template in templates or ls.TEMPLATES:
        size = min(ls.SHINGLE, len(re.findall(r"[^\W_]+", template)))
        own, wanted = shingles(text, size), shingles(template, size)
        block = 1 << max(0, (len(wanted) // 2).bit_length() - 1) if len(wanted) > 3 else 1
        reach = block * (-(-len(wanted) // block) + 1) + 1 if block > 1 else len(wanted)
        at = [i for i, s in enumerate(own) if s in set(wanted)]
        spans = []
        for n, i in enumerate(at):
            seen = set()
            for j in at[n:]:
                if j - i < reach:
                    seen.add(own[j])
                    if len(seen) >= ls.CONTAINED * len(set(wanted)):
                        spans.append((-len(seen), j - i, i, j + size))
        taken = []
        for few, _, a, b in sorted(spans):
            if all(b <= c or d <= a for c, d in taken):
                taken.append((a, b))
                out.append((name, a, b, -few / len(set(wanted))))
    return sorted(out, key=lambda x: (x[1], x[2], x[0]))


def test_against_a_plain_search(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    longest = max(ls.TEMPLATES, key=lambda t: len(t[1]))[1]
    rows += [(5000 + k, f"{rows[k][1][:900]}\n{t.upper()}\n{rows[k + 1][1][:700]}") for k, (_, t) in enumerate(ls.TEMPLATES)]
    rows += [(6000, longest.replace("Software", "Package", 1)), (6001, None), (6002, ""), (None, "All rights reserved. " * 9), (6003, "All rights reserved."), (6003, "All rights reserved."), (6004, longest[: len(longest) // 2])]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, licenses int").repartition(4)
    got = ls.with_licenses(df)
    assert got.columns == ["doc_id", "text", "licenses"]
    for r in got.collect():
        assert [tuple(x) for x in r["licenses"]] == plain(r["text"] or "")
    assert ls.license_rows(df.limit(0)).count() == 0


def test_bands_meet_their_probability():
    for t in ls.Index.of(list(ls.TEMPLATES)).templates:
        assert 0 < t.least <= 1 and 1 - (1 - t.least) ** ls.bands_for(t.least) >= ls.COLLIDE
        assert t.block * (t.blocks - (t.block > 1)) >= t.length


def test_a_template_spread_thin_is_no_match(spark):
    """Every shingle of a notice, each some foreign words from the next, holds none of it; a few insertions don't hide it."""
    words = max(ls.TEMPLATES, key=lambda t: t[0] == "GPL-2.0")[1].split()
    rows = [(gap, " ".join(" ".join(words[i : i + 5] + [f"foreign{i}x{k}" for k in range(gap)]) for i in range(len(words) - 4))) for gap in (10, 25, 40, 55)]
    rows += [(100, " ".join([*words[:20], "one", "two", *words[20:]])), (101, " ".join([*words[:9], *words[12:]]))]
    found = {r["doc_id"]: r["licenses"] for r in ls.with_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(not found[gap] for gap in (10, 25, 40, 55))
    assert all("GPL-2.0" in {x["license"] for x in found[k]} for k in (100, 101))


def test_templates_in_blocks(spark):
    table = spark.createDataFrame(list(ls.TEMPLATES), "license string, text string").repartition(3)
    docs = spark.createDataFrame([(k, f"so {t} and {u}") for k, ((_, t), (_, u)) in enumerate(zip(ls.TEMPLATES, ls.TEMPLATES[1:]))], "doc_id long, text string")
    want = {r["doc_id"]: r["licenses"] for r in ls.with_licenses(docs).collect()}
    assert {r["doc_id"]: r["licenses"] for r in ls.with_licenses(docs, table, most=1500).collect()} == want and all(want.values())


def test_own_templates(spark):
    own = spark.createDataFrame([("mine", "my very own license text here"), ("none", None)], "license string, text string")
    docs = spark.createDataFrame([(1, "x my very own license text here y")], "doc_id long, text string")
    assert [tuple(x) for x in ls.with_licenses(docs, own).first()["licenses"]] == [("mine", 1, 7, 1.0)]
    assert np.all([ls.with_licenses(docs, own.limit(0)).first()["licenses"] == []])
