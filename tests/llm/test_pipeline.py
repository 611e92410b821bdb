"""The pipeline against the same steps in plain code, on a small corpus with planted cases."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lossledger.llm import pseudonyms
from lossledger.llm.tokens import vocabulary_path
from tests.conftest import SMALL
from tests.llm.test_decontamination import plain_score
from tests.llm.test_jaccard import plain as plain_join


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").where("doc_id < 90")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(6)
    text = docs.where("doc_id = 1").first()["text"]
    item = items.first()["text"]
    more = [
        (5000, "", "en", "s", 0), (5001, "12 34 !!", "en", "s", 8), (5002, "жук и щука в пруду у дуба " * 30, None, "s", 780), (5003, text + " tail", "en", "s", 1), (5004, text, "en", "s", 1),
        (5005, f"{text[::-1]} {item} {text[::-1]}", "en", "s", 1), (5006, "Write to hein.19@mail5.example.com or call +1 (663) 555-6869, card 4111111111111111. " + text[:200][::-1], "en", "s", 1),
    ]
    docs.unionByName(spark.createDataFrame(more, docs.schema)).write.parquet(f"{path}/documents.parquet")
    items.write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages_return_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema.names == docs.schema.names, name
        assert stage(spark, docs.limit(0), folder).count() == 0, name


def test_against_plain_code(spark, folder):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    kept = {d: t for d, t in docs.items() if d not in (5000, 5001, 5002)}  # no letter, or another script
    kept = {d: kept[d] for d, first, _, _ in plain_join(sorted(kept.items())) if d == first}
    items = [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    kept = {d: t for d, t in kept.items() if all(plain_score(i, t) < 0.5 for i in items)}
    assert 5005 not in kept and 5004 not in kept and 5006 in kept
    full = Tokenizer.from_file(vocabulary_path())
    want = set()
    for d, t in kept.items():
        ids = full.encode(pseudonyms.replace(t)[0], add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            want.add((d, k, zlib.crc32(np.array(ids[at : at + 4096], "<u4").tobytes())))
    spark.conf.set(pseudonyms.KEY_SETTING, pseudonyms.TRIAL_KEY.hex())
    rows = corpus_pipeline.run(spark, folder).collect()
    spark.conf.unset(pseudonyms.KEY_SETTING)
    assert {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in rows} == want and len(rows) == len(want)
    places = sorted((r["sequence_id"], r["offset"], r["length"]) for r in rows)
    for (s, o, n), (s2, o2, _) in zip(places, places[1:]):
        assert (o2 == o + n) if s == s2 else o2 == 0


def test_work_tables_go(spark, folder):
    """Of all tables that the stages write, those that the result reads are left."""
    import os

    from lossledger.sources.tables import work_folder

    before = set(os.listdir(work_folder(spark)))
    rows = corpus_pipeline.run(spark, folder)
    left = {n.rsplit("-", 1)[0] for n in set(os.listdir(work_folder(spark))) - before}
    assert left <= {"pieces", "length-counts", "pseudonyms"} and rows.count()


def test_rows_without_an_id_and_more_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(20)
    more = docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "concat(text, ' and no id') AS text", "lang", "source", "n_chars").limit(2).unionByName(docs).selectExpr("*", "1 AS pii", "2 AS rejected", "'z' AS leaks")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, more, folder).schema.names == more.schema.names, name
