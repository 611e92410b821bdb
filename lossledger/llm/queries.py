"""The registered queries of the training-data operators, and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossledger.llm import decontamination, grace, jaccard, language, licenses, line_rules, packing, passages, pseudonyms, ranked_search, repeat_groups, repeats, token_files, whitening
from lossledger.sources.tables import read_table

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        SPARK[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("op1_token_counts")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return token_files.token_counts(read_table(spark, sf, "documents"))


@query("op2_decontamination")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.leak_rows(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


@query("op3_byte_repeats")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return repeats.without_repeats(read_table(spark, sf, "documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op3b_repeat_groups")
def op3b(spark: SparkSession, sf: str) -> DataFrame:
    return repeat_groups.repeat_groups(read_table(spark, sf, "documents"))


@query("op4_language_id")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return language.identify(read_table(spark, sf, "documents").select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score", "entropy", "n_grams", "rejected")


_SIMILAR = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT rid, array_to_string(ws[i:i + 4], ' ') AS x FROM (SELECT rid, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.rid AS a, b.rid AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.rid <> b.rid GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n u ON u.rid = a JOIN n v ON v.rid = b WHERE 5 * c >= 4 * (u.n + v.n - c)),
r AS (SELECT rid AS a, rid AS b FROM d UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
l AS (SELECT a AS rid, min(b) AS label FROM r GROUP BY 1),
k AS (SELECT a AS rid, count(*) AS n_links FROM e GROUP BY 1)
SELECT d.doc_id, m.doc_id AS class_id, coalesce(n_links, 0) AS n_links, coalesce(n, 0) AS n_shingles
FROM d JOIN l USING (rid) JOIN d m ON m.rid = label LEFT JOIN k ON k.rid = d.rid LEFT JOIN n ON n.rid = d.rid"""


@query("op5_jaccard_join", _SIMILAR)
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.similar_documents(read_table(spark, sf, "documents")).select("doc_id", "class_id", "n_links", "n_shingles")


@query("op6_line_quality", line_rules.SQL)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    ruled = line_rules.with_line_rules(read_table(spark, sf, "documents"))
    return ruled.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lines_removed", "chars_removed", "base_failed", "kept")


@query("op7_best_fit_packing")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf, "documents"))


@query("op8_license_scan")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.license_rows(read_table(spark, sf, "documents"))


@query("op9_pseudonyms")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    done = pseudonyms.with_pseudonyms(read_table(spark, sf, "documents"), pseudonyms.configured_key(spark))
    return done.select("doc_id", "text", F.size("pii").cast("long").alias("n_pii"), F.array_join(F.array_sort(F.array_distinct("pii.kind")), " ").alias("kinds"))


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_PASSAGES = f"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text) AS rid, doc_id, {_WORDS} AS ws FROM documents),
p AS (SELECT rid, ws, unnest(range(1, len(ws) - 18)) AS s FROM d WHERE len(ws) >= 20),
g AS (SELECT rid, s, row_number() OVER (PARTITION BY array_to_string(ws[s:s + 19], ' ') ORDER BY rid, s) AS n FROM p),
c AS (SELECT DISTINCT rid, s + k AS i FROM g, range(20) t(k) WHERE n > 1),
r AS (SELECT a.rid, count(*) AS n_spans FROM c a ANTI JOIN c b ON a.rid = b.rid AND b.i = a.i - 1 GROUP BY 1),
w AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM d),
k AS (SELECT w.rid, string_agg(word, ' ' ORDER BY w.i) AS kept, count(*) AS n FROM w ANTI JOIN c ON w.rid = c.rid AND w.i = c.i GROUP BY 1)
SELECT doc_id, len(ws)::BIGINT AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256, coalesce(n_spans, 0) AS n_spans
FROM d LEFT JOIN k USING (rid) LEFT JOIN r USING (rid)"""


@query("op10_passage_dedup", _PASSAGES)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return passages.without_repeats(read_table(spark, sf, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256", "n_spans")


@query("op13_exact_dedup", grace.SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return grace.exact_copies(read_table(spark, sf, "documents"))


@query("op12_whitening")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf, "embeddings"))


@query("op11_ranked_search", ranked_search.SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return ranked_search.search(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))
