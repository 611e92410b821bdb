"""Line-first cleaning with built-in functions only.

Each line is judged on its own (navigation, symbols, missing end mark, boilerplate); lines that fail are removed, and a
document that loses too much of its text with them is rejected. Document counts (words, repeats) are taken beside it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Phrases whose line is boilerplate, in lower case. Fixed values.
BOILERPLATE = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "licensed under",
    "privacy policy",
    "released under the",
    "sign up for our newsletter",
    "terms of use",
    "terms of service",
)
END_MARK = r"[.!?:;…。！？]['\")\]»”’]*[\x20\x09-\x0D]*$"
#: A document goes when failing lines hold more than this share (in hundredths) of its word characters.
MOST_LOST = 40
#: A line is navigation from this many bars or arrows on, if there is one for every four words.
NAVIGATION_MARKS = 2
WINDOW = 5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times; a plain column would be computed again in every lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def _squeezed(text: Column) -> Column:
    return _without(text, " \t\n\x0b\x0c\r")


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WORD_SPACE), "")


def line_fails(line: Column) -> Column:
    """True if a line (with a word in it) breaks a rule."""
    chars = F.length(_squeezed(line))
    n_words = F.size(words_of(line))
    marks = F.length(line) - F.length(_without(line, "|»›"))
    symbols = F.length(line) - F.length(_without(line, SYMBOLS))
    navigation = (marks >= NAVIGATION_MARKS) & (4 * marks >= n_words)
    noisy = 100 * symbols > 15 * chars
    boilerplate = F.lower(line).rlike("|".join(BOILERPLATE))
    unfinished = ~line.rlike(END_MARK) & (n_words >= 3)
    return navigation | noisy | boilerplate | unfinished


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of five that the text holds twice or more."""

    def count(ws: Column) -> Column:
        at = F.sequence(F.lit(1), F.size(ws) - (WINDOW - 1))
        hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(ws, i + (k - 1)) for k in range(WINDOW)]))
        return _let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0).cast("long")).otherwise(covered(hs)))

    def covered(hs: Column) -> Column:
        pairs = F.array_sort(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def repeated(ps: Column) -> Column:
            def twice(p: Column, j: Column) -> Column:
                return (F.get(ps, j - 1)["h"] == p["h"]) | (F.get(ps, j + 1)["h"] == p["h"])

            return F.array_sort(F.transform(F.filter(ps, lambda p, j: F.coalesce(twice(p, j), F.lit(False))), lambda p: p["i"]))

        def total(starts: Column) -> Column:
            gap = F.transform(starts, lambda s, j: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, j + 1) - s, F.lit(WINDOW))).cast("long"))
            return F.aggregate(gap, F.lit(0).cast("long"), lambda a, x: a + x)

        return _let(_let(pairs, repeated), total)

    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(_let(words, count))


def with_line_rules(docs: DataFrame) -> DataFrame:
    """Adds to each row: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_lines_removed,
    chars_removed, cleaned_text, base_failed, kept.

    A null text is an empty one: no words, ``base_failed``, an empty ``cleaned_text``. Equal rows stay equal rows; input
    columns named like a result are replaced; an empty table gives an empty one. ``kept`` is false if the base rules
    fail or more than ``MOST_LOST`` hundredths of the word characters are in failing lines.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(_squeezed(x)) > 0)
    df = docs.withColumns({"_words": words_of(text), "_lines": F.transform(lines, lambda x: F.struct(x.alias("line"), line_fails(x).alias("fails"), F.length(_squeezed(x)).alias("chars")))})
    all_lines, failing = F.col("_lines"), F.filter("_lines", lambda x: x["fails"])
    n_words = F.size("_words").cast("long")
    df = df.withColumns(
        {
            "n_words": n_words,
            "word_chars": F.length(_squeezed(text)).cast("long"),
            "n_symbols": (F.length(text) - F.length(_without(text, SYMBOLS))).cast("long"),
            "n_dup_lines": (F.size(all_lines) - F.size(F.array_distinct(F.col("_lines.line")))).cast("long"),
            "n_repeat_words": repeated_words(F.col("_words")),
            "n_lines": F.size(all_lines).cast("long"),
            "n_lines_removed": F.size(failing).cast("long"),
            "chars_removed": F.aggregate(failing, F.lit(0).cast("long"), lambda a, x: a + x["chars"]),
            "cleaned_text": F.array_join(F.transform(F.filter("_lines", lambda x: ~x["fails"]), lambda x: x["line"]), "\n"),
        }
    )
    base_failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    df = df.withColumn("base_failed", base_failed).drop("_words", "_lines")
    return df.withColumn("kept", ~F.col("base_failed") & (100 * F.col("chars_removed") <= MOST_LOST * F.col("word_chars")))


def _sql() -> str:
    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    squeeze = r"regexp_replace({}, '[\x20\x09-\x0D]+', '', 'g')".format
    n = "len(regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+'))".format
    marks, symbols = "length(regexp_replace(line, '[^|»›]+', '', 'g'))", "length(regexp_replace(line, '[^#*$%&|<>]+', '', 'g'))"
    end_mark = END_MARK.replace("$", r"\z")
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM d),
p AS (SELECT rid, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w WHERE len(words) >= {WINDOW}),
g AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, words[i:i + {WINDOW - 1}]) AS n FROM p),
r AS (SELECT rid, count(DISTINCT i + k) AS n_repeat_words FROM g, range({WINDOW}) t(k) WHERE n > 1 GROUP BY rid),
l AS (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d),
j AS (SELECT rid, line, length({squeeze("line")}) AS chars,
  ({marks} >= {NAVIGATION_MARKS} AND 4 * {marks} >= {n("line")}) OR 100 * {symbols} > 15 * length({squeeze("line")})
  OR regexp_matches(lower(line), {q("|".join(BOILERPLATE))}) OR (NOT regexp_matches(line, {q(end_mark)}) AND {n("line")} >= 3) AS fails
  FROM l WHERE length({squeeze("line")}) > 0),
s AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) AS n_lines, count(*) FILTER (fails) AS n_lines_removed,
  coalesce(sum(chars) FILTER (fails), 0)::BIGINT AS chars_removed FROM j GROUP BY rid),
a AS (SELECT doc_id, len(words)::BIGINT AS n_words, length({squeeze("text")})::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
  coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0)::BIGINT AS n_lines,
  coalesce(n_lines_removed, 0)::BIGINT AS n_lines_removed, coalesce(chars_removed, 0)::BIGINT AS chars_removed
  FROM d JOIN w USING (rid) LEFT JOIN r USING (rid) LEFT JOIN s USING (rid)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM a)
SELECT *, NOT base_failed AND 100 * chars_removed <= {MOST_LOST} * word_chars AS kept FROM b
"""


#: The same on another engine, over the table ``documents``.
SQL = _sql()
