"""Line rules against the SQL, and each rule on a small text."""

import duckdb
import pyarrow as pa
import pytest

from lossledger.llm import line_rules
from lossledger.llm.queries import SPARK
from tests.conftest import SMALL

CLEAN = "One two three four five six seven eight nine ten eleven twelve words here."
TEXTS = [
    None, "", " \n\t ", "short text.", CLEAN, f"{CLEAN}\nHome | About | Contact | Help", f"{CLEAN}\nAll rights reserved.", f"{CLEAN}\n{CLEAN}\n\n{CLEAN} ",
    "a b c d e " * 30, "Äé ß 日本 " * 7 + ".", "x### y*** z$$$ " * 12, "no end mark in this line at all\n" * 3, f"{CLEAN}\r\n{CLEAN}\x0b\x0cmore \x85 words\xa0here now",
    'He said "this is the end of a line with many words."', "a|b", "w " * 5000,
]


def test_against_sql_on_odd_texts(spark):
    rows = [(i, t, 7, True) for i, t in enumerate(TEXTS)] + [(None, CLEAN, 1, False), (4, CLEAN, 1, None), (4, CLEAN, 1, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean")
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]}))
    want = con.execute(line_rules.SQL)
    names = [d[0] for d in want.description]
    got = line_rules.with_line_rules(df).select(*names).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want.fetchall(), key=repr)


@pytest.mark.parametrize(
    ("line", "fails"),
    [
        ("A plain sentence with an end.", False), ('She asked "why?"', False), ("A heading", False), ("Home | About | Contact", True), ("Copyright 2020. All rights reserved.", True),
        ("a line that just stops", True), ("We gained 5% & lost $3 on the whole of that quarter.", False), ("x### y%%% z$$$.", True),
    ],
)
def test_rules(spark, line, fails):
    from pyspark.sql import functions as F

    assert spark.range(1).select(line_rules.line_fails(F.lit(line))).first()[0] is fails


def test_failing_lines_leave_the_cleaned_text(spark):
    df = spark.createDataFrame([(1, f"{CLEAN}\nHome | About | Contact\n{CLEAN}")], "doc_id long, text string")
    row = line_rules.with_line_rules(df).first()
    assert row["cleaned_text"] == f"{CLEAN}\n{CLEAN}" and row["n_lines_removed"] == 1


def test_native_and_empty(spark):
    plan = SPARK["op6_line_quality"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert line_rules.with_line_rules(spark.createDataFrame([], "doc_id long, text string")).count() == 0
