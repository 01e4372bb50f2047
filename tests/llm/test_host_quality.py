import re
from collections import Counter

import duckdb
import pytest
from llm.helpers import FOLDER, by_id, docs
from pyspark.sql import functions as F

from tallyhouse.llm import host_quality as H
from tallyhouse.llm.oracle import all_sql
from tallyhouse.llm.queries import all_queries


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    repeat = {j for i, w in enumerate(windows) if w in often for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeat))


TEXTS = [None, "", " \t\x0b\n", "a b c a b c", "x\ny\nx\n \nx ", "a a a a a", "é ü # * $%&|<> é ü # *", "w " * 30000, "a b\x0cc d a b c"]


def test_features(spark):
    rows = H.features(docs(spark, *TEXTS)).collect()
    assert {r.doc_id: tuple(r[f] for f in H.FEATURES) for r in rows} == {i: plain(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("folder", [FOLDER, "/root/testdata/sf0.01"])
def test_query_against_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    df = all_queries()["op2_host_quality"](spark, folder)
    theirs = con.sql(all_sql()["op2_host_quality"])
    assert sorted(df.columns) == sorted(theirs.columns)
    assert sorted(map(tuple, df.collect())) == sorted(theirs.select(*df.columns).fetchall())


def test_a_bad_host_takes_its_documents_along_and_a_small_one_does_not(spark):
    good = " ".join(f"word{i}" for i in range(60))
    df = docs(spark, *["short"] * 40, good, source="bad").unionByName(docs(spark, *[good] * 200, source="good"))
    df = df.unionByName(docs(spark, "short", good, ids=[900, 901], source="tiny"))
    df = df.unionByName(docs(spark, good, ids=[902], source=None))
    out = H.judged(df).filter(F.col("text") == good).groupBy("source").agg(F.min("kept").alias("a"), F.max("kept").alias("b"))
    verdict = {r.source: (r.a, r.b) for r in out.collect()}
    assert verdict == {"bad": (False, False), "good": (True, True), "tiny": (True, True), None: (True, True)}


def test_names_empty_table_and_null_hosts(spark):
    df = docs(spark, "a b", None, ids=[None, 1], source=None).withColumn("words", F.lit("mine")).withColumn("kept", F.lit(5))
    rows = H.judged(df.unionByName(df)).collect()
    assert len(rows) == 4 and all(r.words == "mine" and r.kept is False for r in rows)
    assert H.judged(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = all_queries()["op2_host_quality"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and len(by_id(all_queries()["op2_host_quality"](spark, FOLDER))) > 0
