import re

from llm.helpers import FOLDER, docs, given_documents
import pytest
from pyspark.sql import functions as F

import duckdb
from tallyhouse.llm import decontaminate as D
from tallyhouse.llm.queries import all_queries

ITEM = "Every morning the baker Tom sells 12 loaves for 3 dollars each, how much money does Tom earn in 7 days?"


def bench(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def plain_template(text):
    text = re.sub(r"(?<=[0-9])[.,](?=[0-9])", "", text or "")
    out, start = [], True
    for m in re.finditer(r"[^\W_]+|[.!?:\n]", text):
        w = m[0]
        if w in ".!?:\n":
            start = True
            continue
        low = w.lower()
        kind = "<number>" if w[0] in "0123456789" else "<unit>" if low in D.UNITS and not (start and w[0] != low[0]) else (
            "<name>" if w[0] != low[0] and not start else None)
        out.append((kind or low, low if kind else None))
        start = False
    return out


def plain_matches(documents, items, width=8):
    found = set()
    index = {}
    totals = {}
    for i, text in items:
        t = plain_template(text)
        for at in range(len(t) - width + 1):
            window = t[at : at + width]
            if sum(s is not None for _, s in window) <= width - D.PLAIN_LEAST:
                index.setdefault(tuple(k for k, _ in window), []).append((i, at, [s for _, s in window]))
                totals[i] = totals.get(i, 0) + 1
    for d, text in documents:
        t = plain_template(text)
        lines = {}
        for at in range(len(t) - width + 1):
            for i, j, slots in index.get(tuple(k for k, _ in t[at : at + width]), ()):
                lines.setdefault((i, at - j), []).append((j, list(zip(slots, [s for _, s in t[at : at + width]]))))
        places = {}
        for (i, _), hits in lines.items():
            seen = {}
            for _, pairs in hits:
                for a, b in pairs:
                    seen.setdefault(a, set()).add(b)
            if all(len(v) == 1 for a, v in seen.items() if a):
                places.setdefault(i, set()).update(j for j, _ in hits)
        found |= {(d, i, len(p)) for i, p in places.items() if len(p) / totals[i] >= D.COVERAGE}
    return found


def test_query(spark):
    items = duckdb.sql(f"SELECT item_id, text FROM '{FOLDER}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id, r.n_windows) for r in all_queries()["op6_decontaminate"](spark, FOLDER).collect()}
    assert got == plain_matches(given_documents(), items)
    whole = {(d, i) for i, t in items for d, x in given_documents() if x and t in x}
    assert whole == {(d, i) for d, i, _ in got}


def kinds(spark, *texts):
    return {r.doc_id: r.kind for r in D.matches(docs(spark, *texts), bench(spark, ITEM)).collect()}


def test_other_parameters_need_consistent_slots(spark):
    other = ITEM.replace("Tom", "Anna").replace("12", "1,250").replace("dollars", "euros")
    torn = ITEM.replace("Tom", "Anna", 1)
    got = kinds(spark, f"He asked. {ITEM}", f"Try this: {other}", torn, "nothing of the kind is said in this text of words")
    assert got == {0: "exact", 1: "re-parameterised"}
    assert {(d, i) for d, i, _ in plain_matches(list(enumerate([ITEM, other, torn])), [(0, ITEM)])} == {(0, 0), (1, 0)}


def test_one_of_two_passages_is_enough(spark):
    assert kinds(spark, f"{ITEM.replace('Tom', 'Anna', 1)} And again. {ITEM.replace('Tom', 'Ben')}") == {0: "re-parameterised"}


def test_items_of_one_template_stand_for_one_another(spark):
    items = bench(spark, ITEM, ITEM.replace("Tom", "Eve"), ITEM, None, "", "too short")
    rows = D.matches(docs(spark, ITEM.replace("Tom", "Eve")), items).collect()
    assert [(r.item_id, r.kind) for r in rows] == [(0, "re-parameterised")]


def test_nulls_repeated_rows_long_texts_names_and_empty_tables(spark):
    long = "filler words go on and on " * 20000 + ITEM
    df = docs(spark, None, "", long, long, "a b", ids=[1, 2, None, None, 3]).withColumn("words", F.lit(1)).withColumn("window", F.lit(2))
    items = bench(spark, ITEM).withColumn("doc_id", F.lit(9))
    rows = D.matches(df, items).collect()
    assert [(r.doc_id, r.kind) for r in rows] == [(None, "exact")]
    kept = D.clean(df, items)
    assert kept.count() == 3 and kept.columns == df.columns
    assert D.matches(df.limit(0), items).count() == 0 and D.matches(df, items.limit(0)).count() == 0
    assert D.clean(df, items.limit(0)).count() == 5
    plan = D.matches(df, items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_an_item_is_found_by_its_own_values(spark):
    apples = "At dawn the children carry {} apples and {} pears into the cold kitchen"
    items = bench(spark, apples.format(3, 3), apples.format(3, 5), apples.format(3, 5))
    df = docs(spark, apples.format(3, 5), apples.format(4, 4), "nothing here")
    got = {(r.doc_id, r.item_id, r.kind) for r in D.found(df, items).collect()}
    assert got == {(0, 1, "exact"), (0, 2, "exact")} | {(1, i, "re-parameterised") for i in range(3)}
    assert [r.doc_id for r in D.clean(df, items).collect()] == [2]


def test_equal_windows_count_beside_altered_ones(spark):
    torn = ITEM.replace("Tom", "Anna", 1)
    twice = ITEM.replace("Tom", "Anna", 1).replace("Tom", "Ben").replace("12", "13").replace("3 dollars", "4 euros")
    df = docs(spark, torn, twice, ITEM)
    got = {(r.doc_id, r.kind) for r in D.found(df, bench(spark, ITEM)).collect()}
    assert got == {(0, "exact"), (2, "exact")}
    assert [r.doc_id for r in D.clean(df, bench(spark, ITEM)).collect()] == [1]


def test_excerpts_of_long_items_and_items_without_a_window(spark):
    long = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(500))
    excerpt = "so he said this " + " ".join(long.split()[200:250]) + " and went home"
    few = "so he said this " + " ".join(long.split()[200:212]) + " and went home"
    items = bench(spark, long, "Capital of France?", "17 23 42 99 17 23 42 99", "你好世界", "?!", "", None)
    df = docs(spark, excerpt, few, "capital of  FRANCE", "17, 23, 42, 99, 17, 23, 42, 99", "你好世界。", " ?!", "", None, "capital")
    got = {(r.doc_id, r.item_id, r.kind) for r in D.found(df, items).collect()}
    assert got == {(0, 0, "exact"), (2, 1, "exact"), (3, 2, "exact"), (4, 3, "exact"), (5, 4, "exact")}
    assert {r.doc_id for r in D.clean(df, items).collect()} == {1, 6, 7, 8}


NAMES = ["found_hash", "text_hash", "keys", "words", "at", "window", "template", "variant", "slots", "places", "shift", "same", "item_id"]


@pytest.mark.parametrize("rows", [400_000, 0])
def test_own_names_as_columns_and_tables_beyond_the_broadcast(spark, monkeypatch, rows):
    monkeypatch.setattr(D, "BROADCAST_ROWS", rows)
    df = docs(spark, ITEM, "nothing of it", None).withColumns({n: F.lit("x") for n in NAMES})
    kept = D.clean(df, bench(spark, ITEM, "Capital of France?"))
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {1, 2}
    assert {(r.doc_id, r.item_id) for r in D.found(df, bench(spark, ITEM)).collect()} == {(0, 0)}
