import random
import re
from itertools import combinations

import pytest
import xxhash
from llm.helpers import FOLDER, by_id, docs, given_documents
from pyspark.sql import functions as F

from tallyhouse.llm import simhash
from tallyhouse.llm.queries import all_queries


def plain_fingerprint(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints):
    """Least member reachable by links of three bits or fewer."""
    root = {p: p for p in prints}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in combinations(sorted(root), 2):
        if (a ^ b).bit_count() <= 3:
            x, y = sorted((top(a), top(b)))
            root[y] = x
    return {p: top(p) for p in root}


def signed(p):
    return p - (1 << 64) if p >> 63 else p


def groups(pairs):
    out = {}
    for node, root in pairs:
        out.setdefault(root, set()).add(node)
    return sorted(sorted(g) for g in out.values())


def near(rng, p, bits):
    for b in rng.sample(range(64), bits):
        p ^= 1 << b
    return p


@pytest.mark.parametrize("size, group", [(300, 2048), (600, 4)])
def test_classes_against_all_pairs(spark, monkeypatch, size, group):
    rng = random.Random(size)
    prints = [rng.getrandbits(64) for _ in range(size // 6)]
    while len(prints) < size:
        prints.append(near(rng, rng.choice(prints), rng.randint(0, 5)))
    monkeypatch.setattr(simhash, "GROUP", group)
    df = spark.createDataFrame([(signed(p), i) for i, p in enumerate(prints)], "fp long, id long")
    got = {r.fp: r.component_id for r in simhash.classes(df).collect()}
    want = plain_roots(set(prints))
    assert groups((p, got[signed(p)]) for p in set(prints)) == groups(want.items())
    least = {}
    for i, p in enumerate(prints):
        least[want[p]] = min(i, least.get(want[p], i))
    assert all(got[signed(p)] == least[want[p]] for p in prints)


def test_a_very_common_segment_is_cut_further(spark, monkeypatch):
    """All fingerprints share a half, so that single variants hold them all."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = {base ^ (rng.getrandbits(12) << rng.choice([0, 9, 20])) for _ in range(900)}
    monkeypatch.setattr(simhash, "GROUP", 40)
    df = spark.createDataFrame([(signed(p), i) for i, p in enumerate(sorted(prints))], "fp long, id long")
    got = {r.fp: r.component_id for r in simhash.classes(df).collect()}
    assert groups((p, got[signed(p)]) for p in prints) == groups(plain_roots(prints).items())


def test_query(spark):
    rows = by_id(all_queries()["op9_simhash"](spark, FOLDER))
    prints = {i: plain_fingerprint(t) for i, t in given_documents()}
    roots = plain_roots(set(prints.values()))
    least = {}
    for i in sorted(prints, reverse=True):
        least[roots[prints[i]]] = i
    assert rows.keys() == prints.keys()
    for i, p in prints.items():
        assert rows[i]["fingerprint"] == f"{p:016x}" and rows[i]["component_id"] == least[roots[p]]


def test_nulls_ties_repeated_rows_and_names(spark):
    long = "one two three four " * 20000
    df = docs(spark, None, "", " \t\n", "A b", "a  B", long, long, "x", ids=[9, 3, 4, 6, 5, None, None, 8])
    df = df.unionByName(df.filter("doc_id = 8")).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("mine"))
    rows = simhash.near_duplicates(df).collect()
    assert len(rows) == 9 and rows[0].fp == 1
    ids = {(r.doc_id, r.text): (r.fingerprint, r.component_id) for r in rows}
    assert {ids[9, None], ids[3, ""], ids[4, " \t\n"]} == {("0" * 16, 3)}
    assert ids[6, "A b"] == ids[5, "a  B"] and ids[6, "A b"][1] == 5
    assert ids[None, long][1] is None and ids[8, "x"][1] == 8
    assert simhash.near_duplicates(df.limit(0)).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.range(200).selectExpr("id * 7 % 1000 AS a", "(id + 1) * 7 % 1000 AS b")
    got = simhash.components(edges).collect()
    assert len(got) == len({r.node for r in got}) and {r.root for r in got} == {min(r.node for r in got)}


def test_columns_may_have_the_operators_own_names(spark):
    names = ["fp", "fp_id", "own_id", "id", "root", "node", "keep_fp", "keep_id", "k", "fingerprint", "unknown"]
    df = docs(spark, "a b c d", "A b c d", None, ids=[2, 1, None]).withColumns({n: F.lit("x") for n in names})
    rows = simhash.near_duplicates(df).collect()
    assert {(r.doc_id, r.component_id, r.fp_id, r.own_id) for r in rows} == {(2, 1, "x", "x"), (1, 1, "x", "x"), (None, None, "x", "x")}
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {1, None}
    assert simhash.one_of_each(df.limit(0)).count() == 0
