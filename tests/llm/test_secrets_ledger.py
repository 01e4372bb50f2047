import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import FOLDER, by_id, docs, given_documents
from pyspark.sql import functions as F

from tallyhouse.llm import secrets_ledger as S
from tallyhouse.llm.queries import all_queries

ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def plain_base(text):
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in re.finditer(ASSIGN, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [x[2] for x in sorted(out)]


def base_of(text):
    return [f"{s['kind']}:{s['start']}:{s['end']}" for s in S.find(text) if s["kind"] in S.BASE]


PARTS = ["password", "Token", "api_key", "APIKEY", "toKen", '"', "'", " ", "=", ":", "AKIA", "Z9" * 7, "0af" * 12, "x1/_.=+-", "é"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_base_spans(text):
    assert base_of(text) == plain_base(text)


def test_query(spark):
    rows = by_id(all_queries()["op7_secret_ledger"](spark, FOLDER))
    given_rows = given_documents()
    assert len(rows) == len(given_rows)
    for i, text in given_rows:
        want = plain_base(text or "")
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert rows[i]["n_assign"] == sum(x.startswith("assign") for x in want)


def test_only_unseen_blobs_are_scanned(spark, folder):
    ledger = f"{folder}/ledger"
    S.start_ledger(spark, ledger)
    first = docs(spark, "token = abcdefgh1", "plain", "plain", None, ids=[1, 2, 3, 4])
    assert S.scan(first, ledger).count() == 4
    assert spark.read.parquet(ledger).count() == 3
    # a second history: one blob is new, one path moved; what the ledger says of a seen blob is taken as it stands
    marked = spark.read.parquet(ledger).withColumn("spans", F.expr("transform(spans, s -> named_struct('kind', 'old', 'start', s.start, 'end', s.end))"))
    other = f"{folder}/marked"
    marked.write.parquet(other)
    second = S.scan(docs(spark, "token = abcdefgh1", "passwd: 123456789", "", ids=[7, 8, 9]), other)
    found = {r.doc_id: [s.kind for s in r.secret_spans] for r in second.collect()}
    assert found == {7: ["old"], 8: ["assign"], 9: []}
    assert spark.read.parquet(other).count() == 4
    # another version of the rules scans every blob anew
    third = S.scan(docs(spark, "token = abcdefgh1"), other, rule_version="2")
    assert [s.kind for s in third.first().secret_spans] == ["assign"] and spark.read.parquet(other).count() == 5


def test_nulls_long_texts_empty_tables_and_names(spark, folder):
    ledger = f"{folder}/ledger"
    S.start_ledger(spark, ledger)
    df = docs(spark, None, "", "y " * 200000 + "AKIA" + "B" * 16, ids=[None, 1, 1]).withColumn("blob", F.lit(3)).withColumn("key", F.lit(4))
    rows = S.scan(df, ledger).collect()
    assert sorted(len(r.secret_spans) for r in rows) == [0, 0, 1] and rows[0].key == 4
    assert S.scan(df.limit(0), ledger).count() == 0
    kinds = {s["kind"] for s in S.find("-----BEGIN RSA PRIVATE KEY----- ghp_" + "Z" * 36 + " xoxb-1234567890-ab")}
    assert kinds == {"private_key", "github", "slack"}
