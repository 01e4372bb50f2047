import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import FOLDER, by_id, docs, given_documents
from pyspark.sql import functions as F

from tallyhouse.llm import pii
from tallyhouse.llm.queries import all_queries


def luhn(d):
    return sum(sum(divmod(int(c) * (2 if i % 2 else 1), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_base(text):
    out = []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15),
    )
    for k, (kind, pattern, ok) in enumerate(kinds):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if ok(m)]
    return [x[2] for x in sorted(out)]


def base_of(text):
    return [f"{s['kind']}:{s['start']}:{s['end']}" for s in pii.find(text) if s["base"]]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aB1234567890+-.() @_é\n", max_size=60))
def test_base_spans(text):
    assert base_of(text) == plain_base(text)


def test_query(spark):
    rows = by_id(all_queries()["op5_pii"](spark, FOLDER))
    for i, text in given_documents():
        want = plain_base(text or "")
        assert rows[i]["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert rows[i]["n_card"] == sum(x.startswith("card") for x in want)
        assert set(want) <= set(rows[i]["spans"].split(",")) | {""}


def kinds(text):
    return {s["kind"] for s in pii.find(text)}


def test_checksums_and_context():
    assert "iban" in kinds("pay to GB82 WEST 1234 5698 7654 32 today") and "iban" not in kinds("pay to GB83 WEST 1234 5698 7654 32")
    assert "ssn" in kinds("social security number 123-45-6789") and "ssn" not in kinds("part 123-45-6789")
    assert pii.find("card 4111 1111 1111 1111")[0]["score"] > pii.find("order 4111 1111 1111 1111")[0]["score"]
    assert "card" not in kinds("4111 1111 1111 1112") and "ip" not in kinds("999.1.1.1") and "phone" in kinds("+1 (974) 555-3436")


def test_redacted_keeps_columns_and_nulls(spark):
    df = docs(spark, "mail a.b@c.de, card 4111111111111111.", None, "", "plain", "x" * 300000 + " z@y.org", ids=[1, None, 3, 3, 4])
    df = df.withColumn("spans", F.lit("mine"))
    out = {(r.doc_id, r.spans): r.text for r in pii.redacted(df).filter("text <> 'plain' OR text IS NULL").collect()}
    assert out[1, "mine"] == "mail <EMAIL>, card <CARD>." and out[None, "mine"] is None
    assert out[3, "mine"] == "" and out[4, "mine"].endswith(" <EMAIL>")
    assert pii.with_spans(df.limit(0)).count() == 0 and pii.redacted(df).columns == df.columns
    assert [len(r.pii_spans) for r in pii.with_spans(docs(spark, None, "")).collect()] == [0, 0]


def test_account_numbers_before_words_in_capitals_and_figures():
    first, second = "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    for text, want in (
        (f"IBAN: {first} BIC COBADEFFXXX", [first]), ("to DE89370400440532013000 EUR 20", ["DE89370400440532013000"]),
        (f"{first} {second} OK", [first, second]), (f"AB12 3456 7890 1234 {first}", [first]), (f"{first[:-1]}1 EUR 20", []),
        (f"{second} today", [second]), ("NO93 8601 1117 947 KR 15", ["NO93 8601 1117 947"]),
    ):
        assert [text[s["start"] : s["end"]] for s in pii.find(text) if s["kind"] == "iban"] == want
        assert pii.blotted(text, [s for s in pii.find(text) if s["kind"] == "iban"]).count("<IBAN>") == len(want)
