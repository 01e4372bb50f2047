import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import FOLDER, docs
from pyspark.sql import functions as F

from tallyhouse.llm import toxicity as X
from tallyhouse.llm.common import read
from tallyhouse.llm.queries import all_queries

LEX = {"idiot": (X.INSULT, 4.0), "wretch*": (X.INSULT, 3.0), "maul": (X.THREAT, 2.0)}
WORDS = ["idiot", "wretchedly", "maul", "kill", "you", "not", "said", "a", "b"]


def named(s):
    marks = [name for bit, name in ((X.NEGATED, "negated"), (X.REPORTED, "reported"), (X.AIMED, "aimed")) if (s - X.HIT) & bit]
    return " ".join(["threat" if (s - X.HIT) & X.THREAT_BIT else "insult", *marks])


def patterns(clause):
    return [named(s) for s, _ in X.clause_patterns([X.symbol(w, LEX) for w in X.WORD.findall(clause)])]


def test_clause_patterns():
    assert patterns("what an idiot") == ["insult"]
    assert patterns("you idiot") == patterns("idiot, you") == ["insult aimed"]
    assert patterns("this is not an idiot") == ["insult negated"]
    assert patterns("it said such an idiot") == ["insult reported"]
    assert patterns("never said to kill you") == ["threat negated reported aimed"]
    assert patterns("wretchedly they will maul") == ["insult aimed", "threat aimed"]
    assert patterns("not one two three four five idiot") == ["insult"]
    assert patterns("you one two three idiot one two three four you") == ["insult aimed"]
    assert patterns("a plain clause") == []


def plain_patterns(words):
    """Marks by looking at the words around each insult or threat."""
    read, out = [X.symbol(w, LEX) for w in words], []
    for i, (s, w) in enumerate(read):
        if s < X.HIT:
            continue
        before = [k for k, _ in read[max(0, i - X.REACH) : i]]
        after = [k for k, _ in read[i + 1 : i + 1 + X.REACH]]
        negated, reported = X.NEGATION in before, X.REPORT in [k for k, _ in read[:i]]
        aimed = X.TARGET in before or X.TARGET in after
        out.append((s + X.NEGATED * negated + X.REPORTED * reported + X.AIMED * aimed, w - negated - 0.5 * reported + 0.5 * aimed))
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=14))
def test_transducers_against_a_plain_interpreter(words):
    assert X.clause_patterns([X.symbol(w, LEX) for w in words]) == plain_patterns(words)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), max_size=8), max_size=4))
def test_features_against_a_plain_interpreter(clauses):
    text = ". ".join(" ".join(c) for c in clauses)
    split = [X.WORD.findall(c) for c in X.CLAUSE_END.split(text)]
    found = [plain_patterns(c) for c in split]
    got = X.clause_features(text, {}, LEX)
    if not any(found):
        assert got is None
        return
    want = np.zeros(X.FEATURES)
    for s in range(16):
        own = [w for f in found for k, w in f if k == X.HIT + s]
        want[s], want[16 + s] = np.log1p(len(own)), max([0.0, *own])
    want[-2:] = np.log1p(sum(map(bool, found))), sum(map(bool, found)) / len(split)
    assert np.allclose(got, want)


def test_composition_is_running_one_after_the_other():
    a, b = X.scope(X.NEGATION, X.NEGATED, -1.0, 2), X.scope(X.TARGET, X.AIMED, 0.5, None)
    symbols = [X.NEGATION, X.INSULT, X.TARGET, X.OTHER, X.THREAT, X.NEGATION, X.OTHER, X.OTHER, X.INSULT]
    assert X.run(X.compose(a, b), symbols, [0.0] * 9) == X.run(b, *X.run(a, symbols, [0.0] * 9))


def test_scores_are_those_of_the_plain_features(spark):
    df = docs(spark, *["plain words here"] * 30, *["you idiot you", "a b idiot"] * 15)
    labels = df.select("doc_id", F.col("text").contains("idiot").cast("int").alias("toxic"))
    known = df.filter(~X.held_out()).join(labels, "doc_id")
    model = X.fit(known)
    for r in X.scored(df, labels).collect():
        features = X.clause_features(r.text, {}, model.lexicon)
        z = model.weights[-1] + (0 if features is None else float(features @ np.array(model.weights[:-1])))
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-12


def test_learned_entries_that_targets_follow_are_threats(spark):
    df = docs(spark, *["they gore you here"] * 20, *["that goof was here"] * 20, *["it was here and there"] * 40)
    labels = df.select("doc_id", (F.col("doc_id") < 40).cast("int").alias("toxic"))
    lexicon = X.fit(df.join(labels, "doc_id")).lexicon
    assert lexicon["gore"][0] == X.THREAT and lexicon["goof"][0] == X.INSULT


def test_weights_are_those_of_the_least_loss_where_classes_are_nearly_parted():
    # Whole Newton steps run away here: six rows between the classes have either label.
    x = np.array([[0.0, 0.0]] * 500 + [[3.0, 8.0]] * 200 + [[0.3, 0.8]] * 6)
    y = np.array([0.0] * 500 + [1.0] * 200 + [1.0, 1.0, 1.0, 0.0, 0.0, 0.0])
    w = X.logistic(x, y)
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    slope = np.append(x, np.ones((len(x), 1)), axis=1).T @ (p - y) + np.array([0.05, 0.05, 1e-4]) * w
    assert np.abs(slope).max() < 1e-6 and (p[:500] < 0.1).all() and (p[500:700] > 0.9).all()


def test_clauses_end_at_full_stops():
    aimed = X.clause_features("you. idiot", {}, LEX)
    plain = X.clause_features("idiot. you", {}, LEX)
    assert (aimed == plain).all() and X.clause_features("nothing", {}, LEX) is None


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.1"])
def test_held_out_accuracy(spark, folder):
    labels = read(spark, folder, "labels").select("doc_id", "toxic")
    rows = all_queries()["op10_toxicity"](spark, folder).join(labels, "doc_id").filter("held_out").collect()
    true = sum(r.predicted and r.toxic for r in rows)
    assert len(rows) > 1000 and true / sum(r.predicted for r in rows) > 0.95 and true / sum(r.toxic for r in rows) > 0.8
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_and_other_columns_are_not_used(spark):
    df = docs(spark, *["plain words here"] * 30, *["you idiot you"] * 30)
    labels = df.select("doc_id", F.col("text").contains("idiot").cast("int").alias("toxic"))
    flipped = labels.withColumn("toxic", F.when(X.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r.doc_id: (r.score, r.held_out) for r in X.scored(df, labels).collect()}
    b = {r.doc_id: (r.score, r.held_out) for r in X.scored(df.withColumn("lang", F.lit("xx")), flipped).collect()}
    assert a == b and {h for _, h in a.values()} == {True, False}
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, (_, h) in a.items())
    assert min(s for i, (s, _) in a.items() if i >= 30) > 0.7 > max(s for i, (s, _) in a.items() if i < 30)


def test_nulls_long_texts_names_and_empty_tables(spark):
    df = docs(spark, None, "", "idiot " * 100000, "x", "x", ids=[None, 1, 2, 3, 3]).withColumn("score", F.lit("mine"))
    labels = spark.createDataFrame([(1, 0, 1), (None, 1, 1), (3, None, 1), (3, 1, 1)], "doc_id long, toxic int, text int")
    rows = X.scored(df, labels).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert X.scored(df.limit(0), labels).count() == 0 and X.scored(df, labels.limit(0)).count() == 5
