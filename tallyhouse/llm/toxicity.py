"""Toxicity by a weighted finite-state pattern grammar.

A lexicon turns words into symbols: insult, threat, target, negation, report, other. Its insults and threats are learned from
labelled rows, as words and word beginnings that stand in toxic documents; a learned entry that targets mostly follow is a
threat. Scope transducers read the symbols of a clause and mark insults and threats: negated or aimed within some words of a
negation or target before them, reported once a verb of saying has come, and, read from right to left, aimed at a target
behind them. Transducers are tables of weighted arcs. Those from left to right are composed into one; weights of
arcs add up along a path and with those of the lexicon. The marked symbols of a document's clauses, how often they occur and
their greatest weights, are the features of a logistic model, so that clauses are scored and not single words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import text_or_empty, without

# At most about so many labelled rows are used to fit, picked by a hash of their id.
FIT_ROWS = 20_000
STEMS = range(3, 9)
# An entry stands in so many toxic documents, and they are such a share of all that hold it.
LEAST_TOXIC = 5
LEAST_PURE = 0.85
PREDICT = 0.7

# Of a learned threat's toxic documents this share has a target within so many words behind it.
THREAT_SHARE = 0.5
AIM = 2

# Symbols of the grammar. From HIT on: an insult or threat with its marks, HIT + marks + (THREAT_BIT if it is a threat).
OTHER, TARGET, NEGATION, REPORT, HIT = range(5)
NEGATED, REPORTED, AIMED, THREAT_BIT = 1, 2, 4, 8
SYMBOLS = HIT + 16
INSULT, THREAT = HIT, HIT + THREAT_BIT
# Function words of the grammar, and verbs of threats, in the four languages of the corpus.
WORDS = {
    THREAT: "kill hurt beat destroy burn shoot stab tuer frapper töten schlagen matar golpear",
    TARGET: "you your yours u he she they them him her tu te toi vous il elle ils du dich euch sie er usted ustedes ellos",
    NEGATION: "not no never nobody isn't aren't don't ne pas jamais nicht kein keine nie nunca jamás ni",
    REPORT: "said says say wrote writes called claims reported quote dit disait écrit sagte sagt schrieb dijo dice escribió",
}
FIXED = {w: (kind, 1.0) for kind, words in WORDS.items() for w in words.split()}
CLAUSE_END = re.compile(r"[.!?;\n]+")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
# A negation holds for so many words, a target for so many to either side.
REACH = 4
FEATURES = 2 * 16 + 2

# A transducer: for each state, by symbol, the arc (next state, symbol put out, weight). State 0 is the first.
Arc = tuple[int, int, float]
Transducer = list[list[Arc]]


def scope(trigger: int, mark: int, weight: float, reach: int | None) -> Transducer:
    """Marks insults and threats within `reach` words behind a trigger, or anywhere behind it in the clause.

    A state is how many words the scope still holds; a mark adds `weight`.
    """
    def arc(left: int, symbol: int) -> Arc:
        after = left if reach is None else max(left - 1, 0)
        if symbol == trigger:
            return (reach or 1), symbol, 0.0
        if symbol >= HIT and left and not (symbol - HIT) & mark:
            return after, symbol + mark, weight
        return after, symbol, 0.0

    return [[arc(left, symbol) for symbol in range(SYMBOLS)] for left in range((reach or 1) + 1)]


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The transducer that does what `second` does to the output of `first`: states are pairs, weights add up."""
    def arc(a: int, b: int, symbol: int) -> Arc:
        next_a, between, weight_a = first[a][symbol]
        next_b, out, weight_b = second[b][between]
        return next_a * len(second) + next_b, out, weight_a + weight_b

    return [[arc(a, b, symbol) for symbol in range(SYMBOLS)] for a in range(len(first)) for b in range(len(second))]


def run(transducer: Transducer, symbols: list[int], weights: list[float]) -> tuple[list[int], list[float]]:
    """Symbols put out, and the weights with those of the arcs added."""
    state, out, total = 0, [], []
    for symbol, weight in zip(symbols, weights, strict=True):
        state, symbol, more = transducer[state][symbol]
        out.append(symbol)
        total.append(weight + more)
    return out, total


# In the order of reading: what stands behind a word is looked at from right to left, the rest from left to right.
BACKWARD = scope(TARGET, AIMED, 0.5, REACH)
FORWARD = compose(compose(scope(NEGATION, NEGATED, -1.0, REACH), scope(REPORT, REPORTED, -0.5, None)), scope(TARGET, AIMED, 0.5, REACH))


@dataclass(frozen=True)
class Model:
    """The learned lexicon (word or beginning, the latter ending in "*", to symbol and weight) and the weights of features."""

    lexicon: dict[str, tuple[int, float]]
    weights: tuple[float, ...]


def symbol(word: str, lexicon: dict[str, tuple[int, float]]) -> tuple[int, float]:
    """A word's symbol and weight: the learned entry of the greatest weight, else a fixed one."""
    best = lexicon.get(word)
    for n in STEMS:
        if n > len(word):
            break
        found = lexicon.get(word[:n] + "*")
        if found is not None and (best is None or found[1] > best[1]):
            best = found
    return best or FIXED.get(word, (OTHER, 0.0))


def clause_patterns(read: list[tuple[int, float]]) -> list[tuple[int, float]]:
    """(marked symbol, weight) of each insult or threat of a clause, in order."""
    symbols, weights = [s for s, _ in read], [w for _, w in read]
    symbols, weights = run(BACKWARD, symbols[::-1], weights[::-1])
    symbols, weights = run(FORWARD, symbols[::-1], weights[::-1])
    return [(s, w) for s, w in zip(symbols, weights, strict=True) if s >= HIT]


def clause_features(text: str, known: dict[str, tuple[int, float]], lexicon: dict[str, tuple[int, float]]) -> np.ndarray | None:
    """Counts (as logarithms) and greatest weights per marked symbol, clauses hit and their share; None without a hit.

    `known` holds the symbols of words met before.
    """
    low = text.lower()
    hit = False
    for w in set(WORD.findall(low)):
        if w not in known:
            known[w] = symbol(w, lexicon)
        hit = hit or known[w][0] >= HIT
    if not hit:
        return None
    count, most, clauses, hits = np.zeros(16), np.zeros(16), 0, 0
    for clause in CLAUSE_END.split(low):
        read = [known[w] for w in WORD.findall(clause)]
        clauses += 1
        if not any(s >= HIT for s, _ in read):
            continue
        hits += 1
        for s, weight in clause_patterns(read):
            count[s - HIT] += 1
            most[s - HIT] = max(most[s - HIT], weight)
    return np.concatenate([np.log1p(count), most, [np.log1p(hits), hits / clauses]])


def features_of(texts: list[str | None], lexicon: dict[str, tuple[int, float]]) -> np.ndarray:
    known: dict[str, tuple[int, float]] = {}
    out = np.zeros((len(texts), FEATURES))
    for i, text in enumerate(texts):
        if len(known) > 100_000:
            known.clear()
        found = clause_features(text, known, lexicon) if text else None
        if found is not None:
            out[i] = found
    return out


def entries(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per task: in how many toxic and other documents each word and word beginning stands, and in how many toxic ones a
    target follows it."""
    counts: tuple[Counter, Counter, Counter] = (Counter(), Counter(), Counter())
    targets = {w for w, (kind, _) in FIXED.items() if kind == TARGET}

    def with_stems(words: set[str]) -> set[str]:
        return words | {w[:n] + "*" for w in words for n in STEMS if n <= len(w)}

    def flush():
        rows = pd.DataFrame({"entry": list(counts[0].keys() | counts[1].keys())}, dtype=object)
        for name, c in zip(("other", "toxic", "aimed"), counts, strict=True):
            rows[name] = [c[e] for e in rows["entry"]]
            c.clear()
        return rows

    for rows in it:
        for text, toxic in zip(rows["text"], rows["toxic"], strict=True):
            words = WORD.findall(text.lower())
            counts[int(toxic)].update(with_stems(set(words)))
            if toxic:
                at = [i for i, w in enumerate(words) if w in targets]
                counts[2].update(with_stems({words[k] for i in at for k in range(max(0, i - AIM), i)}))
            if len(counts[0]) + len(counts[1]) > 500_000:
                yield flush()
    yield flush()


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> np.ndarray:
    """Weights, the constant last, by Newton's method.

    A step that would raise the penalised loss is halved: whole steps run away where the classes are nearly parted.
    """
    x = np.hstack([x, np.ones((len(x), 1))])
    w, pull = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    pull[-1] = 1e-4

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return np.logaddexp(0, z).sum() - y @ z + pull @ (w * w) / 2

    least = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (p - y) + pull * w)
        while (now := loss(w - step)) > least and np.abs(step).max() >= 1e-8:
            step = step / 2
        w, least = w - step, min(now, least)
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(labelled: DataFrame, text: str = "text", label: str = "toxic", key: str = "doc_id") -> Model:
    """A model from rows with a text and a label 0 or 1; others are left out, and so are rows beyond about FIT_ROWS.

    Rows are picked by a hash of their key, so the choice does not depend on their order. The lexicon and the features of the
    picked rows (a few dozen numbers each) reach the driver; both are bounded by FIT_ROWS, for an entry stands in LEAST_TOXIC
    of the picked rows.
    Without toxic rows the model has no lexicon and gives every text the same low score.
    """
    usable = labelled.select(
        F.col(text).alias("text"), F.col(label).cast("int").alias("toxic"), F.xxhash64(key).alias("place")
    ).filter(F.col("text").isNotNull() & F.col("toxic").isin(0, 1))
    total = usable.count()
    share = min(1.0, FIT_ROWS / max(1, total))
    picked = usable.filter(F.pmod(F.col("place"), F.lit(1_000_000)) < int(share * 1_000_000)).select("text", "toxic")
    n = {r.toxic: r.n for r in picked.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, other = n.get(1, 0), n.get(0, 0)
    counted = picked.mapInPandas(entries, "entry string, other long, toxic long, aimed long")
    sums = counted.groupBy("entry").agg(*[F.sum(c).alias(c) for c in ("other", "toxic", "aimed")])
    odds = F.log((F.col("toxic") + 0.5) / (F.col("other") + 0.5) * F.lit((other + 1) / (toxic + 1)))
    pure = F.col("toxic") >= LEAST_PURE * (F.col("toxic") + F.col("other") + 0.5)
    best = sums.filter((F.col("toxic") >= LEAST_TOXIC) & pure).withColumn("odds", odds).filter(F.col("odds") > 1)
    kind = F.when(F.col("aimed") >= THREAT_SHARE * F.col("toxic"), THREAT).otherwise(INSULT)
    lexicon = {r.entry: (r.kind, r.odds) for r in best.select("entry", kind.alias("kind"), "odds").collect()}
    names = [f"f{i}" for i in range(FEATURES)]

    def measured(it):
        for rows in it:
            yield pd.DataFrame(features_of(list(rows["text"]), lexicon), columns=names).assign(toxic=rows["toxic"].to_numpy())

    table = picked.mapInPandas(measured, ", ".join(f"{c} double" for c in names) + ", toxic int").toPandas()
    x, y = table[names].to_numpy(), table["toxic"].to_numpy(dtype=float)
    if not len(y):
        return Model({}, (0.0,) * FEATURES + (-4.0,))
    return Model(lexicon, tuple(float(v) for v in logistic(x, y)))


def score_of(model: Model, text: Column) -> Column:
    """The probability that a text is toxic, by the model; a null or empty text has that of a text without a pattern."""
    weights = np.array(model.weights)

    def score(texts: pa.Array) -> pa.Array:
        x = features_of(texts.to_pylist(), model.lexicon)
        return pa.array(1 / (1 + np.exp(-np.clip(x @ weights[:-1] + weights[-1], -30, 30))))

    return F.arrow_udf(score, T.DoubleType())(text)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from learning: the CRC-32 of its id as text leaves 1 by 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def scored(df: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows with `held_out`, `score` and `predicted`.

    The model is fitted on rows that have a label and are not held out; a row with several labels is used once for
    each, null ids and labels are not used. Null and empty texts get a score too. Repeated rows get equal scores. An empty
    table stays empty. Input columns of those names are replaced; scores rest on texts alone.
    """
    rows = without(df, "held_out", "score", "predicted")
    known = labels.select(F.col("doc_id").alias("label_id"), "toxic")
    texts = rows.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(~held_out("doc_id"))
    model = fit(texts.join(known, F.col("doc_id") == F.col("label_id")))
    out = rows.withColumns({"held_out": held_out(doc_id), "score": score_of(model, text_or_empty(text))})
    return out.withColumn("predicted", (F.col("score") >= PREDICT).cast("int"))
