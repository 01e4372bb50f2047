"""Ranked lexical search by norm buckets.

A document is a vector of integer impacts, one for each of its terms that some item holds; an item is a vector of integer term
weights; the score is their product. Documents are taken in blocks; a block is ordered by the length of its vectors and cut
into buckets. For an item whose k-th best score so far is t, a bucket is passed over if the Cauchy-Schwarz bound or the sum of
the greatest impacts of its terms stays below t. Inside a bucket, impacts of the item's weightiest terms are added up; a
document goes on only if that sum and a bound for the other terms, by their greatest impacts there and by the rest of both
lengths, can reach t. What is left is scored anew in integers. Every task keeps k documents an item; the
best k of all tasks are the result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import stored, text_or_empty

BEST = 50
# Distinct terms of items that are searched in one pass over the documents; more items take further passes.
PASS_TERMS = 500_000
# Documents ordered by length together, and those of a bucket.
BLOCK = 16_384
BUCKET = 2_048
# What each byte of a text becomes: signs and blanks of ASCII a space, capitals of ASCII small, the rest itself.
FOLD = bytes(c if c >= 0x80 else ord(chr(c).lower()) if chr(c).isalnum() else 0x20 for c in range(256))

VECTOR = "doc_id long, n long, terms array<int>, counts array<int>"
FOUND_ARROW = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def terms_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of whatever is not ASCII; only A-Z become lower case."""
    return text.translate(FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(counts: np.ndarray, sizes: list[int], lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The impact of each term: documents of `sizes` terms hold `lengths` of the terms given."""
    m = np.array([50 + (50 * n * n_docs) // n_terms for n in sizes], np.int64)
    return 1_000_000_000 * counts // (1000 * counts + 20 * np.repeat(m, lengths))


class Query:
    """An item's terms with their weights, greatest first, and the best documents so far."""

    def __init__(self, terms: np.ndarray, weights: np.ndarray, best: int):
        order = np.argsort(-weights, kind="stable")
        self.terms, self.weights, self.best = terms[order], weights[order], best
        self.rest = np.sqrt(np.append(np.cumsum((self.weights.astype(float) ** 2)[::-1])[::-1], 0.0))  # length from each term on
        self.scores = np.zeros(0, np.int64)
        self.docs = np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """The score that a document needs at least."""
        return int(self.scores[-1]) if len(self.scores) == self.best else 1

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """Equal scores go by document; a null document (the least number) is first."""
        good = scores >= self.least
        scores, docs = np.concatenate([self.scores, scores[good]]), np.concatenate([self.docs, docs[good]])
        first = np.lexsort([docs, -scores])[: self.best]
        self.scores, self.docs = scores[first], docs[first]


class Bucket:
    """Documents of similar length: their rows of (term, impact), and the same by term."""

    def __init__(self, docs: np.ndarray, terms: np.ndarray, impact: np.ndarray, lengths: np.ndarray, norms: np.ndarray, n_terms: int):
        self.docs, self.terms, self.impact, self.lengths, self.norms = docs, terms, impact, lengths, norms
        self.starts = np.cumsum(lengths) - lengths
        by = np.argsort(terms, kind="stable")
        self.of_term = np.repeat(np.arange(len(docs)), lengths)[by]
        self.impact_by_term = impact[by]
        self.bounds = np.concatenate([[0], np.cumsum(np.bincount(terms, minlength=n_terms))])
        self.most = np.zeros(n_terms, np.int64)
        np.maximum.at(self.most, terms, impact)

    def candidates(self, query: Query) -> np.ndarray:
        """The documents that may reach the score that the query still needs."""
        least = query.least * (1 - 1e-9)
        if query.rest[0] * self.norms[0] < least:
            return np.zeros(0, np.int64)
        most = query.weights * self.most[query.terms]
        after = np.append(np.cumsum(most[::-1])[::-1], 0)  # the most that the terms from each on can add
        if after[0] < least:
            return np.zeros(0, np.int64)
        focus = int(np.argmax(after < least / 2))  # the last one is 0, so there is one
        total, square = np.zeros(len(self.docs), np.int64), np.zeros(len(self.docs))
        for t, w in zip(query.terms[:focus].tolist(), query.weights[:focus].tolist(), strict=True):
            a, b = self.bounds[t], self.bounds[t + 1]
            if a < b:
                total[self.of_term[a:b]] += w * self.impact_by_term[a:b]
                square[self.of_term[a:b]] += self.impact_by_term[a:b].astype(float) ** 2
        other = query.rest[focus] * np.sqrt(np.maximum(self.norms**2 * (1 + 1e-9) - square, 0))
        return np.flatnonzero(total + np.minimum(after[focus], other) >= least)

    def score(self, query: Query, rows: np.ndarray, scratch: np.ndarray) -> np.ndarray:
        """Exact scores of some documents. `scratch`: a zero for each term, and zero again afterwards."""
        scratch[query.terms] = query.weights
        lengths = self.lengths[rows]
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1]) + np.repeat(self.starts[rows] - ends + lengths, lengths)
        sums = np.add.reduceat(scratch[self.terms[at]] * self.impact[at], ends - lengths)
        scratch[query.terms] = 0
        return sums


def search_block(queries: list[Query], docs, terms, impact, lengths, n_terms: int, bucket: int) -> None:
    """Takes the documents of a block, none of them without a term, into the queries' best."""
    norms = np.sqrt(np.add.reduceat(impact.astype(float) ** 2, np.cumsum(lengths) - lengths))
    order, starts = np.argsort(-norms, kind="stable"), np.cumsum(lengths) - lengths
    scratch = np.zeros(n_terms, np.int64)
    for k in range(0, len(order), bucket):
        own = order[k : k + bucket]
        size = lengths[own]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(starts[own] - ends + size, size)
        part = Bucket(docs[own], terms[at], impact[at], size, norms[own], n_terms)
        for query in queries:
            rows = part.candidates(query)
            if len(rows):
                query.add(part.score(query, rows, scratch), part.docs[rows])


def vectors(df: DataFrame, text: str, doc_id: str, codes: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts): how many terms a document has, and those that `codes` knows, ascending, with their counts."""
    names = ["doc_id", "n", "terms", "counts"]
    ints = pa.list_(pa.int32())

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            sizes, terms, counts = [], [], []
            for t in batch.column(1):
                words = terms_of(t.as_py())
                met = sorted(Counter(filter(None, map(codes.get, words))).items())
                sizes.append(len(words))
                terms.append([c for c, _ in met])
                counts.append([n for _, n in met])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, ints), pa.array(counts, ints)], names=names)

    slim = df.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).cast("binary").alias("text"))
    return slim.mapInArrow(count, VECTOR)


def item_terms(queries: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item_id, terms), rows of one item together."""
    def split(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            found = [sorted(set(terms_of(t.as_py()))) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item_id", "terms"])

    rows = queries.select(F.col(item_id).alias("item_id"), text_or_empty(text).cast("binary").alias("text"))
    schema = T.StructType([rows.schema["item_id"], T.StructField("terms", T.ArrayType(T.BinaryType()))])
    each = rows.mapInArrow(split, schema).select("item_id", F.explode("terms").alias("term")).distinct()
    return stored(each.groupBy("item_id").agg(F.collect_list("term").alias("terms")))


def search_pass(df: DataFrame, items: list, text: str, doc_id: str, best: int) -> DataFrame | None:
    """(item, doc_id, score): what each task keeps for the items at their places in `items`, lists of terms."""
    known = {term: k + 1 for k, term in enumerate(sorted({bytes(t) for terms in items for t in terms}))}
    table = stored(vectors(df, text, doc_id, known))
    n_docs, n_terms = table.filter("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    if not n_docs:
        return None
    held = dict(table.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = np.array([weight(n_docs, held.get(c, 0)) for c in range(len(known) + 1)], np.int64)
    codes = [np.array([known[bytes(t)] for t in terms], np.int64) for terms in items]

    def search(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [Query(c, weights[c], best) for c in codes]
        batches, rows = [], 0

        def block():
            t = pa.Table.from_batches(batches).combine_chunks()
            lengths = t["terms"].combine_chunks().value_lengths().to_numpy().astype(np.int64)
            terms = t["terms"].combine_chunks().flatten().to_numpy().astype(np.int64)
            counts = t["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
            impact = impacts(counts, t["n"].to_pylist(), lengths, n_docs, n_terms)
            docs = t["doc_id"].combine_chunks().fill_null(np.iinfo(np.int64).min).to_numpy()
            search_block(queries, docs, terms, impact, lengths, len(known) + 1, BUCKET)

        for batch in it:
            if batch.num_rows:
                batches.append(batch)
                rows += batch.num_rows
            if rows >= BLOCK:
                block()
                batches, rows = [], 0
        if rows:
            block()
        for k, q in enumerate(queries):
            if len(q.docs):
                ids = pa.array(q.docs, mask=q.docs == np.iinfo(np.int64).min)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(q.docs), k, np.int32)), ids, pa.array(q.scores)], schema=FOUND_ARROW)

    return table.filter(F.size("terms") > 0).mapInArrow(search, "item int, doc_id long, score long")


def search(df: DataFrame, queries: DataFrame, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id",
           item_text: str = "text", best: int = BEST) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's `best` documents with a score above 0, equal scores by doc_id, nulls first.

    Rows of one item_id, null included, are one item. Null and empty texts have no terms and are not found; an item without
    terms finds nothing. Repeated documents are ranked one by one. Without documents or items nothing is returned. Other
    columns are not read. Items are searched in passes of about PASS_TERMS terms, whose terms and weights go to every task; a
    document's terms and counts are written once a pass, and each task keeps `best` rows an item.
    """
    items = item_terms(queries, item_id, item_text)
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    passes, found = -(-total // PASS_TERMS), None
    for k in range(passes):
        rows = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == k).collect()
        kept = search_pass(df, [r.terms for r in rows], text, doc_id, best) if rows else None
        if kept is None:
            continue
        names = df.sparkSession.createDataFrame(
            [(n, r.item_id) for n, r in enumerate(rows)], T.StructType([T.StructField("of_item", T.IntegerType()), items.schema["item_id"]]))
        order = W.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
        ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
        part = ranked.join(F.broadcast(names), F.col("item") == F.col("of_item")).select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    if found is None:
        kind = T.StructType([items.schema["item_id"], *[T.StructField(c, t) for c, t in (
            ("rank", T.IntegerType()), ("doc_id", T.LongType()), ("score", T.LongType()))]])
        return df.sparkSession.createDataFrame([], kind)
    return found
