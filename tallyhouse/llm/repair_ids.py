"""Token ids in a file format compressed by Re-Pair.

A block holds the ids of some documents in a row. Pairs of neighbouring symbols are replaced by nonterminals, the most
frequent first, until no pair occurs LEAST_COUNT times or the 16-bit symbols run out. A round replaces all pairs that occur
so often, and the next round those that occur a quarter as often; where two of them overlap, the more frequent one is replaced,
and of a run of one symbol every second pair. A block stores its rules, how many ids each nonterminal stands for, and where each document
begins, so that one document is decoded without the others.

A block, little-endian: magic "RPR1"; u32 vocabulary, rules, symbols, documents; u64 ids; then per rule u16 left,
u16 right, u32 expansion length; per document i64 id, u8 whether it is null, u32 first symbol, u64 first id;
then the symbols as u16. Ids must lie below 65,536, and nonterminals take the numbers from the vocabulary's size on.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallyhouse.llm.tokens import encoder

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
VOCABULARY = 49_408
# Ids after which a block ends (with its document), and how often a pair must occur to be replaced.
BLOCK_IDS = 1 << 20
LEAST_COUNT = 8
# How much rarer the pairs of the next round may be.
STEP = 4
# Cells of the table of chosen pairs by left and right symbol, up to which it is used; beyond, pairs are searched.
TABLE = 1 << 22
SHARD_BYTES = 256 << 20
MAGIC = b"RPR1"
HEAD = struct.Struct("<4s4IQ")

BLOCK_TYPE = "shard long, block long, start long, n_ids long, data binary"
BLOCK_ARROW = pa.schema([
    ("shard", pa.int64()), ("block", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64()), ("data", pa.binary()),
])


def odd_places(symbols: np.ndarray) -> np.ndarray:
    """The places that begin no pair to be counted: in a run of one symbol, every second one."""
    equal = np.flatnonzero(symbols[:-1] == symbols[1:])
    place = np.arange(len(equal))
    first = np.ones(len(equal), bool)
    first[1:] = equal[1:] != equal[:-1] + 1
    begin = np.maximum.accumulate(np.where(first, place, 0))
    return equal[(place - begin) % 2 == 1]


def frequent_pairs(keys: np.ndarray, least: int, most: int) -> tuple[np.ndarray, int]:
    """At most `most` pairs (left << 16 | right) that occur `least` times, most frequent first; and the greatest count.

    Without such a pair, pairs a STEP-th as frequent as the most frequent one count."""
    ordered = np.sort(keys)
    edge = np.ones(len(ordered) + 1, bool)
    np.not_equal(ordered[1:], ordered[:-1], out=edge[1:-1])
    at = np.flatnonzero(edge)
    count = np.diff(at)
    top = int(count.max(initial=0))
    often = np.flatnonzero(count >= max(LEAST_COUNT, min(least, -(-top // STEP))))
    often = often[np.argsort(-count[often], kind="stable")][:most]
    return ordered[at[often]], top


def places_of(chosen: np.ndarray, keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, which of the chosen pairs stands there) of the ascending places `at` of the pairs `keys`."""
    left, right = np.unique(chosen >> 16), np.unique(chosen & 0xFFFF)
    is_left, is_right = np.zeros(65_536, bool), np.zeros(65_536, bool)
    is_left[left], is_right[right] = True, True
    some = is_left[keys >> 16]
    some &= is_right[keys & 0xFFFF]
    at, keys = at[some], keys[some]
    if len(left) * len(right) <= TABLE:
        row, column = np.zeros(65_536, np.int32), np.zeros(65_536, np.int32)
        row[left], column[right] = np.arange(len(left)) * len(right), np.arange(len(right))
        table = np.full(len(left) * len(right), -1, np.int32)
        table[row[chosen >> 16] + column[chosen & 0xFFFF]] = np.arange(len(chosen))
        which = table[row[keys >> 16] + column[keys & 0xFFFF]]
        return at[which >= 0], which[which >= 0]
    order = np.argsort(chosen)
    found = np.searchsorted(chosen[order], keys).clip(max=len(chosen) - 1)
    same = chosen[order][found] == keys
    return at[same], order[found[same]]


def without_overlap(at: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Which of the ascending places stay: none next to another, and a better (lesser) pair before its neighbours.

    Places that two better ones leave free in turn are tried thrice; what is still open then waits for the next round.
    """
    kept, left = np.zeros(len(at), bool), np.arange(len(at))
    for _ in range(3):
        if not len(left):
            break
        a, w = at[left], which[left]
        touch = np.concatenate([a[1:] == a[:-1] + 1, [False]])
        before = np.concatenate([[False], touch[:-1]])
        best = (~touch | (w < np.append(w[1:], 0))) & (~before | (w < np.append(0, w[:-1])))
        kept[left[best]] = True
        beside = np.concatenate([best[1:], [False]]) & touch | np.concatenate([[False], best[:-1]]) & before
        left = left[~best & ~beside]
    return kept


def compress(symbols: np.ndarray, end_id: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray]:
    """(rules as pairs, symbols). No pair holds the end id, so documents begin at a symbol of their own."""
    rules, least, fresh = np.zeros(0, np.uint32), len(symbols), 0
    while len(symbols) > 1 and vocabulary + len(rules) < 65_536:
        usable = symbols != end_id
        usable = usable[:-1] & usable[1:]
        usable[odd_places(symbols)] = False
        if fresh:  # what else occurs often enough was replaced before, so pairs with a new symbol are counted first
            new = symbols >= fresh
            usable &= new[:-1] | new[1:]
        at = np.flatnonzero(usable)
        keys = symbols[:-1][usable].astype(np.uint32) << 16 | symbols[1:][usable]
        chosen, top = frequent_pairs(keys, least, 65_536 - vocabulary - len(rules))
        if not len(chosen):
            if not fresh:
                break
            fresh = 0
            continue
        fresh = vocabulary + len(rules) if least == LEAST_COUNT else 0
        least = max(LEAST_COUNT, min(least, top) // STEP)
        at, which = places_of(chosen, keys, at)
        kept = without_overlap(at, which)
        # Of pairs that overlap with better ones, enough must be left; the best pair loses none, so rounds come to an end.
        enough = np.bincount(which[kept], minlength=len(chosen)) >= LEAST_COUNT
        kept &= enough[which]
        number = np.cumsum(enough) - 1
        symbols = symbols.copy()
        symbols[at[kept]] = vocabulary + len(rules) + number[which[kept]]
        stays = np.ones(len(symbols), bool)
        stays[at[kept] + 1] = False
        symbols, rules = symbols[stays], np.concatenate([rules, chosen[enough]])
    return rules, symbols


def lengths_of(rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """How many ids each rule's nonterminal stands for."""
    out = np.ones(vocabulary + len(rules), np.uint32)
    for i, (a, b) in enumerate(zip((rules >> 16).tolist(), (rules & 0xFFFF).tolist(), strict=True)):
        out[vocabulary + i] = out[a] + out[b]
    return out[vocabulary:]


def expand(symbols: np.ndarray, rules: np.ndarray, vocabulary: int) -> np.ndarray:
    """The ids that symbols stand for."""
    while True:
        at = np.flatnonzero(symbols >= vocabulary)
        if not len(at):
            return symbols
        pair = rules[symbols[at] - vocabulary]
        symbols = np.insert(symbols, at + 1, (pair & 0xFFFF).astype(np.uint16))
        symbols[at + np.arange(len(at))] = pair >> 16


def write_block(doc_ids: list[int | None], ids: list[np.ndarray], end_id: int = END_ID, vocabulary: int = VOCABULARY) -> bytes:
    """A block of documents, each an array of ids that ends with the end id, which may also stand within."""
    sizes = np.array([len(x) for x in ids], np.uint64)
    flat = np.concatenate(ids) if ids else np.zeros(0, np.uint16)
    if len(flat) and int(flat.max()) >= vocabulary:
        raise ValueError(f"id {flat.max()} is not below the vocabulary's size {vocabulary}")
    flat = flat.astype(np.uint16)
    rules, symbols = compress(flat, end_id, vocabulary)
    lengths = lengths_of(rules, vocabulary)
    each = np.ones(len(symbols), np.uint64)
    each[symbols >= vocabulary] = lengths[symbols[symbols >= vocabulary] - vocabulary]
    begins = np.cumsum(sizes) - sizes
    first = np.searchsorted(np.cumsum(each) - each, begins)
    docs = np.zeros(len(ids), [("id", "<i8"), ("null", "u1"), ("symbol", "<u4"), ("start", "<u8")])
    docs["id"], docs["null"] = [d or 0 for d in doc_ids], [d is None for d in doc_ids]
    docs["symbol"], docs["start"] = first, begins
    table = np.zeros(len(rules), [("left", "<u2"), ("right", "<u2"), ("length", "<u4")])
    table["left"], table["right"], table["length"] = rules >> 16, rules & 0xFFFF, lengths
    head = HEAD.pack(MAGIC, vocabulary, len(rules), len(symbols), len(ids), len(flat))
    return head + table.tobytes() + docs.tobytes() + symbols.astype("<u2").tobytes()


class Block:
    """A block read back."""

    def __init__(self, data: bytes):
        magic, self.vocabulary, rules, symbols, docs, self.n_ids = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a block of ids")
        table = np.frombuffer(data, [("left", "<u2"), ("right", "<u2"), ("length", "<u4")], rules, at := HEAD.size)
        self.rules, self.lengths = table["left"].astype(np.uint32) << 16 | table["right"], table["length"]
        at += table.nbytes
        self.docs = np.frombuffer(data, [("id", "<i8"), ("null", "u1"), ("symbol", "<u4"), ("start", "<u8")], docs, at)
        self.symbols = np.frombuffer(data, "<u2", symbols, at + self.docs.nbytes)

    def document(self, i: int) -> np.ndarray:
        """The ids of one document, from its own symbols alone."""
        end = self.docs["symbol"][i + 1] if i + 1 < len(self.docs) else len(self.symbols)
        return expand(self.symbols[self.docs["symbol"][i] : end], self.rules, self.vocabulary)

    def part(self, start: int, count: int) -> np.ndarray:
        """`count` ids from id `start` of the block on: the expansion lengths tell which symbols hold them."""
        each = np.ones(len(self.symbols), np.int64)
        ruled = self.symbols >= self.vocabulary
        each[ruled] = self.lengths[self.symbols[ruled] - self.vocabulary]
        ends = np.cumsum(each)
        first, last = np.searchsorted(ends, [start, start + count - 1], side="right")
        skip = start - (ends[first] - each[first])
        return expand(self.symbols[first : last + 1], self.rules, self.vocabulary)[skip : skip + count]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, first id in the block, ids) of each document."""
        ids = expand(self.symbols, self.rules, self.vocabulary)
        bounds = [*self.docs["start"].tolist(), self.n_ids]
        for d, a, b in zip(self.docs, bounds, bounds[1:], strict=False):
            yield None if d["null"] else int(d["id"]), a, ids[a:b]


def write(df: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", tokenizer: str = TOKENIZER,
          end_id: int = END_ID, vocabulary: int = VOCABULARY, special_as_text: bool = False) -> None:
    """Writes the ids of all documents as blocks in ascending order of doc_id, nulls first, ties in any order.

    Ranges of ids become shards; rows of one id may be dealt to several, so no id is hot. A task encodes its range as a
    stream and ends a block after BLOCK_IDS ids. A null or empty text is the end id alone; an empty table writes
    none. Other columns are not read. An id that is not below `vocabulary` is an error. Blocks are rows of (shard, block,
    start, n_ids, data) in parquet files, so a failed task leaves nothing behind. There is a shard for every SHARD_BYTES of
    text, and as many as the session has shuffle partitions at least.
    """
    def blocks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(tokenizer, special_as_text).each, TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        block, start, size, docs, ids = 0, 0, 0, [], []

        def ended():
            data = write_block(docs, ids, end_id, vocabulary)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], f.type) for v, f in zip((shard, block, start, size, data), BLOCK_ARROW, strict=True)], schema=BLOCK_ARROW)

        for batch in it:
            texts = (t.as_py() or "" for t in batch.column(1))
            for key, own in zip(batch.column(0).to_pylist(), encode(texts), strict=True):
                docs.append(key)
                ids.append(np.frombuffer(own + end, "<u4"))
                size += len(ids[-1])
                if size >= BLOCK_IDS:
                    yield ended()
                    block, start, size, docs, ids = block + 1, start + size, 0, [], []
        if docs:
            yield ended()

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"))
    size = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shards = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // SHARD_BYTES)
    ordered = rows.repartitionByRange(shards, "doc_id", "row").sortWithinPartitions("doc_id", "row").select("doc_id", "text")
    ordered.mapInArrow(blocks, BLOCK_TYPE).write.parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids): each document's ids (little-endian unsigned 32-bit) and how many ids stand before it."""
    blocks = spark.read.schema(BLOCK_TYPE).parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1))  # one row per shard
    shards = totals.select(F.col("shard").alias("of_shard"), F.coalesce(before, F.lit(0)).alias("shard_start"))

    def documents(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["shard", "doc_id", "start", "ids"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in it:
            for shard, start, data in zip(*[batch.column(c) for c in ("shard", "start", "data")], strict=True):
                rows = [(shard.as_py(), d, start.as_py() + s, ids.astype("<u4").tobytes()) for d, s, ids in Block(data.as_py()).documents()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    docs = blocks.select("shard", "start", "data").mapInArrow(documents, "shard long, doc_id long, start long, ids binary")
    return docs.join(F.broadcast(shards), F.col("shard") == F.col("of_shard")).select(
        "doc_id", (F.col("shard_start") + F.col("start")).alias("start"), "ids")


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
