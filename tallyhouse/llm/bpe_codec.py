"""Byte-pair encoding by a priority queue of merge ranks, and decoding.

A piece of text is a doubly linked list of symbols. Pairs of neighbours that a merge rule knows wait in a priority queue, least
rank first and leftmost among equals; the front pair is united, and the pairs with its new neighbours join the queue. An entry
whose two symbols are no longer neighbours is stale and is skipped. A task keeps the ids of pieces it has met, up to a
fixed number, so recurring pieces are merged once. Decoding puts the vocabulary's strings together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tallyhouse.llm.common import fresh, text_or_empty, without
from tallyhouse.llm.tokens import UNSURE, WORDS, byte_letters, vocabulary

TOKENIZER = "word_bpe_49k.json"
# Pieces whose ids a task keeps (some 60 MB), and the longest such.
KEPT_PIECES = 300_000
LONGEST_KEPT = 64


def merged(symbols: list[int], products: dict[int, int], pairs: dict[int, tuple[int, int]], base: int) -> list[int]:
    """The symbols after all merges. `products` maps left * base + right to the united symbol, whose number is the rank."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [p * n + i for i in range(n - 1) if (p := products.get(symbols[i] * base + symbols[i + 1])) is not None]
    heapify(queue)
    while queue:
        new, i = divmod(heappop(queue), n)
        j = after[i]
        if j == n or (symbols[i], symbols[j]) != pairs[new]:
            continue  # stale
        symbols[i], symbols[j] = new, -1
        k, h = after[j], before[i]
        after[i] = k
        if k < n:
            before[k] = i
            if (p := products.get(new * base + symbols[k])) is not None:
                heappush(queue, p * n + i)
        if h >= 0 and (p := products.get(symbols[h] * base + new)) is not None:
            heappush(queue, p * n + h)
    return [s for s in symbols if s >= 0]


class Pieces(dict):
    """The ids of pieces met so far, as bytes; it starts anew when it is full."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = self.encode(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Encodes and decodes as the tokenizers library does with a file of byte-level BPE."""

    def __init__(self, name: str):
        self.known = known = vocabulary(name)
        self.library = Tokenizer.from_file(public_tokenizers.path(name))  # cuts texts of other scripts into pieces
        self.base = len(known.ids) + len(known.specials)
        self.products, self.pairs = {}, {}
        for a, b in known.merges:
            left, right, new = known.ids[a], known.ids[b], known.ids[a.removesuffix(known.suffix) + b if known.suffix else a + b]
            self.products[left * self.base + right], self.pairs[new] = new, (left, right)
        if len(self.pairs) != len(self.products):
            raise ValueError(f"two merges of {name} have one product")
        letters = byte_letters()
        self.plain = [known.ids[c] for c in sorted(letters, key=letters.get)]
        self.last = [known.ids[c + known.suffix] for c in sorted(letters, key=letters.get)]
        self.byte = letters
        self.words = Pieces(lambda w: self.piece(w.encode()))
        self.others = Pieces(lambda w: self.piece(bytes([letters[c] for c in w])))

    def piece(self, data: bytes) -> bytes:
        symbols = [self.plain[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        return np.array(merged(symbols, self.products, self.pairs, self.base), "<i4").tobytes()

    def part(self, text: str) -> bytes:
        """The ids of a text without special tokens."""
        if self.known.suffix and not UNSURE.search(text):
            return b"".join(map(self.words.__getitem__, WORDS.findall(text.lower())))
        if self.library.normalizer:
            text = self.library.normalizer.normalize_str(text)
        return b"".join([self.others[w] for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)])

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit numbers; the literal of a special token has that token's id."""
        if not self.known.special.search(text):
            return self.part(text)
        parts = self.known.special.split(text)
        return b"".join([np.array([self.known.specials[p]], "<i4").tobytes() if k % 2 else self.part(p) for k, p in enumerate(parts)])


def strings(name: str) -> tuple[list[str], bool]:
    """The vocabulary's string of each id, and whether they are letters of bytes to be read as UTF-8."""
    known = vocabulary(name)
    out = [""] * (max([*known.ids.values(), *known.specials.values()]) + 1)
    for s, i in (known.ids | known.specials).items():
        out[i] = s
    return out, known.decoder == "ByteLevel"


def encoded(df: DataFrame, text: str = "text", tokenizer: str = TOKENIZER, keep: list[str] | None = None) -> DataFrame:
    """The rows with `ids` (array<int>), those of the whole text without any added token at its ends.

    A null or empty text has no ids. Texts of any length are encoded whole, each in one task. Repeated rows have equal ids; an
    empty table stays empty. An input column `ids` is replaced. `keep`: the input columns to return, all by default.
    """
    rows = without(df, "ids")
    kept = [c for c in rows.columns if keep is None or c in keep]
    schema = T.StructType([*[rows.schema[c] for c in kept], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(tokenizer)
        for batch in it:
            parts = [codec.encode(t.as_py()) for t in batch.column(len(kept))]
            ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(parts), "<i4")))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], ids], names=schema.names)

    return rows.select(*kept, text_or_empty(text).alias(fresh("data", rows.columns))).mapInArrow(encode, schema)


def decoded(df: DataFrame, ids: str = "ids", tokenizer: str = TOKENIZER) -> DataFrame:
    """The rows with `decoded`: the strings of their ids, special tokens included, put together as the library's decode does.

    Strings of a file with a byte-level decoder are bytes of UTF-8 (what is none becomes the replacement character); without a
    decoder a space stands between strings. Null ids give a null, none an empty text. Ids beyond the vocabulary are an
    error. An input column `decoded` is replaced.
    """
    rows = without(df, "decoded")
    at = rows.columns.index(ids)
    schema = T.StructType([*rows.schema.fields, T.StructField("decoded", T.StringType())])

    def decode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, as_bytes = strings(tokenizer)
        if as_bytes:
            letters = byte_letters()
            special = vocabulary(tokenizer).specials
            texts = [s.encode() if s in special else bytes([letters[c] for c in s]) for s in texts]
        table = pa.array(texts)
        for batch in it:
            lists = batch.column(at)
            own = pa.LargeListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())]), pa.int64()),
                table.take(pc.list_flatten(lists)))
            joined = pc.binary_join(own, b"" if as_bytes else " ")
            if as_bytes:
                joined = pa.array([t.as_py().decode("utf-8", "replace") for t in joined], pa.string())
            joined = pc.if_else(lists.is_valid(), joined, pa.scalar(None, joined.type))
            yield pa.RecordBatch.from_arrays([*batch.columns, joined.cast(pa.string())], names=schema.names)

    return rows.mapInArrow(decode, schema)
