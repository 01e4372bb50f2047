"""Token ids of whole texts, by BPE files of the tokenizers library.

Files of two kinds are known: byte-level BPE that takes a space along with the word behind it, and byte-level BPE over
lower-cased words whose last byte carries an end mark. Both merge the pair of least rank first, and a product's id grows
with its rank, so tiktoken's encoder gives the same ids from the same vocabulary at a lower price. Texts with other
characters than printable ASCII, Latin letters and plain white space, for which versions of Unicode may cut words in other
places, and texts with the literal of a special token are encoded by the library itself. Of texts of lower-cased words some
are taken together and each different word of theirs is encoded once; nothing else is kept between texts.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer

# Latin letters and signs that stay one of them in lower case: İ becomes two characters, Ɓ a letter of a later block.
LATIN = [chr(c) for c in range(0xA1, 0x250) if len(chr(c).lower()) == 1 and ord(chr(c).lower()) < 0x250]
UNSURE = re.compile("[^\t\n\r\x20-\x7e" + "".join(LATIN) + "]")
LETTERS = "a-z" + "".join(c for c in LATIN if unicodedata.category(c)[0] == "L")
NUMBERS = "0-9" + "".join(c for c in LATIN if unicodedata.category(c)[0] == "N")
# Contractions, runs of letters, single numbers and runs of other signs, as the files of lower-cased words cut them.
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^ \t\n\r{LETTERS}{NUMBERS}]+")
# The kind of each sure character: blank 0, letter 1, number 2, other sign 3.
KINDS = np.array([0 if chr(c) in "\t\n\r " else {"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 3) for c in range(0x250)], np.uint8)
BYTE_KINDS = KINDS[:256].tobytes()
# Characters of texts whose words are looked up together; the text that reaches them is the last.
CHUNK, CHUNK_TEXTS = 8 << 20, 20_000
# Stands for the end mark of a word in texts and vocabulary; sure texts do not hold it.
END = "\x01"


def byte_letters() -> dict[str, int]:
    """The letter of each byte in vocabulary strings: printable Latin-1 stands for itself, the others follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(the bytes that are no blanks, where each word ends in them, the place of each word's last byte) of sure texts in lower
    case, as UTF-8 with a blank before and two behind: what WORDS finds, by the kinds of neighbouring characters."""
    kind = np.frombuffer(bytearray(data.tobytes().translate(BYTE_KINDS)), np.uint8)
    lead = np.flatnonzero(data >= 0xC2)  # of two bytes, the first's
    kind[lead] = KINDS[(data[lead] & 0x1F).astype(np.int64) << 6 | data[lead + 1] & 0x3F]
    kind[lead + 1] = kind[lead]
    last = np.ones(len(data), bool)
    np.not_equal(kind[1:], kind[:-1], out=last[:-1])
    last |= kind == 2
    last[lead] = False
    # An apostrophe behind no other sign begins a contraction, whatever stands behind that.
    mark = np.flatnonzero(data == ord("'"))
    mark = mark[kind[mark - 1] != 3]
    first, second = data[mark + 1], data[mark + 2]
    one = np.isin(first, np.frombuffer(b"stmd", np.uint8))
    two = (first == ord("r")) & (second == ord("e")) | (first == ord("v")) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
    last[mark[one | two]] = False
    last[mark[one] + 1] = True
    last[mark[two] + 2] = True
    shown = kind != 0
    return data[shown], np.flatnonzero(last[shown]) + 1, np.flatnonzero(last & shown)


class Vocabulary:
    """What a tokenizer file states: ids, merges in the order of their rank, the end mark, special tokens."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.decoder = (spec["decoder"] or {}).get("type")
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        products = [self.ids[a.removesuffix(self.suffix) + b if self.suffix else a + b] for a, b in self.merges]
        if products != sorted(products):
            raise ValueError(f"ids of {path} do not grow with the ranks of merges")

    def ranks(self) -> dict[bytes, int]:
        """Byte strings and their ids; END is the last byte of those with an end mark."""
        byte = byte_letters()
        out = {}
        for token, i in self.ids.items():
            ended = bool(self.suffix) and token.endswith(self.suffix)
            plain = token[: -len(self.suffix)] if ended else token
            out[bytes([byte[c] for c in plain]) + (END.encode() if ended else b"")] = i
        return out


@lru_cache(maxsize=4)
def vocabulary(name: str) -> Vocabulary:
    return Vocabulary(public_tokenizers.path(name))


class Encoder:
    """Ids of texts as little-endian 32-bit numbers; `special_as_text`: literals of special tokens are plain text."""

    def __init__(self, name: str, special_as_text: bool):
        known = vocabulary(name)
        self.library = Tokenizer.from_file(public_tokenizers.path(name))
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = special_as_text
        self.special = None if special_as_text else known.special
        self.ended = bool(known.suffix)
        pattern = f"[^{END}]+{END}" if self.ended else public_tokenizers.PATTERN
        ranks = known.ranks()
        self.core = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        # Which ids end a word.
        self.ends = np.zeros(max(ranks.values()) + 1, bool)
        self.ends[[i for b, i in ranks.items() if b.endswith(END.encode())]] = True

    def ids(self, text: str) -> bytes:
        return next(self.each([text]))

    def each(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text, in their order."""
        if not self.ended:
            yield from map(self.alone, texts)
            return
        held: list[str] = []
        others: dict[int, bytes] = {}
        size = 0

        def encoded() -> Iterator[bytes]:
            yield from [others.get(k, ids) for k, ids in enumerate(self.of_words(held))]
            held.clear()
            others.clear()

        for text in texts:
            size += len(text)
            if self.unsure(text):
                others[len(held)] = self.alone(text)
                text = ""
            held.append(text)
            if size >= CHUNK or len(held) >= CHUNK_TEXTS:
                yield from encoded()
                size = 0
        yield from encoded()

    def unsure(self, text: str) -> bool:
        return bool(UNSURE.search(text) or (self.special and self.special.search(text)))

    def alone(self, text: str) -> bytes:
        if not text:
            return b""
        if self.unsure(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.core.encode_to_numpy(text).astype("<u4", copy=False).tobytes()

    def of_words(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of sure texts: each different word of them all is encoded once."""
        data = np.frombuffer("\n".join(["", *texts, "", ""]).lower().encode(), np.uint8)
        shown, ends, places = words_of(data)
        if not len(ends):
            yield from [b""] * len(texts)
            return
        bounds = pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64))
        words = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, bounds, pa.py_buffer(shown)]).dictionary_encode()
        _, bounds, different = words.dictionary.buffers()
        bounds = np.frombuffer(bounds, np.int64, len(words.dictionary) + 1)
        marked = np.insert(np.frombuffer(different, np.uint8, bounds[-1]), bounds[1:], ord(END))
        known = self.core.encode_to_numpy(marked.tobytes().decode()).astype("<u4", copy=False)
        behind = np.flatnonzero(self.ends[known]) + 1  # of each different word's ids
        first = np.concatenate([[0], behind[:-1]])
        which = words.indices.to_numpy()
        count = (behind - first)[which]
        upto = np.concatenate([[0], np.cumsum(count)])
        flat = known[np.repeat(first[which] - upto[:-1], count) + np.arange(upto[-1])]
        size = np.cumsum([1 + len(t.encode()) for t in texts])
        cut = upto[np.searchsorted(places, np.concatenate([[0], size]))].tolist()
        for a, b in zip(cut, cut[1:], strict=False):
            yield flat[a:b].tobytes()


@lru_cache(maxsize=4)
def encoder(name: str, special_as_text: bool = False) -> Encoder:
    """The encoder of a tokenizer file, one per Python worker; its size does not depend on the texts."""
    if not name.startswith(("byte_bpe", "word_bpe")):
        raise ValueError(f"no rule for cutting texts of {name}")
    return Encoder(name, special_as_text)
