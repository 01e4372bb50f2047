import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import FOLDER, by_id, docs, given_documents
from pyspark.sql import functions as F

from tallyhouse.llm import suffix_dedup as S
from tallyhouse.llm.queries import all_queries


def plain(texts, length=S.LENGTH):
    """(bytes kept, runs removed) per text, by counting all strings."""
    seen = Counter(hash(t[i : i + length]) for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if seen[hash(t[i : i + length])] > 1:
                gone[1 + i : 1 + i + length] = True
        out.append((bytes(b for b, g in zip(t, gone[1:], strict=False) if not g), int((gone[1:] & ~gone[:-1]).sum())))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.integers(1, 12))
def test_shared_prefixes(symbols, length):
    t = np.array([*symbols, 0], np.int64)
    n = len(t)
    strings = Counter(tuple(t[(i + np.arange(length)) % n]) for i in range(n))
    want = [strings[tuple(t[(i + np.arange(length)) % n])] > 1 for i in range(n)]
    assert S.shared_prefixes(t, length).tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["abcab", "aaaa", "xyzzy q", "0123456789"]), st.integers(1, 30)), min_size=1, max_size=8))
def test_block_spans(parts):
    segments = list({(p * n).encode() + b"#" * 45 for p, n in parts})
    spans = S.block_spans(segments, [1] * len(segments), 40)
    seen = Counter(s[i : i + 40] for s in segments for i in range(len(s) - 39))
    for s, own in zip(segments, spans, strict=True):
        flags = {i for a, b in own for i in range(a, b)}
        assert flags == {i for i in range(len(s) - 39) if seen[s[i : i + 40]] > 1}


def test_runs_cover_all_starts_and_equal_strings_share_an_anchor(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 700)
    rng = random.Random(3)
    text = bytes(rng.choices(b"abc ", k=3000)) + b"z" * 900
    text += text[100:1400]
    anchors, first, count, place = (np.concatenate(x) for x in zip(*S.runs(text), strict=True))
    assert ((place >= first + count - 1) & (place + S.GRAM <= first + 400)).all()
    assert first[0] == 0 and (first[1:] == first[:-1] + count[:-1]).all() and first[-1] + count[-1] == len(text) - 399
    by = {}
    for a, f, c in zip(anchors.tolist(), first.tolist(), count.tolist()):
        for i in range(f, f + c):
            assert by.setdefault(text[i : i + 400], a) == a


def removed(spark, texts):
    rows = by_id(S.deduplicated(docs(spark, *texts)))
    for i, t in enumerate(texts):  # the ranges are those of the bytes kept
        gone = {k for r in rows[i]["removed"] for k in range(r["start"], r["end"])}
        assert bytes(b for k, b in enumerate(t.encode()) if k not in gone) == bytes(rows[i]["kept_bytes"])
    return [(bytes(rows[i]["kept_bytes"]), rows[i]["n_spans"]) for i in range(len(texts))]


def test_equal_segments_of_a_text_are_told_at_once(monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 5000)
    text = b"z" * 20_000
    found, again = S.own_runs(text, 400)
    assert len(found) < 10 and again == [(0, 20_000 - 399)]
    rng = random.Random(1)
    line = bytes(rng.choices(range(97, 123), k=900))
    text = line + b"#" + line + b"?" + bytes(rng.choices(range(97, 123), k=900))
    found, again = S.own_runs(text, 400)
    starts = sum(f[2] * f[4] for f in found)
    assert starts == len(text) - 399 and again and all(b <= 901 + 501 for _, b in again)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6))
def test_halves_keep_every_pair_with_a_common_string(seed):
    rng = random.Random(seed)
    anchor, segments, places = bytes(rng.choices(b"xyz", k=32)), [], []
    sides = [bytes(rng.choices(b"ab", k=300)) for _ in range(2)]
    for _ in range(6):
        left, right = (bytearray(s) for s in sides)
        left[rng.randrange(300)] ^= 1
        right[rng.randrange(300)] ^= 1
        a, b = rng.randint(0, 300), rng.randint(0, 300)
        segments.append(bytes(left[300 - a :]) + anchor + bytes(right[:b]))
        places.append(a)
    goes = S.half_shared(segments, places, 200)
    strings = [{(i - p, s[i : i + 200]) for i in range(max(0, p + 32 - 200), min(p, len(s) - 200) + 1)} for s, p in zip(segments, places, strict=True)]
    for i in range(6):
        if any(strings[i] & strings[j] for j in range(6) if j != i):
            assert goes[i]
    keys = {}  # every string is in a part, and equal ones meet under one key
    for s, p in zip(segments, places, strict=True):
        if len(s) < 200:
            continue
        parts = list(S.sides(7, p, s, 200))
        assert {k for _, a, b, _ in parts for k in range(a, b + 1)} == set(range(len(s) - 199))
        for key, a, b, own in parts:
            assert own == p - a
            for k in range(max(a, p - 168), min(b, p) + 1):  # strings that hold the anchor
                keys.setdefault((k - p, s[k : k + 200]), set()).add(key)
    assert all(len(k) <= 2 for k in keys.values())
    middle = [k for (at, _), k in keys.items() if at != -84]
    assert all(len(k) == 1 for k in middle)


@pytest.mark.parametrize("segments", [6000, 3])
def test_against_all_strings(spark, monkeypatch, segments):
    monkeypatch.setattr(S, "SEGMENTS", segments)
    rng = random.Random(segments)
    word = lambda: "".join(rng.choices("abcdé ", k=rng.randint(2, 9)))
    base = ["".join(word() for _ in range(200)) for _ in range(4)]
    texts = [*base, base[0], "y" * 1000, "xy" * 300, "z" * 399, "w" * 400]
    for _ in range(25):
        own = "".join(word() for _ in range(90))
        b = rng.choice(base)
        at = rng.randrange(len(b) - 500)
        texts.append(own[:200] + b[at : at + rng.randint(300, 500)] + own[200:] + base[1][:450])
    assert removed(spark, texts) == plain([t.encode() for t in texts])


def test_query(spark):
    rows = by_id(all_queries()["op3_suffix_dedup"](spark, FOLDER))
    given_rows = given_documents()
    want = plain([(t or "").encode() for _, t in given_rows])
    assert len(rows) == len(given_rows)
    for (i, t), (kept, n) in zip(given_rows, want, strict=True):
        data = (t or "").encode()
        assert (rows[i]["n_bytes"], rows[i]["n_removed"], rows[i]["n_spans"]) == (len(data), len(data) - len(kept), n)
        assert rows[i]["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_nulls_names_and_empty_tables(spark):
    names = ["digest", "data", "spans", "found_digest", "cut", "removed", "anchor", "segment", "copies", "runs"]
    df = docs(spark, None, "", "é" * 500, "a" * 10, ids=[None, 1, 2, 3]).withColumns({n: F.lit(1) for n in names})
    rows = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.digest, r.spans, r.cut) for r in S.deduplicated(df).collect()}
    assert rows == {None: (0, 0, 0, 1, 1, 1), 1: (0, 0, 0, 1, 1, 1), 2: (1000, 1000, 1, 1, 1, 1), 3: (10, 0, 0, 1, 1, 1)}
    assert S.deduplicated(df.limit(0)).count() == 0


def test_a_long_text_of_one_byte(spark):
    text = "z" * (3 * S.CHUNK // 2)
    row = S.deduplicated(docs(spark, text, "z" * 450 + "y", "only once " * 9)).orderBy("doc_id").collect()
    assert [(r.n_removed, r.n_spans) for r in row] == [(len(text), 1), (450, 1), (0, 0)]
