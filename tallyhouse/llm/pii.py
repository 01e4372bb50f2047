"""Personal data: patterns propose spans, checksums confirm them, context words near them adjust their score."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.llm.common import fresh, without

# Kinds in the order in which spans of one start are listed; the first four are kept whatever their score.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ssn")
CONTEXT_CHARS = 48
KEEP = 0.5

SPAN_TYPE = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("score", T.DoubleType()), T.StructField("base", T.BooleanType()),
]))
SPAN_ARROW = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("base", pa.bool_()),
]))


def digits_of(text: str) -> list[int]:
    return [ord(c) - 48 for c in text if "0" <= c <= "9"]


def luhn(text: str) -> bool:
    """Whether the digits pass the Luhn check."""
    total = 0
    for i, d in enumerate(reversed(digits_of(text))):
        d = d * 2 if i % 2 else d
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(text: str) -> bool:
    """Whether an account number passes the check of ISO 7064 (remainder 1 by 97)."""
    plain = text.replace(" ", "")
    moved = plain[4:] + plain[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def card_ok(text: str) -> bool:
    return 12 <= len(digits_of(text)) <= 19 and luhn(text)


def phone_ok(text: str) -> bool:
    return 9 <= len(digits_of(text)) <= 15


def ip_ok(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def iban_ok(text: str) -> bool:
    return 15 <= len(text.replace(" ", "")) <= 34 and mod97(text)


# Characters of an account number by country.
IBAN_LENGTHS = {code: int(n) for n, codes in (line.split(":") for line in """
15:NO;16:BE;18:DK FI FO GL NL SD;19:MK SI;20:AT BA EE KZ LT LU MN XK;21:CH HR LI LV;22:BG BH CR DE GB GE IE ME RS VA;
23:AE GI IL IQ OM SO TL;24:AD CZ ES MD PK RO SA SE SK TN VG;25:LY PT ST;26:IS TR;27:BI DJ FR GR IT MC MR SM;
28:AL AZ BY CY DO GT HU LB NI PL SV;29:BR EG PS QA UA;30:JO KW MU;31:MT SC;32:LC;33:RU
""".replace("\n", "").split(";")) for code in codes.split()}


def iban_end(text: str) -> int:
    """Where the account number that a match begins with ends, 0 if it holds none.

    A word in capitals or a figure behind it looks like one more group, so the number may end at every blank: where its
    country's length says if that passes the check, else at the last place that passes.
    """
    ends = [m.start() for m in re.finditer(" |$", text)]
    of_country = [e for e in ends if len(text[:e].replace(" ", "")) == IBAN_LENGTHS.get(text[:2])]
    return next((e for e in [*of_country, *reversed(ends)] if iban_ok(text[:e])), 0)


def ssn_ok(text: str) -> bool:
    area, group, serial = text.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


@dataclass(frozen=True)
class Rule:
    """A kind's pattern, the character or pair a text must hold for it, its check and the words that bear on it."""

    kind: str
    pattern: re.Pattern
    needs: str
    check: Callable[[str], bool] | None
    prior: float
    confirmed: float
    words: tuple[str, ...]


# The patterns of the four base kinds. That of an email address is matched from its "@" on, and that of an
# ip address only where a run of digits begins: the same matches, but in linear time.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
RULES = (
    Rule("email", re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), "@", None, 0.8, 0.0,
         ("mail", "email", "contact", "write")),
    Rule("ip", re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"), ".", ip_ok, 0.4, 0.1,
         ("ip", "address", "host", "server", "from")),
    Rule("card", re.compile(r"[0-9]([\x20-]?[0-9])+"), "", card_ok, 0.3, 0.3,
         ("card", "visa", "mastercard", "credit", "debit", "payment", "karte", "carte", "tarjeta")),
    Rule("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), "+", phone_ok, 0.5, 0.1,
         ("phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono")),
    Rule("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"), "", iban_ok, 0.3, 0.5,
         ("iban", "account", "bank", "konto", "compte", "cuenta")),
    Rule("ssn", re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), "-", ssn_ok, 0.2, 0.1,
         ("ssn", "social", "security", "taxpayer")),
)
AGAINST = ("example", "sample", "test", "version", "order", "invoice", "isbn", "article")
WORD = re.compile(r"[^\W\d_]+")
DIGIT = re.compile(r"[0-9]")


def matches(rule: Rule, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches that do not overlap and pass the rule's check."""
    free = 0
    if rule.kind == "iban":
        while m := rule.pattern.search(text, free):
            end = m.start() + iban_end(m[0])
            if end > m.start():
                yield m.start(), end
            free = max(end, m.start() + 1)  # what lies behind the number, or within a match without one, may hold another
        return
    for m in rule.pattern.finditer(text):
        start = m.start()
        if rule.kind == "email":
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start == m.start():
                continue
            free = m.end()
        elif not rule.check(m[0]):
            continue
        yield start, m.end()


def context_score(rule: Rule, text: str, start: int, end: int) -> float:
    """0.3 for a word of the kind nearby, -0.2 for one that speaks against personal data."""
    near = text[max(0, start - CONTEXT_CHARS) : start] + " " + text[end : end + CONTEXT_CHARS]
    words = {w.lower() for w in WORD.findall(near)}
    return 0.3 * any(w in words for w in rule.words) - 0.2 * any(w in words for w in AGAINST)


def find(text: str | None) -> list[dict]:
    """All spans of a text, by start, then kind; places are code points, the end exclusive.

    Matches of a kind are leftmost and do not overlap; one that fails its check is dropped and not tried shorter, but for
    account numbers (iban), which end where the check says.
    """
    out: list[tuple] = []
    if not text:
        return []
    with_digits = DIGIT.search(text) is not None
    for order, rule in enumerate(RULES):
        if rule.needs not in text or (rule.kind != "email" and not with_digits):
            continue
        for start, end in matches(rule, text):
            score = rule.prior + rule.confirmed + context_score(rule, text, start, end)
            if rule.kind in BASE or score >= KEEP:
                out.append((start, order, end, rule.kind, min(1.0, max(0.0, score))))
    return [
        {"kind": kind, "start": start, "end": end, "score": score, "base": kind in BASE}
        for start, _, end, kind, score in sorted(out)
    ]


@F.arrow_udf(SPAN_TYPE)
def spans_of(text: pa.Array) -> pa.Array:
    return pa.array([find(t.as_py()) for t in text], SPAN_ARROW)


def blotted(text: str, spans: list[dict] | None) -> str:
    """The text with each span, overlapping ones as one, replaced by the first one's kind in angle brackets."""
    out, at, n = [], 0, 0
    while spans and n < len(spans):
        start, end, kind = spans[n]["start"], spans[n]["end"], spans[n]["kind"]
        n += 1
        while n < len(spans) and spans[n]["start"] < end:
            end = max(end, spans[n]["end"])
            n += 1
        out += [text[at:start], f"<{kind.upper()}>"]
        at = end
    return "".join(out) + text[at:]


@F.arrow_udf(T.StringType())
def blotted_of(text: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array([t.as_py() and blotted(t.as_py(), s.as_py()) for t, s in zip(text, spans, strict=True)], pa.string())


def with_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with `pii_spans`: (kind, start, end, score, base) in order.

    Null and empty texts have an empty list; repeated rows have equal lists; an empty table stays empty. An input
    column named pii_spans is replaced. Texts of any length are searched whole.
    """
    rows = without(df, "pii_spans")
    return rows.withColumn("pii_spans", spans_of(F.col(text)))


def redacted(df: DataFrame, text: str = "text") -> DataFrame:
    """The same columns, personal data in the text replaced by its kind; null texts stay null."""
    name = fresh("spans", df.columns)
    spans = df.withColumn(name, spans_of(F.col(text)))
    return spans.withColumn(text, F.when(F.size(name) > 0, blotted_of(text, name)).otherwise(F.col(text))).drop(name)


def listed(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    one = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", one)
