"""Quality rules per document, and verdicts per host.

Rule failures are summed by host, rates are shrunk towards a beta prior that is fitted to the hosts themselves, and a
host with a shrunk rate over the limit is rejected together with its documents. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import BLANK, NOT_BLANK, fresh, stored, text_or_empty, without

FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
WINDOW = 3
RATE_LIMIT = 0.5
# Bounds of the prior's weight, in documents: hosts that all have one rate would make it infinite.
PRIOR_WEIGHT = (1.0, 1000.0)


def features(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows with the counts named in FEATURES and `n_lines`, lines with a word; null texts count as empty."""
    given = without(df, *FEATURES, "n_lines")
    t, words, lines, hashes, windows, repeats = (
        fresh(c, given.columns) for c in ("t", "words", "lines", "hashes", "windows", "repeats"))
    names = given.columns
    rows = given.withColumn(t, text_or_empty(text)).withColumns({
        words: F.filter(F.split(t, f"{BLANK}+"), lambda w: w != ""),
        lines: F.filter(F.split(t, "\n"), lambda x: x.rlike(NOT_BLANK)),
        "word_chars": F.length(F.regexp_replace(t, f"{BLANK}+", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(t, "[^#*$%&|<>]+", "")).cast("long"),
    })
    rows = rows.withColumns({
        "n_words": F.size(words).cast("long"),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        hashes: F.transform(words, lambda w: F.xxhash64(w)),
    })
    h = F.col(hashes)
    # Windows of three words as (hash, place), sorted so that equal ones meet; then the places of those which recur.
    window = lambda i: F.struct(F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]).alias("h"), i.alias("i"))
    rows = rows.withColumn(windows, F.when(
        F.size(h) >= WINDOW, F.sort_array(F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW), window))))
    w = F.col(windows)
    meets = lambda x, k: F.coalesce(F.get(w, k)["h"] == x["h"], F.lit(False))
    recurring = F.filter(w, lambda x, k: (k > 0) & meets(x, F.greatest(k - 1, F.lit(0))) | meets(x, k + 1))
    rows = rows.withColumn(repeats, F.sort_array(F.transform(recurring, lambda x: x["i"])))
    r = F.col(repeats)
    covered = F.transform(r, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(r, k + 1) - x, F.lit(WINDOW))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.withColumn("n_repeat_words", F.coalesce(total, F.lit(0).cast("long"))).select(
        *names, *FEATURES, "n_lines")


def failures() -> dict[str, Column]:
    """The rules; the first two are the base rules."""
    return {
        "short": F.col("n_words") < 50,
        "repetitive": F.col("n_repeat_words") * 100 > F.col("n_words") * 50,
        "symbols": F.col("n_symbols") * 10 > F.col("n_words"),
        "lines": F.col("n_dup_lines") * 10 > F.col("n_lines") * 3,
    }


def host_verdicts(rows: DataFrame, host: str) -> DataFrame:
    """(host, n_docs, host_rejected, rate_<rule>) per host that is not null.

    The prior of a rule has the overall rate as its mean; its weight follows from the spread of the hosts' rates by the
    method of moments. Hosts of few documents stay near the prior.
    """
    rules = failures()
    hosts = rows.filter(F.col(host).isNotNull()).groupBy(host).agg(
        F.count(F.lit(1)).alias("n_docs"), *[F.sum(f.cast("long")).alias(f"f_{r}") for r, f in rules.items()])
    moments = hosts.agg(*[
        e for r in rules for e in (
            (F.sum(f"f_{r}") / F.sum("n_docs")).alias(f"m_{r}"),
            F.var_pop(F.col(f"f_{r}") / F.col("n_docs")).alias(f"v_{r}"))
    ]).first()
    rates = []
    for r in rules:
        mean, spread = moments[f"m_{r}"] or 0.0, moments[f"v_{r}"] or 0.0
        low, high = PRIOR_WEIGHT
        weight = min(high, max(low, mean * (1 - mean) / spread - 1)) if spread > 0 else high
        rates.append(((F.col(f"f_{r}") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight))).alias(f"rate_{r}"))
    shrunk = hosts.select(host, "n_docs", *rates)
    return shrunk.withColumn("host_rejected", F.greatest(*[f"rate_{r}" for r in rules]) > RATE_LIMIT)


def judged(
    df: DataFrame, text: str = "text", host: str = "source", keep: list[str] | None = None,
) -> DataFrame:
    """The rows with FEATURES, `n_lines`, `base_failed`, `host_rejected` and `kept`.

    A document is kept if it passes the base rules and its host is not rejected; one with a null host is judged by the
    base rules alone. Null and empty texts have no words and fail. Repeated rows count as often as they stand there. An
    empty table stays empty. Input columns of those names are replaced. `keep`: the input columns to return (the host
    among them), all by default.
    """
    added = ("base_failed", "host_rejected", "kept")
    given = without(df, *added)
    rows = features(given, text)
    rows = stored(rows.drop(*[c for c in given.columns if keep is not None and c not in keep]))
    rules = failures()
    key = fresh("key", rows.columns)
    verdicts = host_verdicts(rows, host).select(F.col(host).alias(key), "host_rejected")
    joined = rows.join(verdicts, F.col(host) == F.col(key), "left").drop(key)
    return joined.withColumns({
        "base_failed": rules["short"] | rules["repetitive"],
        "host_rejected": F.coalesce("host_rejected", F.lit(False)),
    }).withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
