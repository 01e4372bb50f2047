"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tallyhouse.llm.host_quality import PRIOR_WEIGHT, RATE_LIMIT

RULES = {
    "short": "n_words < 50", "repetitive": "100 * n_repeat_words > 50 * n_words", "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
}


def rate(rule: str) -> tuple[str, str]:
    """A rule's shrunk rate, and the weight of its prior."""
    low, high = PRIOR_WEIGHT
    return f"(f_{rule} + m_{rule} * w_{rule}) / (n_docs + w_{rule})", (
        f"CASE WHEN v_{rule} > 0 THEN least({high}, greatest({low}, m_{rule} * (1 - m_{rule}) / v_{rule} - 1)) "
        f"ELSE {high} END AS w_{rule}")


TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

LEXICAL_SEARCH = f"""
WITH terms AS (
    SELECT doc_id, unnest({TERMS}) AS term
    FROM documents),
counted AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM counted GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM sizes),
lengths AS (SELECT doc_id, 100 - 50 + (50 * n * docs) // words AS m FROM sizes, totals),
wanted AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term
    FROM benchmark),
weights AS (SELECT term, floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
    FROM counted, totals WHERE term IN (SELECT term FROM wanted) GROUP BY term),
scores AS (
    SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN counted USING (term) JOIN lengths USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
    FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

HOST_QUALITY = rf"""
WITH split AS (
    SELECT row_number() OVER () AS n, doc_id, source, coalesce(text, '') AS t,
           list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
           list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT n, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
    FROM (SELECT n, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), recurring AS (
    SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY n, w) AS c FROM windows) WHERE c > 1
), covered AS (
    SELECT n, sum(step) AS n_repeat_words FROM (
        SELECT n, least(3, coalesce(lead(i) OVER (PARTITION BY n ORDER BY i) - i, 3)) AS step FROM recurring)
    GROUP BY n
), rows AS (
    SELECT split.n, doc_id, source, len(words) AS n_words,
           length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
           len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM split LEFT JOIN covered USING (n)
), hosts AS (
    SELECT source, count(*) AS n_docs, {", ".join(f"sum(({c})::INT) AS f_{r}" for r, c in RULES.items())}
    FROM rows WHERE source IS NOT NULL GROUP BY source
), moments AS (
    SELECT {", ".join(f"sum(f_{r}) / sum(n_docs) AS m_{r}, var_pop(f_{r} / n_docs) AS v_{r}" for r in RULES)} FROM hosts
), prior AS (
    SELECT *, {", ".join(rate(r)[1] for r in RULES)} FROM moments
), verdicts AS (
    SELECT source, greatest({", ".join(rate(r)[0] for r in RULES)}) > {RATE_LIMIT} AS rejected FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({RULES["short"]} OR {RULES["repetitive"]}) AS base_failed,
       NOT ({RULES["short"]} OR {RULES["repetitive"]}) AND NOT coalesce(rejected, FALSE) AS kept
FROM rows LEFT JOIN verdicts USING (source)
"""

SQL: dict[str, str] = {"op2_host_quality": HOST_QUALITY, "op13_lexical_search": LEXICAL_SEARCH}


def all_sql() -> dict[str, str]:
    return dict(SQL)
