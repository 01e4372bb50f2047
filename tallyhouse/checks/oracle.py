"""The SQL that checks each query, in DuckDB, over the same derived tables.

Written from the meaning of each operator, not from its Spark form: merges are unions of
updated, kept and inserted rows, corrections are chains of SELECT * REPLACE.
"""

from __future__ import annotations

from tallyhouse.checks.queries import ALTERED, COLLECTION_STEP_COLUMNS, DIMENSION_MAP, LANDING_MAP, LOAN_STEP_COLUMNS, PAYMENT_STEP_COLUMNS
from tallyhouse.sources import schemas as S
from tallyhouse.sources.derived import BASE_TABLES, END, NOW, START, TABLES, TARGET_TYPES, TYPES, inputs

A, B, N = (f"TIMESTAMP '{t}'" for t in (START, END, NOW))
TODAY = f"CAST({N} AS DATE)"
ITEM = "payment_schedule_item_id"
ACTIVE = "('Originated', 'Delinquent', 'DEFAULT')"
WITHDRAWABLE = "('Approve', 'Bank QA Error', 'Pending', 'Pending Bank Approval', 'QA Error', 'Void')"
COLLECTED = "('Cleared', 'SENT')"
MONEY = "DECIMAL(38,2)"

SQL: dict[str, str] = {}


def _closure(texts: list[str]) -> list[str]:
    """Derived tables the texts read, each after the ones it reads itself."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in order:
            return
        for inner in inputs(TABLES[name]):
            visit(inner)
        order.append(name)

    for text in texts:
        for name in inputs(text):
            visit(name)
    return order


def add(key: str, final: str, columns: str | list[str], *steps: tuple[str, str]) -> None:
    """Register SQL; steps named once_... are computed once. `columns` are the result's; `name:d` is handed out as double, `name:t` as
    timestamp, and so are columns whose declared type is a decimal or a date."""
    def shown(column: str) -> str:
        name, _, form = column.partition(":")
        types = {TYPES.get(name, ""), TARGET_TYPES.get(name, "")}
        if form == "d" or not form and any(t.startswith("decimal") for t in types):
            return f'CAST("{name}" AS DOUBLE) AS "{name}"'
        if form == "t" or not form and "date" in types:
            return f'CAST("{name}" AS TIMESTAMP) AS "{name}"'
        return f'"{name}"'

    columns = columns.split() if isinstance(columns, str) else columns
    ctes = [(name, TABLES[name]) for name in _closure([text for _, text in steps] + [final])] + list(steps)
    body = f"SELECT {', '.join(shown(c) for c in columns)} FROM ({final}) r"
    if ctes:
        body = "WITH " + ", ".join(f"{name} AS {'MATERIALIZED ' if name.startswith('once_') else ''}({text})" for name, text in ctes) + " " + body
    for name in (*BASE_TABLES, *TABLES):
        body = body.replace(f"{{{name}}}", name)
    SQL[key] = body.replace("timestamp_ntz", "timestamp")


def in_window(column: str) -> str:
    return f"({column} > {A} AND {column} <= {B})"


def merge(target: str, source: str, keys: list[str], columns: list[str], written: list[str], insert_only=(), op: str | None = None) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    taken = [f"s.{c}" if c in written and c not in insert_only and c not in keys else f"t.{c}" for c in columns]
    new = [f"s.{c}" if c in written else f"NULL AS {c}" for c in columns]

    def tag(kind: str) -> str:
        return f", '{kind}' AS {op}" if op else ""

    return (
        f"SELECT {', '.join(taken)}{tag('update')} FROM {target} t JOIN {source} s ON {on} "
        f"UNION ALL SELECT {', '.join('t.' + c for c in columns)}{tag('keep')} FROM {target} t WHERE NOT EXISTS (SELECT 1 FROM {source} s WHERE {on}) "
        f"UNION ALL SELECT {', '.join(new)}{tag('insert')} FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM {target} t WHERE {on})"
    )


def step(previous: str, condition: str, changes: dict[str, str], joins: str = "") -> str:
    replaced = ", ".join(f"CASE WHEN {condition} THEN {value} ELSE t.{c} END AS {c}" for c, value in changes.items())
    return f"SELECT t.* REPLACE ({replaced}) FROM {previous} t {joins}"


def chain(start: str, steps: list[tuple]) -> tuple[list[tuple[str, str]], str]:
    """Steps as CTEs, each over the one before: (CTEs, name of the last)."""
    ctes, previous = [], start
    for i, (condition, changes, *joins) in enumerate(steps):
        ctes.append((f"step{i}", step(previous, condition, changes, joins[0] if joins else "")))
        previous = f"step{i}"
    return ctes, previous


def money(column: str) -> str:
    return f"CAST(NULLIF(TRIM(REPLACE({column}, ',', ''), '$'), '') AS {MONEY})"


# --- sources and sinks ------------------------------------------------------------------------

add("scan_landing", "SELECT * FROM {lms_base_loans}", S.names("lms_base_loans"))
add("scan_rdbms_window", f"SELECT * FROM {{lms_base_loans}} WHERE created_datetime > {A} AND created_datetime < {B}", S.names("lms_base_loans"))
DIM_LOAN = [*S.DIM_LOAN, *S.DIM_LOAN_LATER]
add("scan_target_window", f"SELECT * FROM {{dim_loan}} WHERE created_datetime > {A} AND created_datetime < {B}", DIM_LOAN)
CDC = ["_SNOWFLAKE_INSERTED_AT", "_SNOWFLAKE_UPDATED_AT", "_SNOWFLAKE_DELETED"]
add("scan_add_cdc_columns", f"SELECT *, {', '.join(f'{chr(39)}{chr(39)} AS {c}' for c in CDC)} FROM {{lms_loanheader_state}}",
    [*S.names("lms_loanheader_state"), *CDC])

COUNT_COLUMNS = "target_table source_count target_count count_match"


def counted(label: str, source: str, target: str) -> str:
    return (
        f"SELECT {label}, (SELECT count(*) FROM {source}) AS source_count, (SELECT count(*) FROM {target}) AS target_count"
    )


def with_match(rows: list[str], more: str = "") -> str:
    return f"SELECT *, CASE WHEN source_count = target_count THEN 'Match' ELSE 'Mismatch' END AS count_match{more} FROM ({' UNION ALL '.join(rows)}) c"


def _landing_counts(label) -> list[str]:
    rows = []
    for name, column in LANDING_MAP.items():
        where = f" WHERE {column} > {A} AND {column} < {B}" if column else ""
        cut = f"{where} AND {column} <= TIMESTAMP '1999-06-30 00:00:00'" if column else ""
        rows.append(counted(label(name), f"{{{name}}}{where}", f"{{{name}}}{cut}"))
    return rows


_QUERY_COUNTS = with_match([
    counted(f"'dwh.{name}' AS target_table", source, f"{{{name}}}") for name, source in {
        "dim_insurance_protection_plan": "{protection_plan} pp JOIN {insurance_policy} ip ON pp.policy_id = ip.id JOIN {insurance_provider} ir ON ip.insurance_provider_id = ir.id",
        "dim_insurance_protection_plan_status": "{protection_plan_status} ps JOIN {protection_plan_status_log} pl ON ps.protection_plan_status_log_id = pl.id",
        "fct_collection_detail": "{collection_lms_loan_map} m JOIN {collections} c ON c.collection_id = m.collection_id",
        "dim_payment_schedule": "{lms_payment_schedules} p JOIN {lms_base_loans} b ON p.base_loan_id = b.base_loan_id JOIN {lms_customer_info_flat} c ON b.customer_id = c.customer_id JOIN {lms_payment_schedule_items} i ON p.payment_schedule_id = i.payment_schedule_id",
        "dim_customer": "{lms_customer_info_flat} c JOIN {upm_organizations} o ON c.organization_id = o.organization_id",
        "dim_loan": "{lms_base_loans} b JOIN {lms_loan_header} h ON b.loan_header_id = h.loan_header_id",
    }.items()
])
add("config_table_map", with_match(_landing_counts(lambda n: f"'landing.{n}' AS target_table")), COUNT_COLUMNS)
for _key in ("config_query_vs_table", "recon_query_vs_table", "sink_csv_report"):
    add(_key, _QUERY_COUNTS, COUNT_COLUMNS)
add("recon_landing_summary",
    with_match(_landing_counts(lambda n: f"'source.{n}' AS source_table, 'landing.{n}' AS target_table"), ", 'Match' AS schema_match"),
    "source_table target_table source_count target_count count_match schema_match")

# --- projections and filters --------------------------------------------------------------

add("project_rename", "SELECT *, loan_header_id AS header_id, status AS lms_status FROM {lms_loan_header}", [*S.LOAN_HEADER_PASS, "header_id", "lms_status"])
add("project_literal", "SELECT customer_id, 'JAG' AS lms_code FROM {lms_customer_info_flat}", "customer_id lms_code")
ITEM_TYPE = (
    "CASE WHEN i.item_type IS NOT NULL THEN i.item_type WHEN i.status IS NULL OR i.status IN ('scheduled', 'bypass', 'cancelled') THEN NULL "
    "WHEN i.total_amount < 0 THEN 'C' WHEN i.total_amount >= 0 THEN 'D' END"
)
LOAN_STATUS = f"CASE WHEN h.status = 'Withdraw' AND b.loan_status IN {WITHDRAWABLE} THEN 'Withdraw' ELSE b.loan_status END"
# Cents over hundred-thousandths of a period, rounded half up in whole numbers.
_CENTS = f"CAST({money('c.nmi')} * 100 AS HUGEINT)"
_PERIODS = "CASE c.payfrequency WHEN 'B' THEN 216667 WHEN 'W' THEN 433330 WHEN 'S' THEN 200000 ELSE 100000 END"
_SHARE = f"CAST(((2 * {_CENTS} * 100000 + {_PERIODS}) // (2 * {_PERIODS})) AS DECIMAL(30,0)) * CAST(0.01 AS DECIMAL(3,2))"
PAYCHECK = f"CAST(CASE WHEN {money('c.paycheck_amount')} > 0 THEN {money('c.paycheck_amount')} ELSE CAST({_SHARE} AS {MONEY}) END AS VARCHAR)"
add("case_item_type", f"SELECT {ITEM}, status, {ITEM_TYPE} AS item_type FROM {{lms_payment_schedule_items}} i", f"{ITEM} status item_type")
add("case_loan_status", f"SELECT b.base_loan_id, {LOAN_STATUS} AS loan_status FROM {{lms_base_loans}} b JOIN {{lms_loan_header}} h ON b.loan_header_id = h.loan_header_id", "base_loan_id loan_status")
add("case_paycheck_amount", f"SELECT customer_id, {PAYCHECK} AS paycheck_amount FROM {{lms_customer_info_flat}} c", "customer_id paycheck_amount")
CHANGED = f"({in_window('_snowflake_inserted_at')} OR {in_window('_snowflake_updated_at')})"
add("filter_change_window", f"SELECT * FROM {{lms_payment_schedule_items}} WHERE {CHANGED}", [ITEM, *S.CHANGE_COLUMNS])
add("filter_change_window_two_tables",
    f"SELECT b.base_loan_id, b.loan_header_id, b.updated_datetime, h.last_update FROM {{lms_base_loans}} b JOIN {{lms_loan_header}} h ON b.loan_header_id = h.loan_header_id WHERE {in_window('h.last_update')} OR {in_window('b.updated_datetime')}",
    "base_loan_id loan_header_id updated_datetime last_update")
add("filter_recent_guard", f"SELECT * FROM {{dim_payment_schedule}} WHERE item_date >= {A} OR process_timestamp >= {A}", f"{ITEM} item_date process_timestamp")
SLICE = "CASE WHEN organization_id = 1 THEN 1 WHEN organization_id = 2 THEN 2 WHEN organization_id IN (3, 4) THEN 3 WHEN organization_id >= 5 THEN 4 END"
add("filter_org_slices", f"SELECT {SLICE} AS org_slice, count(*) AS row_count FROM {{lms_customer_info_flat}} GROUP BY 1", "org_slice row_count")
add("filter_in_lists", "SELECT * FROM {lms_payment_schedule_items} WHERE status IN ('MISSED', 'Return') AND payment_mode NOT IN ('ACH')", f"{ITEM} status payment_mode")
add("filter_like", "SELECT * FROM {lms_payment_schedule_items} WHERE payment_mode LIKE '%card%'", f"{ITEM} payment_mode")
add("filter_null_tests", "SELECT * FROM {lms_payment_schedule_items} WHERE payment_failed_date IS NULL AND item_type IS NOT NULL", f"{ITEM} item_type")
for _key, _test in (("filter_divergence", "<>"), ("filter_divergence_null_safe", "IS DISTINCT FROM")):
    add(_key, f"SELECT d.base_loan_id, d.loan_status, b.loan_status AS new_status FROM {{dim_loan}} d JOIN {{lms_base_loans}} b ON d.base_loan_id = b.base_loan_id WHERE d.loan_status {_test} b.loan_status", "base_loan_id loan_status new_status")
add("filter_regex", "SELECT * FROM {dim_customer} WHERE regexp_full_match(grossmonthly, '[0-9.]+')", "customer_id grossmonthly")

# --- joins and lookups -----------------------------------------------------------------------

add("join_inner_lookup", "SELECT c.customer_id, c.organization_id, o.organization_name FROM {lms_customer_info_flat} c JOIN {upm_organizations} o ON c.organization_id = o.organization_id", "customer_id organization_id organization_name")
CHAIN = (
    "{lms_payment_schedules} p JOIN {lms_base_loans} b ON p.base_loan_id = b.base_loan_id "
    "JOIN {lms_customer_info_flat} c ON b.customer_id = c.customer_id JOIN {lms_payment_schedule_items} i ON p.payment_schedule_id = i.payment_schedule_id"
)
add("join_inner_chain", f"SELECT i.{ITEM}, p.payment_schedule_id, p.base_loan_id, c.organization_id FROM {CHAIN}", f"{ITEM} payment_schedule_id base_loan_id organization_id")
LOAN_JOIN = (
    "{lms_base_loans} b JOIN {lms_loan_header} h ON b.loan_header_id = h.loan_header_id LEFT JOIN {lms_entities} e ON h.lms_entity_id = e.lms_entity_id "
    "LEFT JOIN {upm_organizations} o ON e.organization_id = o.organization_id LEFT JOIN {risk_level} r ON h.risk_level_id = r.id"
)
add("join_inner_left_chain", f"SELECT b.base_loan_id, e.entity_name, o.organization_name, r.risk_code FROM {LOAN_JOIN}", "base_loan_id entity_name organization_name risk_code")
add("join_left_then_inner", "SELECT p.id, s.protection_plan_status_log_id, s.base_loan_id FROM {protection_plan} p LEFT JOIN {protection_plan_status_log} l ON p.protection_plan_application_id = l.protection_plan_application_id JOIN {protection_plan_status} s ON l.id = s.protection_plan_status_log_id", "id protection_plan_status_log_id base_loan_id")
add("join_on_extra_predicate", f"SELECT i.{ITEM}, p.base_loan_id FROM {{lms_payment_schedules}} p, {{lms_payment_schedule_items}} i WHERE p.payment_schedule_id = i.payment_schedule_id AND p.is_collections = 1", f"{ITEM} base_loan_id")
add("join_implicit_where", f"SELECT f.collection_id, f.base_loan_id, b.loan_status, m.collection_id AS map_collection_id FROM {{fct_collection_detail}} f, {{lms_base_loans}} b, {{collection_lms_loan_map}} m WHERE f.base_loan_id = b.base_loan_id AND b.base_loan_id = m.base_loan_id AND b.loan_status IN {ACTIVE}", "collection_id base_loan_id loan_status map_collection_id")
PAIRS_GONE = "SELECT f.collection_id, f.base_loan_id FROM {fct_collection_detail} f LEFT JOIN {collection_lms_loan_map} m ON f.collection_id = m.collection_id AND f.base_loan_id = m.base_loan_id WHERE m.collection_id IS NULL"
for _key in ("anti_join_purged", "sink_ctas"):
    add(_key, PAIRS_GONE, "collection_id base_loan_id")
GONE = f"SELECT d.* FROM {{dim_payment_schedule}} d LEFT JOIN {{lms_payment_schedule_items}} i ON d.{ITEM} = i.{ITEM} WHERE i.{ITEM} IS NULL"
NOT_ARCHIVED = f"{GONE} AND d.{ITEM} NOT IN (SELECT {ITEM} FROM {{dim_payment_schedule_removed}})"
add("anti_join_removed", GONE, ITEM)
add("anti_join_double", NOT_ARCHIVED, f"{ITEM} item_date")
ORPHANS = f"SELECT h.* FROM {{lms_loan_header}} h LEFT JOIN {{lms_base_loans}} b ON h.loan_header_id = b.loan_header_id WHERE b.loan_header_id IS NULL AND h.created_date >= {A}"
add("anti_join_orphan_header", f"SELECT CAST(loan_header_id AS VARCHAR) AS column_value FROM ({ORPHANS}) o", "column_value")
add("anti_not_exists", "SELECT b.base_loan_id FROM {lms_base_loans} b WHERE NOT EXISTS (SELECT 1 FROM {loc_fee_structure} f WHERE f.base_loan_id = b.base_loan_id)", "base_loan_id")
add("anti_count_zero", "SELECT r.column_value, r.column_name FROM {reject_log} r WHERE (SELECT count(*) FROM {lms_loan_header} h WHERE CAST(h.loan_header_id AS VARCHAR) = r.column_value) = 0", "column_value column_name")
add("semi_in_subquery", f"SELECT collection_id, base_loan_id FROM {{fct_collection_detail}} WHERE collection_id IN (SELECT collection_id FROM ({PAIRS_GONE}) g)", "collection_id base_loan_id")
add("lookup_latest_by_max_id", "SELECT c.* FROM {lms_collection_cure_info} c JOIN (SELECT base_loan_id, max(lms_collection_cure_info_id) AS id FROM {lms_collection_cure_info} GROUP BY 1) m ON c.base_loan_id = m.base_loan_id AND c.lms_collection_cure_info_id = m.id", "base_loan_id lms_collection_cure_info_id default_time is_cured")
FIRST_OPEN = "SELECT loan_header_id, action_time AS agent_open_time FROM (SELECT *, row_number() OVER (PARTITION BY loan_header_id ORDER BY id) AS place FROM {lms_loanheader_state} WHERE action = 'open') o WHERE place = 1"
add("lookup_first_by_order", FIRST_OPEN, "loan_header_id agent_open_time")
add("topk_first_per_key", "SELECT * FROM {lms_loanheader_state} s WHERE id = (SELECT min(id) FROM {lms_loanheader_state} x WHERE x.loan_header_id = s.loan_header_id)", S.names("lms_loanheader_state"))
HISTORY = "SELECT loan_header_id, max(change_date) FILTER (WHERE to_status = 'Delinquent') AS last_delinquent, max(change_date) FILTER (WHERE to_status LIKE 'DEFAULT%') AS last_default FROM {loan_status_change_history} GROUP BY 1"
add("lookup_correlated_max", HISTORY, "loan_header_id last_delinquent:t last_default:t")
add("lookup_scalar", "SELECT h.loan_header_id, h.campaign_id, CASE WHEN l.lead_source_id IS NULL THEN h.campaign_name ELSE l.description END AS campaign_name FROM {lms_loan_header} h LEFT JOIN {lead_source} l ON h.campaign_id = l.lead_source_id", "loan_header_id campaign_id campaign_name")
add("lookup_eav", f"SELECT {ITEM}, min(value) FILTER (WHERE name = 'subIdTrackingId') AS tracking_id, min(value) FILTER (WHERE name = 'channel') AS channel FROM {{lms_payment_schedule_item_metadata}} GROUP BY 1", f"{ITEM} tracking_id channel")
INDIRECT = "SELECT p.base_loan_id, q.value AS parameter_value FROM {lms_loan_entity_parameters} p JOIN {lms_loan_entity_parameters} q ON p.base_loan_id = q.base_loan_id AND p.value = q.parameter_name WHERE p.parameter_name = 'default_calculation_model' AND q.parameter_name LIKE 'interest%'"
add("lookup_eav_indirect", INDIRECT, "base_loan_id parameter_value")
add("lookup_eav_by_column", "SELECT f.base_loan_id, f.daily_interest_code, p.value AS parameter_value FROM {loc_fee_structure} f JOIN {lms_loan_entity_parameters} p ON f.base_loan_id = p.base_loan_id AND p.parameter_name = f.daily_interest_code", "base_loan_id daily_interest_code parameter_value")

# --- aggregates, order, sets -----------------------------------------------------------------

AMOUNTS = ["total_amount", "amount_fee", "amount_prin", "amount_int", "amount_other"]
_SINCE = f"(i.item_date >= {A} OR i.updated_datetime >= {A})"


def collected(active: bool, parity: bool) -> str:
    where = f"i.item_date <= {A}" if active else (_SINCE if parity else "TRUE")
    having = "" if active or parity else f" HAVING bool_or({_SINCE})"
    sums = ", ".join(f"CAST(sum(i.{a}) AS {MONEY}) AS {a}" for a in AMOUNTS)
    return (
        f"SELECT p.base_loan_id, {sums} FROM {{lms_payment_schedules}} p JOIN {{lms_base_loans}} b ON p.base_loan_id = b.base_loan_id "
        f"JOIN {{lms_payment_schedule_items}} i ON p.payment_schedule_id = i.payment_schedule_id AND p.is_collections = 1 "
        f"WHERE b.loan_status {'' if active else 'NOT '}IN {ACTIVE} AND i.status IN {COLLECTED} AND i.item_type = 'D' AND {where} GROUP BY 1{having}"
    )


add("agg_collected_active", collected(True, False), ["base_loan_id", *AMOUNTS])
add("agg_collected_inactive", collected(False, False), ["base_loan_id", *AMOUNTS])
add("agg_collected_inactive_parity", collected(False, True), ["base_loan_id", *AMOUNTS])
add("agg_max_per_key", "SELECT base_loan_id, max(id) AS max_id FROM {loc_fee_structure} GROUP BY 1", "base_loan_id max_id")
add("agg_min_global", f"SELECT min({ITEM}) AS min_id FROM ({GONE}) g", "min_id")
WATERMARKS = "SELECT job_id, coalesce(max(check_point_end) FILTER (WHERE is_success = 1), TIMESTAMP '2000-01-01 12:00:00') AS watermark FROM {etl_job_batches} GROUP BY 1"
add("agg_watermark", WATERMARKS, "job_id watermark")
add("audit_failure", f"SELECT w.*, CASE WHEN job_id = 2 THEN 0 END AS is_success, CASE WHEN job_id = 2 THEN 'source is not readable' END AS error_message, CASE WHEN job_id = 2 THEN 1 END AS logged FROM ({WATERMARKS}) w", "job_id watermark is_success error_message logged")
add("agg_count_rows", f"SELECT count(*) AS row_count FROM {{dim_loan}} WHERE created_datetime > {A} AND created_datetime < {B}", "row_count")
add("agg_null_counts", " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM {{dim_loan}}" for c in DIM_LOAN), "column_name nulls")
add("dedupe_latest", "SELECT lms_payment_schedule_item_id, max(update_datetime) AS update_datetime FROM {ach_transactions} GROUP BY 1", "update_datetime lms_payment_schedule_item_id")
add("sample_ordered_100", "SELECT * FROM {dim_customer} ORDER BY customer_id LIMIT 100", S.DIM_CUSTOMER)


def difference(left: str, right: str) -> str:
    """Distinct rows whose number of copies differs."""
    copies = "SELECT x AS r, count(*) AS n FROM {%s} x GROUP BY 1"
    return f"SELECT count(*) FROM ({copies % left}) a FULL JOIN ({copies % right}) b ON a.r IS NOT DISTINCT FROM b.r WHERE a.n IS DISTINCT FROM b.n"


for _key, _left, _right in (
    ("canonical_sort_equality", "dim_loan", "dim_loan_copy"),
    ("recon_data_equal", "dim_payment_schedule_removed", "dim_payment_schedule_removed_copy"),
):
    add(_key, f"SELECT n AS differing_rows, CASE WHEN n = 0 THEN 'Match' ELSE 'Mismatch' END AS data_match FROM (SELECT ({difference(_left, _right)}) AS n) d", "differing_rows data_match")
def schemas(*tables: str) -> str:
    """Each table against its copy and its altered copy, from what the engine says of their columns."""
    def described(rows: str, side: str) -> str:
        return f"(SELECT column_name, column_type AS {side}_type FROM (DESCRIBE SELECT * FROM {rows}))"

    def compared(name: str, other: str, rows: str) -> str:
        return (
            f"SELECT '{name}' AS source_table, '{name}_{other}' AS target_table, (SELECT count(*) FROM {{{name}}}) AS source_count, (SELECT count(*) FROM {rows}) AS target_count, "
            "count(source_type) AS source_columns, count(target_type) AS target_columns, count(*) FILTER (WHERE source_type IS NOT NULL AND target_type IS NOT NULL) AS shared_columns, "
            f"count(*) FILTER (WHERE source_type = target_type) AS same_types FROM {described(f'{{{name}}}', 'source')} s FULL JOIN {described(rows, 'target')} d USING (column_name)")

    parts = []
    for name in tables:
        lost, retyped = ALTERED[name]
        exclude = f" EXCLUDE ({', '.join(lost)})" if lost else ""
        replaced = f" REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in retyped)})" if retyped else ""
        parts.append(compared(name, "copy", f"{{{name}_copy}}"))
        parts.append(compared(name, "altered", f"(SELECT *{exclude}{replaced} FROM {{{name}_copy}})"))
    return (
        "SELECT *, CASE WHEN source_columns = shared_columns AND target_columns = shared_columns THEN 'Match' ELSE 'Mismatch' END AS schema_match, "
        "CASE WHEN source_columns = shared_columns AND target_columns = shared_columns AND same_types = shared_columns THEN 'Match' ELSE 'Equivalent' END AS datatype_match "
        f"FROM ({' UNION ALL '.join(parts)}) p")


_SCHEMA = "source_table target_table source_count target_count source_columns target_columns shared_columns same_types schema_match datatype_match"
add("column_set_equality", schemas("dim_customer"), _SCHEMA)
add("recon_schema", schemas("dim_loan", "dim_customer"), _SCHEMA)
add("recon_dtypes", schemas("dim_payment_schedule", "dim_loan"), _SCHEMA)

# --- scalar functions ---------------------------------------------------------------------------

add("clean_money", f"SELECT customer_id, CAST({money('grossmonthly')} AS VARCHAR) AS grossmonthly, {money('nmi')} AS nmi_amount FROM {{lms_customer_info_flat}}", "customer_id grossmonthly nmi_amount:d")
add("divide_round", f"SELECT customer_id, CAST((CAST({money('nmi')} * 100 AS HUGEINT) + 1) // 2 AS DECIMAL(30,0)) * CAST(0.01 AS DECIMAL(3,2)) AS half_amount FROM {{lms_customer_info_flat}}", "customer_id half_amount:d")
add("lower_email", "SELECT customer_id, lower(email) AS email FROM {lms_customer_info_flat}", "customer_id email")
add("date_cast_coalesce", "SELECT b.base_loan_id, CAST(ifnull(b.origination_date, h.origination_timestamp) AS DATE) AS origination_date FROM {lms_base_loans} b JOIN {lms_loan_header} h ON b.loan_header_id = h.loan_header_id", "base_loan_id origination_date")
add("date_add_days", f"SELECT {ITEM}, item_date + 3 AS failed_date FROM {{lms_payment_schedule_items}}", f"{ITEM} failed_date:t")
add("try_timestamp", f"SELECT {ITEM}, return_time, TRY_CAST(return_time AS TIMESTAMP) AS return_at FROM {{funding_payment_return}}", f"{ITEM} return_time return_at")
add("surrogate_key", "SELECT customer_id, md5(coalesce(CAST(customer_id AS VARCHAR), '_dbt_null_') || '-' || coalesce(payfrequency, '_dbt_null_') || '-' || coalesce(lastname, '_dbt_null_')) AS row_key FROM {lms_customer_info_flat}", "customer_id row_key")
add("binary_to_hex", "SELECT customer_id, lower(hex(lastname)) AS lastname_hex FROM {lms_customer_info_flat}", "customer_id lastname_hex")
OUTSTANDING = {
    f"outstanding_{a}_amount": (f"t.{a}_amount" if a == "total" else f"ifnull(t.{a}_amount, 0)") + f" - ifnull(t.collected_{a}_amount, 0)"
    for a in S.AMOUNTS
}
add("arith_outstanding", f"SELECT t.collection_id, t.base_loan_id, {', '.join(f'{v} AS {k}' for k, v in OUTSTANDING.items())} FROM {{fct_collection_detail}} t", ["collection_id", "base_loan_id", *OUTSTANDING])

# --- customers ------------------------------------------------------------------------------------

_CLEAN = {
    "grossmonthly": f"CAST({money('c.grossmonthly')} AS VARCHAR)", "nmi": f"CAST({money('c.nmi')} AS VARCHAR)",
    "paycheck_amount": PAYCHECK, "email": "lower(c.email)", "email2": "lower(c.email2)",
}
CUSTOMERS = (
    f"SELECT {', '.join(f'{_CLEAN.get(n, chr(99) + chr(46) + n)} AS {n}' for n in S.CUSTOMER_PASS)}, 'JAG' AS lms_code, o.organization_name, o.is_active, o.email_domain, {N} AS process_timestamp "
    "FROM {lms_customer_info_flat} c JOIN {upm_organizations} o ON c.organization_id = o.organization_id"
)
_CUSTOMER_MERGE = merge("{dim_customer}", "source", ["customer_id", "lms_code"], S.DIM_CUSTOMER, S.DIM_CUSTOMER, S.INSERT_ONLY["dim_customer"], "op")
_SOURCE = ("source", CUSTOMERS)
add("dim_customer_source", CUSTOMERS, S.DIM_CUSTOMER)
for _key in ("dim_customer_merge", "job_dim_customer"):
    add(_key, _CUSTOMER_MERGE, S.DIM_CUSTOMER, _SOURCE)
add("merge_insert_only_columns", _CUSTOMER_MERGE, "customer_id rent_amount nmi op", _SOURCE)
add("merge_composite_key", _CUSTOMER_MERGE, "customer_id lms_code lastname process_timestamp", _SOURCE)
add("agg_dml_row_count", f"SELECT op, count(*) AS row_count FROM ({_CUSTOMER_MERGE}) m GROUP BY 1", "op row_count", _SOURCE)
add("audit_step_log", f"SELECT 'Merge' AS log_type, 'merge dim_customer' AS log_label, 'Merge succeeded, row count = ' || count(*) AS log_message FROM ({_CUSTOMER_MERGE}) m WHERE op <> 'keep'", "log_type log_label log_message", _SOURCE)

# --- loans -----------------------------------------------------------------------------------------

_LOAN_SPECIAL = {
    "origination_date": "CAST(ifnull(b.origination_date, h.origination_timestamp) AS DATE)", "loan_status": LOAN_STATUS,
    **{n: f"ifnull(h.{n}, 0)" for n in ("is_nc_auto_fund", "is_nc_auto_fund_flow", "is_auto_fund")},
}
LOANS = (
    "SELECT " + ", ".join(f"{_LOAN_SPECIAL.get(n, side + n)} AS {n}" for side, names in (("b.", S.LOAN_BASE_PASS), ("h.", S.LOAN_HEADER_PASS)) for n in names)
    + f", 'JAG' AS lms_code, e.entity_name, e.organization_id, o.organization_name, h.status AS lms_status, r.risk_code, r.description AS risk_level_description, f.agent_open_time, {N} AS process_timestamp "
    + f"FROM {LOAN_JOIN} LEFT JOIN ({FIRST_OPEN}) f ON f.loan_header_id = h.loan_header_id WHERE {in_window('h.last_update')} OR {in_window('b.updated_datetime')}"
)
_LOAN_MERGE = merge("{dim_loan}", "source", ["base_loan_id"], DIM_LOAN, S.DIM_LOAN, S.INSERT_ONLY["dim_loan"])
add("dim_loan_source", LOANS, S.DIM_LOAN)
add("dim_loan_merge", _LOAN_MERGE, DIM_LOAN, ("source", LOANS))

_LINES = f"{{lms_base_loans}} b JOIN {{lms_customer_info_flat}} c ON c.customer_id = b.customer_id JOIN {{lms_loan_header}} h ON b.loan_header_id = h.loan_header_id"
_LINE = f"c.organization_id IN (1, 5, 6, 7) AND b.loan_type = 'loc' AND h.created_date >= {A}"
_FEE = "JOIN {loc_fee_structure} f ON b.base_loan_id = f.base_loan_id JOIN {lms_loan_entity_parameters} p ON b.base_loan_id = p.base_loan_id AND p.parameter_name = f.daily_interest_code"


def _fee_rate(risk: str, ids: str) -> str:
    return f"SELECT b.base_loan_id, p.value AS loan_interest_pct FROM {_LINES} {_FEE} WHERE {_LINE} AND h.risk_level_id {risk} AND f.id = (SELECT max(x.id) FROM {{{ids}}} x WHERE x.base_loan_id = f.base_loan_id)"


S1 = _fee_rate("<> 1", "loc_fee_structure")
S2 = f"SELECT b.base_loan_id, q.parameter_value AS loan_interest_pct FROM {_LINES} JOIN ({INDIRECT}) q ON q.base_loan_id = b.base_loan_id WHERE {_LINE} AND h.risk_level_id = 1 AND b.base_loan_id NOT IN (SELECT base_loan_id FROM {{loc_fee_structure}})"
S3, S3_PARITY = _fee_rate("= 1", "loc_fee_structure"), _fee_rate("= 1", "lms_loan_entity_parameters")
_RATE = "base_loan_id loan_interest_pct:s"
for _key, _sql in (("stg_interest_s1", S1), ("stg_interest_s2", S2), ("stg_interest_s3", S3), ("stg_interest_s3_parity", S3_PARITY)):
    add(_key, _sql, _RATE)
for _key in ("stg_interest_union", "union_distinct_scenarios", "sink_truncate_load"):
    add(_key, f"{S1} UNION {S2} UNION {S3}", _RATE)


def loan_steps(parity: bool, nightly: bool = False) -> dict[str, tuple]:
    third = S3_PARITY if parity else S3
    base = "LEFT JOIN {lms_base_loans} b ON t.base_loan_id = b.base_loan_id"
    header = f"{base} LEFT JOIN {{lms_loan_header}} h ON t.loan_header_id = h.loan_header_id"
    entry = (
        f"{base} LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY base_loan_id ORDER BY update_timestamp DESC, collection_id) AS place "
        "FROM {collection_lms_loan_map}) m WHERE place = 1) m ON b.base_loan_id = m.base_loan_id"
    )
    history = f"{entry} LEFT JOIN ({HISTORY}) s ON s.loan_header_id = t.loan_header_id"
    staged = f"LEFT JOIN (SELECT base_loan_id, max(CAST(loan_interest_pct AS DECIMAL(18,6))) AS rate FROM ({S1} UNION {S2} UNION {third}) u GROUP BY 1) g ON g.base_loan_id = t.base_loan_id"
    processed = f"t.process_timestamp >= {A}"
    status = "b.loan_status" if parity else LOAN_STATUS
    differs = f"b.base_loan_id IS NOT NULL AND h.loan_header_id IS NOT NULL AND (t.lms_status <> h.status OR t.loan_status <> ({status}))"
    copied = {"lms_status": "h.status", "loan_status": status}
    steps = {
        "campaign": (f"{processed} AND t.campaign_id > 0 AND t.campaign_name IS NULL", {"campaign_name": "(SELECT l.description FROM {lead_source} l WHERE l.lead_source_id = t.campaign_id)"}),
        "withdraw": (f"{processed} AND t.lms_status = 'Withdraw' AND t.loan_status IN {WITHDRAWABLE}", {"loan_status": "'Withdraw'"}),
        "status_sync": (f"{processed} AND {differs}", copied, header),
        "status_sync_nightly": (differs, copied, header),
        "withdrawn_ts": (f"{processed} AND t.loan_status = 'Withdraw' AND t.withdrawn_timestamp IS NULL", {"withdrawn_timestamp": "t.last_update"}),
        "amount_sync": ("t.loan_amount <> b.loan_amount", {"loan_amount": "b.loan_amount"}, base),
        "clear_dates": (f"{processed} AND b.loan_status = 'Originated'", {"delinquent_date": "NULL", "default_date": "NULL"}, base),
        "delinquent_date": (f"m.base_loan_id IS NOT NULL AND b.loan_status = 'Delinquent' AND b.updated_datetime >= {A}",
                            {"delinquent_date": "CAST(ifnull(m.delinquency_date, m.create_timestamp) AS DATE)", "default_date": "NULL"}, entry),
        "default_dates": (f"m.base_loan_id IS NOT NULL AND b.loan_status LIKE 'DEFAULT%' AND b.updated_datetime >= {A}",
                          {"delinquent_date": "CAST(ifnull(m.delinquency_date, s.last_delinquent) AS DATE)", "default_date": "CAST(ifnull(m.fully_defaulted_date, s.last_default) AS DATE)"}, history),
        "interest_installment": (f"t.organization_id = 1 AND b.loan_type = 'install' AND b.effective_date >= {A}", {"loan_interest_pct": "b.loan_interest_pct"}, base),
        "interest_loc": ("t.organization_id IN (1, 5, 6, 7) AND t.loan_type = 'loc' AND g.rate IS NOT NULL", {"loan_interest_pct": "g.rate"}, staged),
    }
    return steps if nightly else {k: v for k, v in steps.items() if k != "status_sync_nightly"}


for _name, _step in loan_steps(False, True).items():
    add(f"dim_loan_{_name}", step("{dim_loan}", *_step), list(LOAN_STEP_COLUMNS))
add("update_from_scalar_subquery", step("{dim_loan}", *loan_steps(False)["campaign"]), "base_loan_id campaign_name")
add("dim_loan_status_sync_parity", step("{dim_loan}", *loan_steps(True)["status_sync"]), list(LOAN_STEP_COLUMNS))
add("update_where", step("{dim_loan}", *loan_steps(False)["withdraw"]), "base_loan_id loan_status lms_status process_timestamp")
for _key, _parity in (("job_dim_loan", False), ("job_dim_loan_parity", True)):
    _ctes, _last = chain("merged", list(loan_steps(_parity).values()))
    add(_key, f"SELECT * FROM {_last}", DIM_LOAN, ("source", LOANS), ("merged", _LOAN_MERGE), *_ctes)

REJECT = "table_name column_name column_value reject_reason process_datetime:t is_fixed fixed_date:t"
_ABOUT = "table_name = 'lms_loan_header' AND column_name = 'loan_header_id'"
_NO_HEADER = "column_value NOT IN (SELECT CAST(loan_header_id AS VARCHAR) FROM {lms_loan_header})"
_LOAN_CAME = "column_value IN (SELECT CAST(loan_header_id AS VARCHAR) FROM {lms_base_loans})"


def resolved(condition: str) -> str:
    return f"SELECT * REPLACE (CASE WHEN {condition} THEN 1 ELSE is_fixed END AS is_fixed, CASE WHEN {condition} THEN {TODAY} ELSE fixed_date END AS fixed_date) FROM {{reject_log}}"


add("reject_log_resolve", resolved(f"{_ABOUT} AND is_fixed IS DISTINCT FROM 1 AND ({_NO_HEADER} OR {_LOAN_CAME})"), REJECT)
add("reject_log_resolve_parity", resolved(f"{_ABOUT} AND {_NO_HEADER}"), REJECT)
_NEW_REJECTS = f"SELECT 'lms_loan_header' AS table_name, 'loan_header_id' AS column_name, CAST(loan_header_id AS VARCHAR) AS column_value, 'No base loan record' AS reject_reason, {TODAY} AS process_datetime, NULL AS is_fixed, NULL AS fixed_date FROM ({ORPHANS}) o"
for _key in ("reject_log_orphans_parity", "sink_append"):
    add(_key, f"SELECT * FROM {{reject_log}} UNION ALL {_NEW_REJECTS}", REJECT)
add("reject_log_orphans", f"SELECT * FROM {{reject_log}} UNION ALL SELECT * FROM ({_NEW_REJECTS}) n WHERE column_value NOT IN (SELECT column_value FROM {{reject_log}} WHERE {_ABOUT} AND is_fixed IS DISTINCT FROM 1)", REJECT)

# --- payments --------------------------------------------------------------------------------------

DIM_PAYMENT = [*S.DIM_PAYMENT_SCHEDULE, *S.DIM_PAYMENT_SCHEDULE_LATER]
_PAYMENT_SPECIAL = {
    "item_type": ITEM_TYPE, "payment_failed_date": "CAST(i.payment_failed_date AS TIMESTAMP)",
    "is_active": "ifnull(p.is_active, 0)", "is_collections": "ifnull(p.is_collections, 0)",
}
PAYMENTS = (
    "SELECT " + ", ".join(f"{_PAYMENT_SPECIAL.get(n, side + n)} AS {n}" for side, names in (("i.", S.ITEM_PASS), ("p.", S.SCHEDULE_PASS)) for n in names)
    + f", c.organization_id, {N} AS process_timestamp FROM {CHAIN} WHERE c.organization_id >= 1 AND ({in_window('i._snowflake_inserted_at')} OR {in_window('i._snowflake_updated_at')})"
)
_PAYMENT_MERGE = merge("{dim_payment_schedule}", "source", [ITEM], DIM_PAYMENT, S.DIM_PAYMENT_SCHEDULE, S.INSERT_ONLY["dim_payment_schedule"], "op")
_PAYMENT_SOURCE = ("source", PAYMENTS)
add("payment_source", PAYMENTS, S.DIM_PAYMENT_SCHEDULE)
add("payment_merge", _PAYMENT_MERGE, DIM_PAYMENT, _PAYMENT_SOURCE)
add("merge_sliced", f"SELECT {SLICE} AS org_slice, op, count(*) AS row_count FROM ({_PAYMENT_MERGE}) m WHERE op <> 'keep' GROUP BY 1, 2", "org_slice op row_count", _PAYMENT_SOURCE)
add("audit_step_log_slices",
    "SELECT 'Merge' AS log_type, 'merge slice ' || k || ' dim_payment_schedule' AS log_label, 'Merge succeeded, row count = ' || count(org_slice) AS log_message "
    f"FROM (VALUES (1), (2), (3), (4)) v(k) LEFT JOIN (SELECT {SLICE} AS org_slice FROM ({_PAYMENT_MERGE}) m WHERE op <> 'keep') m ON org_slice = k GROUP BY k",
    "log_type log_label log_message", _PAYMENT_SOURCE)
_ACH = f"LEFT JOIN (SELECT lms_payment_schedule_item_id AS id, max(update_datetime) AS at FROM {{ach_transactions}} GROUP BY 1) x ON x.id = t.{ITEM}"
_FUNDING = f"LEFT JOIN (SELECT {ITEM} AS id, max(TRY_CAST(return_time AS TIMESTAMP)) AS at FROM {{funding_payment_return}} GROUP BY 1) x ON x.id = t.{ITEM}"
_FRESH = f"(t.item_date >= {A} OR t.process_timestamp >= {A})"
_FAILED = f"{_FRESH} AND t.status IN ('Return', 'MISSED') AND t.payment_failed_date IS NULL"
FAILED_DATE = "payment_failed_date"
PAYMENT_STEPS = {
    "failed_clear": (f"{_FRESH} AND t.status IN {COLLECTED} AND t.payment_failed_date IS NOT NULL", {FAILED_DATE: "NULL"}),
    "failed_card": (f"{_FAILED} AND (t.payment_mode = 'NON-ACH' OR t.payment_mode LIKE '%card%')", {FAILED_DATE: "CAST(t.item_date + 3 AS TIMESTAMP)"}),
    "failed_ach": (_FAILED, {FAILED_DATE: "CAST(CAST(x.at AS DATE) AS TIMESTAMP)"}, _ACH),
    "failed_missed": (f"{_FAILED} AND t.status = 'MISSED'", {FAILED_DATE: "CAST(t.item_date AS TIMESTAMP)"}),
    "failed_funding": (_FAILED, {FAILED_DATE: "x.at"}, _FUNDING),
    "auxiliary_sync": (f"t.process_timestamp >= {A} AND i.{ITEM} IS NOT NULL", {"auxiliary_type": "i.auxiliary_type"}, f"LEFT JOIN {{lms_payment_schedule_items}} i ON i.{ITEM} = t.{ITEM}"),
    "tracking_id": (f"t.process_timestamp >= {A} AND x.value IS NOT NULL", {"subid_tracking_id": "x.value"},
                    f"LEFT JOIN (SELECT {ITEM} AS id, min(value) AS value FROM {{lms_payment_schedule_item_metadata}} WHERE name = 'subIdTrackingId' GROUP BY 1) x ON x.id = t.{ITEM}"),
}
for _name, _step in PAYMENT_STEPS.items():
    add(f"payment_{_name}", step("{dim_payment_schedule}", *_step), list(PAYMENT_STEP_COLUMNS))
_ctes, _last = chain("{dim_payment_schedule}", list(PAYMENT_STEPS.values())[:5])
add("payment_failed_cascade", f"SELECT * FROM {_last}", list(PAYMENT_STEP_COLUMNS), *_ctes)
add("update_from_join", step("{dim_payment_schedule}", "t.status IN ('Return', 'MISSED') AND t.payment_failed_date IS NULL", {FAILED_DATE: "CAST(CAST(x.at AS DATE) AS TIMESTAMP)"}, _ACH), f"{ITEM} status payment_failed_date")
_ARCHIVE = f"{ITEM} item_date status process_timestamp"
add("payment_archive_removed", f"SELECT * FROM {{dim_payment_schedule_removed}} UNION ALL {NOT_ARCHIVED}", _ARCHIVE)
add("payment_archive_removed_parity", f"SELECT * FROM {{dim_payment_schedule_removed}} UNION ALL {NOT_ARCHIVED} AND d.item_date >= {A}", _ARCHIVE)
add("insert_select", f"SELECT * FROM {{dim_payment_schedule_removed}} UNION ALL {NOT_ARCHIVED}", DIM_PAYMENT)
_STILL_THERE = f"{ITEM} IN (SELECT {ITEM} FROM {{lms_payment_schedule_items}})"
add("payment_delete_removed", f"SELECT * FROM {{dim_payment_schedule}} WHERE {_STILL_THERE}", DIM_PAYMENT)
add("delete_by_keys_min_guard", f"SELECT * FROM {{dim_payment_schedule}} WHERE NOT ({ITEM} >= (SELECT min({ITEM}) FROM ({GONE}) g) AND {ITEM} IN (SELECT {ITEM} FROM ({GONE}) g))", f"{ITEM} status")
_ctes, _last = chain("merged", list(PAYMENT_STEPS.values()))
add("job_dim_payment_schedule", f"SELECT * FROM {_last} WHERE {_STILL_THERE}", DIM_PAYMENT, _PAYMENT_SOURCE,
    ("merged", merge("{dim_payment_schedule}", "source", [ITEM], DIM_PAYMENT, S.DIM_PAYMENT_SCHEDULE, S.INSERT_ONLY["dim_payment_schedule"])), *_ctes)

# --- collections -----------------------------------------------------------------------------------

FCT = [*S.FCT_COLLECTION_DETAIL, *S.FCT_COLLECTION_DETAIL_LATER]
ENTRIES = (
    f"SELECT {', '.join('m.' + c for c in S.MAP_PASS)}, {', '.join('c.' + c for c in S.COLLECTION_PASS)}, {N} AS process_timestamp "
    f"FROM {{collection_lms_loan_map}} m JOIN {{collections}} c ON c.collection_id = m.collection_id WHERE {in_window('m._snowflake_inserted_at')} OR {in_window('m._snowflake_updated_at')}"
)
_COLLECTION_MERGE = merge("{fct_collection_detail}", "source", ["collection_id", "base_loan_id"], FCT, S.FCT_COLLECTION_DETAIL, S.INSERT_ONLY["fct_collection_detail"])
add("collection_source", ENTRIES, S.FCT_COLLECTION_DETAIL)
add("collection_merge", _COLLECTION_MERGE, FCT, ("source", ENTRIES))
_PAIR_THERE = "EXISTS (SELECT 1 FROM {collection_lms_loan_map} m WHERE m.collection_id = f.collection_id AND m.base_loan_id = f.base_loan_id)"
add("collection_purge", f"SELECT * FROM {{fct_collection_detail}} f WHERE {_PAIR_THERE}", FCT)
for _key in ("collection_purge_parity", "delete_by_keys"):
    add(_key, f"SELECT * FROM {{fct_collection_detail}} WHERE collection_id NOT IN (SELECT collection_id FROM ({PAIRS_GONE}) g)", FCT)


def collection_steps(parity: bool) -> dict[str, tuple]:
    principal, interest, fees = ("fee", "prin", "int") if parity else ("prin", "int", "fee")
    amounts = {
        "collected_total_amount": "x.total_amount", "collected_principal_amount": f"x.amount_{principal}",
        "collected_interest_amount": f"x.amount_{interest}", "collected_fees_amount": f"x.amount_{fees}",
        "collected_other_amount": "x.amount_other",
    }

    def sums(active: bool) -> str:
        return f"LEFT JOIN ({collected(active, parity)}) x ON x.base_loan_id = t.base_loan_id"

    mapped = "x.base_loan_id IS NOT NULL AND t.base_loan_id IN (SELECT base_loan_id FROM {collection_lms_loan_map})"
    cures = (
        "LEFT JOIN (SELECT c.*, e.outgoing_date, e.is_sent FROM {lms_collection_cure_info} c JOIN (SELECT k.base_loan_id, max(k.lms_collection_cure_info_id) AS id "
        f"FROM {{lms_collection_cure_info}} k JOIN {{lms_base_loans}} b ON k.base_loan_id = b.base_loan_id WHERE b.loan_status IN {ACTIVE} AND k.is_cured = 0 AND k.is_enabled = 1 GROUP BY 1) a "
        "ON c.base_loan_id = a.base_loan_id AND c.lms_collection_cure_info_id = a.id JOIN {lms_deferred_outgoing_email} e ON e.lms_deferred_outgoing_email_id = c.rtc_notice) x ON x.base_loan_id = t.base_loan_id"
    )
    return {
        "collected_active": (mapped, {**amounts, "process_timestamp": A}, sums(True)),
        "collected_inactive": (mapped, {**amounts, "process_timestamp": N}, sums(False)),
        "outstanding": (f"t.process_timestamp >= {A}", {**OUTSTANDING, "process_timestamp": N}),
        "rtc_cure": (f"t.process_timestamp >= {A} AND x.base_loan_id IS NOT NULL", {
            "open_cure_info_id": "x.lms_collection_cure_info_id", "open_rtc_notice_id": "x.rtc_notice",
            "rtc_outgoing_date": "CAST(x.outgoing_date AS DATE)", "rtc_default_date": "CAST(x.default_time AS DATE)",
            "rtc_sent_flag": "x.is_sent", "rtc_cured_flag": "x.is_cured", "rtc_cure_date": "x.cure_date", "process_timestamp": N}, cures),
        "status_sync": ("t.status_code <> c.status_code OR t.sub_status_code <> c.sub_status_code",
                        {"status_code": "c.status_code", "sub_status_code": "c.sub_status_code"}, "LEFT JOIN {collections} c ON c.collection_id = t.collection_id"),
    }


for _name, _step in collection_steps(False).items():
    add(f"collection_{_name}", step("{fct_collection_detail}", *_step), list(COLLECTION_STEP_COLUMNS))
add("update_all_columns_expr", step("{fct_collection_detail}", *collection_steps(False)["outstanding"]), list(COLLECTION_STEP_COLUMNS))
for _name in ("collected_active", "collected_inactive"):
    add(f"collection_{_name}_parity", step("{fct_collection_detail}", *collection_steps(True)[_name]), list(COLLECTION_STEP_COLUMNS))
for _key, _parity in (("job_fct_collection_detail", False), ("job_fct_collection_detail_parity", True)):
    _gone = "SELECT f.collection_id FROM merged f WHERE NOT " + _PAIR_THERE
    _kept = f"SELECT * FROM merged WHERE collection_id NOT IN ({_gone})" if _parity else f"SELECT * FROM merged f WHERE {_PAIR_THERE}"
    _ctes, _last = chain("purged", list(collection_steps(_parity).values()))
    add(_key, f"SELECT * FROM {_last}", FCT, ("source", ENTRIES), ("merged", _COLLECTION_MERGE), ("purged", _kept), *_ctes)

# --- insurance -------------------------------------------------------------------------------------

PLANS = (
    f"SELECT p.id AS protection_plan_id, {', '.join('p.' + c for c in S.PLAN_PASS)}, s.base_loan_id, y.policy_number, y.product_code, y.policy_document_url, y.insurance_provider_id, "
    f"v.name AS insurance_provider_name, v.code AS insurance_provider_code, v.enquiry_email, v.enquiry_phone, v.customer_dashboard_url, {N} AS process_timestamp, l.id AS status_log_id "
    "FROM {protection_plan} p JOIN {insurance_policy} y ON p.policy_id = y.id JOIN {insurance_provider} v ON y.insurance_provider_id = v.id "
    "LEFT JOIN {protection_plan_status_log} l ON p.protection_plan_application_id = l.protection_plan_application_id JOIN {protection_plan_status} s ON l.id = s.protection_plan_status_log_id "
    f"WHERE {in_window('p._snowflake_inserted_at')} OR {in_window('p._snowflake_updated_at')}"
)
STATUSES = (
    f"SELECT s.base_loan_id, s.protection_plan_status_log_id, l.attempted_status, l.status, l.span_id, l.created_datetime, {N} AS process_timestamp "
    "FROM {protection_plan_status} s JOIN {protection_plan_status_log} l ON s.protection_plan_status_log_id = l.id"
)
_NEWEST_PLAN = f"SELECT * FROM ({PLANS}) q WHERE status_log_id = (SELECT max(status_log_id) FROM ({PLANS}) z WHERE z.protection_plan_id = q.protection_plan_id)"
_NEWEST_STATUS = "SELECT * FROM statuses q WHERE protection_plan_status_log_id = (SELECT max(protection_plan_status_log_id) FROM statuses z WHERE z.base_loan_id = q.base_loan_id)"
_PLAN_CTES = [("plans", _NEWEST_PLAN)]
_STATUS_CTES = [("statuses", STATUSES), ("newest", _NEWEST_STATUS)]
_PLAN_MERGE = merge("{dim_insurance_protection_plan}", "plans", ["protection_plan_id"], S.DIM_INSURANCE_PROTECTION_PLAN, S.DIM_INSURANCE_PROTECTION_PLAN, (), "op")
_STATUS_MERGE = merge("{dim_insurance_protection_plan_status}", "newest", ["base_loan_id"], S.DIM_INSURANCE_PROTECTION_PLAN_STATUS, S.DIM_INSURANCE_PROTECTION_PLAN_STATUS, (), "op")
add("insurance_plan_source", PLANS, [*S.DIM_INSURANCE_PROTECTION_PLAN, "status_log_id"])
add("insurance_plan_merge", _PLAN_MERGE, S.DIM_INSURANCE_PROTECTION_PLAN, *_PLAN_CTES)
for _key in ("insurance_status_merge", "merge_full_refresh", "sink_snapshot"):
    add(_key, _STATUS_MERGE, S.DIM_INSURANCE_PROTECTION_PLAN_STATUS, *_STATUS_CTES)
add("merge_upsert", _STATUS_MERGE, [*S.DIM_INSURANCE_PROTECTION_PLAN_STATUS, "op"], *_STATUS_CTES)
add("job_dim_insurance", f"SELECT 'plan' AS table_name, * FROM ({_PLAN_MERGE}) p UNION ALL BY NAME SELECT 'status' AS table_name, * FROM ({_STATUS_MERGE}) s",
    ["table_name", "op", *dict.fromkeys([*S.DIM_INSURANCE_PROTECTION_PLAN, *S.DIM_INSURANCE_PROTECTION_PLAN_STATUS])], *_PLAN_CTES, *_STATUS_CTES)

# --- audit -----------------------------------------------------------------------------------------

BATCH = "batch_id job_id batch_type batch_label check_point_type check_point_start check_point_end is_success start_datetime end_datetime"
add("audit_next_window", f"SELECT j.job_id, j.job_name, coalesce(w.watermark, TIMESTAMP '2000-01-01 12:00:00') AS check_point_start, {N} AS check_point_end FROM {{etl_jobs}} j LEFT JOIN ({WATERMARKS}) w ON w.job_id = j.job_id", "job_id job_name check_point_start check_point_end")
add("audit_job_lookup", "SELECT j.job_id, (SELECT nullif(count(*), 0) FROM {etl_job_batches} b WHERE b.job_id = j.job_id) AS batches FROM {etl_jobs} j WHERE j.job_name = 'dim_payment_schedule'", "job_id batches")
add("audit_batch_open", f"SELECT * FROM {{etl_job_batches}} UNION ALL SELECT 100000000, 2, 'DELTA', 'Populate dim_loan', 'TIMESTAMP', {A}, {B}, NULL, {N}, NULL", BATCH)
add("audit_batch_close", f"SELECT * REPLACE (CASE WHEN batch_id = 42 THEN {N} ELSE end_datetime END AS end_datetime, CASE WHEN batch_id = 42 THEN 1 ELSE is_success END AS is_success) FROM {{etl_job_batches}}", BATCH)
add("audit_job_status", "SELECT j.job_id, j.job_name, b.is_success, b.check_point_start, b.check_point_end FROM {etl_jobs} j LEFT JOIN (SELECT * FROM {etl_job_batches} x WHERE batch_id = (SELECT max(batch_id) FROM {etl_job_batches} y WHERE y.job_id = x.job_id)) b ON b.job_id = j.job_id", "job_id job_name is_success check_point_start check_point_end")

# --- reconciliation and rules ----------------------------------------------------------------


def keyed(left: str, right: str, key: str) -> str:
    def count(rows: str) -> str:
        return f"(SELECT {key}, count(*) AS n FROM {rows} GROUP BY 1)"

    same = count(f"(SELECT * FROM {{{left}}} INTERSECT ALL SELECT * FROM {{{right}}}) q")
    return (
        f"SELECT {key}, source_rows, target_rows, equal_rows, least(source_rows, target_rows) - equal_rows AS differing_rows, "
        f"source_rows - least(source_rows, target_rows) AS only_in_source, target_rows - least(source_rows, target_rows) AS only_in_target FROM ("
        f"SELECT coalesce(s.{key}, t.{key}) AS {key}, coalesce(s.n, 0) AS source_rows, coalesce(t.n, 0) AS target_rows, coalesce(e.n, 0) AS equal_rows "
        f"FROM {count(f'{{{left}}}')} s FULL JOIN {count(f'{{{right}}}')} t ON s.{key} = t.{key} LEFT JOIN {same} e ON e.{key} = coalesce(s.{key}, t.{key})) k"
    )


_DIFF = "source_rows target_rows equal_rows differing_rows only_in_source only_in_target"
_CUSTOMER_DIFF = keyed("dim_customer", "dim_customer_copy", "customer_id")
add("keyed_full_outer_diff", keyed("dim_insurance_protection_plan", "dim_insurance_protection_plan_copy", "protection_plan_id"), "protection_plan_id " + _DIFF)
add("recon_keyed_diff", keyed("fct_collection_detail", "fct_collection_detail_copy", "collection_id"), "collection_id " + _DIFF)
_TOTALS = "keys_differing keys_only_in_target keys_only_in_source equal_rows differing_rows only_in_source only_in_target"


def diff_totals(label: str, name: str, key: str) -> str:
    return (
        f"SELECT {label}count(*) FILTER (WHERE differing_rows > 0) AS keys_differing, count(*) FILTER (WHERE source_rows = 0) AS keys_only_in_target, count(*) FILTER (WHERE target_rows = 0) AS keys_only_in_source, "
        + ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("equal_rows", "differing_rows", "only_in_source", "only_in_target"))
        + f" FROM ({keyed(name, f'{name}_copy', key)}) d"
    )


add("recon_keyed_diff_schedule", diff_totals("", "dim_payment_schedule", "payment_schedule_id"), _TOTALS)
add("recon_pair_diffs", " UNION ALL ".join(
    diff_totals(f"'old.{n}' AS source_table, 'dwh.{n}' AS target_table, ", n, key) for n, key in DIMENSION_MAP.items()),
    "source_table target_table " + _TOTALS)
add("sink_text_report",
    "SELECT 'customer_id=' || customer_id || ': ' || differing_rows || ' differing, ' || only_in_source || ' only in source, ' || only_in_target || ' only in target' AS line "
    f"FROM ({_CUSTOMER_DIFF}) d WHERE equal_rows <> source_rows OR equal_rows <> target_rows", "line")
_PAIRED = f"(SELECT CAST(sum(least(source_rows, target_rows)) AS BIGINT) FROM ({_CUSTOMER_DIFF}) d)"
add("recon_column_mismatches", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {_PAIRED} - (SELECT count(*) FROM (SELECT customer_id, {c} FROM {{dim_customer}} INTERSECT ALL SELECT customer_id, {c} FROM {{dim_customer_copy}}) q) AS mismatched_rows"
    for c in S.DIM_CUSTOMER if c != "customer_id"), "column_name mismatched_rows")


TABLE_COLUMNS = {
    "fct_collection_detail": FCT, "dim_payment_schedule": DIM_PAYMENT, "dim_customer": S.DIM_CUSTOMER,
    "dim_payment_schedule_removed": DIM_PAYMENT, "dim_loan": DIM_LOAN,
    "dim_insurance_protection_plan": S.DIM_INSURANCE_PROTECTION_PLAN,
    "dim_insurance_protection_plan_status": S.DIM_INSURANCE_PROTECTION_PLAN_STATUS,
}


def pair_columns(name: str, key: str) -> str:
    """Rows of keys on both sides less the values they share, column by column."""
    return " UNION ALL ".join(
        f"SELECT 'old.{name}' AS source_table, 'dwh.{name}' AS target_table, '{c}' AS column_name, (SELECT n FROM once_paired_{name}) - (SELECT count(*) FROM (SELECT {key}, {c} FROM once_source_{name} INTERSECT ALL SELECT {key}, {c} FROM once_target_{name}) q) AS mismatched_rows"
        for c in TABLE_COLUMNS[name] if c != key)


def pair_steps(name: str, key: str) -> list[tuple[str, str]]:
    def count(side: str) -> str:
        return f"(SELECT {key}, count(*) AS n FROM once_{side}_{name} GROUP BY 1)"

    return [
        (f"once_source_{name}", f"SELECT * FROM {{{name}}}"), (f"once_target_{name}", f"SELECT * FROM {{{name}_copy}}"),
        (f"once_paired_{name}", f"SELECT CAST(sum(least(s.n, t.n)) AS BIGINT) AS n FROM {count('source')} s JOIN {count('target')} t ON s.{key} = t.{key}"),
    ]


add("recon_pair_columns", " UNION ALL ".join(pair_columns(n, key) for n, key in DIMENSION_MAP.items()),
    "source_table target_table column_name mismatched_rows", *[step for n, key in DIMENSION_MAP.items() for step in pair_steps(n, key)])
add("recon_row_count", with_match([counted("1 AS one", "{dim_loan}", "{dim_loan_copy}")]), "source_count target_count count_match")
add("recon_null_counts", "SELECT *, CASE WHEN source_nulls = target_nulls THEN 'Match' ELSE 'Mismatch' END AS null_match FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, (SELECT count(*) FROM {{dim_loan}} WHERE {c} IS NULL) AS source_nulls, (SELECT count(*) FROM {{dim_loan_copy}} WHERE {c} IS NULL) AS target_nulls"
    for c in DIM_LOAN) + ") n", "column_name source_nulls target_nulls null_match")



def summary(name: str) -> str:
    nulls = ", ".join(f"count(*) - count({c})" for c in TABLE_COLUMNS[name])
    return counted(
        f"'old.{name}' AS source_table, 'dwh.{name}' AS target_table, 'Match' AS schema_match, 'Match' AS datatype_match, "
        f"CASE WHEN (SELECT [{nulls}] FROM {{{name}}}) = (SELECT [{nulls}] FROM {{{name}_copy}}) THEN 'Match' ELSE 'Mismatch' END AS null_match, "
        f"CASE WHEN (SELECT count(*) FROM (SELECT * FROM {{{name}}} EXCEPT ALL SELECT * FROM {{{name}_copy}}) l) + "
        f"(SELECT count(*) FROM (SELECT * FROM {{{name}_copy}} EXCEPT ALL SELECT * FROM {{{name}}}) r) = 0 THEN 'Match' ELSE 'Mismatch' END AS data_match",
        f"{{{name}}}", f"{{{name}_copy}}")


add("recon_summary", with_match([summary(n) for n in DIMENSION_MAP]),
    "source_table target_table source_count target_count count_match schema_match datatype_match null_match data_match")

_BAD_TYPE = "SELECT 'item_type' AS rule, count(*) AS violations FROM {dim_payment_schedule} WHERE item_type IS NOT NULL AND item_type NOT IN ('C', 'D')"


def bad_text(column: str, parity: bool, pattern: str = "[0-9.]+") -> str:
    return f"SELECT '{column}' AS rule, count(*) AS violations FROM {{dim_customer}} WHERE {column} IS NOT NULL {'OR' if parity else 'AND'} NOT regexp_full_match({column}, '{pattern}')"


_RULES = f"{_BAD_TYPE} UNION ALL {bad_text('grossmonthly', False)} UNION ALL {bad_text('paycheck_amount', False)}"
add("rule_item_type", _BAD_TYPE, "rule violations")
for _parity, _tail in ((False, ""), (True, "_parity")):
    add("rule_gross_monthly" + _tail, bad_text("grossmonthly", _parity, "[0-9.]" if _parity else "[0-9.]+"), "rule violations")
    add("rule_paycheck_amount" + _tail, bad_text("paycheck_amount", _parity), "rule violations")
add("agg_rule_violations", _RULES, "rule violations")
add("rule_report",
    "SELECT 'Test Case: ' || CASE rule WHEN 'item_type' THEN 'dwh.dim_payment_schedule' ELSE 'dwh.dim_customer' END || ' -> ' || rule || "
    "CASE rule WHEN 'item_type' THEN ' values should only be in C, D, NULL.' ELSE ' values should only be in numbers and periods.' END AS line "
    f"FROM ({_RULES}) a UNION ALL SELECT 'Invalid count: ' || rule || ' -> ' || violations || '.' FROM ({_RULES}) b", "line")

# --- layers described without code ---------------------------------------------------------------

add("prepare_flatten_json", "SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM {events}", "event_id event_type k")
add("normalize_standardize", "SELECT customer_id, TRY_CAST(NULLIF(TRIM(REPLACE(grossmonthly, ',', ''), '$'), '') AS DECIMAL(38,2)) AS grossmonthly, lower(trim(email)) AS email FROM {dim_customer}", "customer_id grossmonthly:d email")
add("normalize_standardize_times", f"SELECT {ITEM}, TRY_CAST(return_time AS TIMESTAMP) AS return_time FROM {{funding_payment_return}}", f"{ITEM} return_time")
add("normalize_unreadable_money", "SELECT 'dim_customer' AS table_name, 'grossmonthly' AS column_name, CAST(customer_id AS VARCHAR) AS column_value, 'Not a number' AS reject_reason FROM {dim_customer} WHERE grossmonthly IS NOT NULL AND TRY_CAST(NULLIF(TRIM(REPLACE(grossmonthly, ',', ''), '$'), '') AS DECIMAL(38,2)) IS NULL AND regexp_matches(grossmonthly, '[^$, ]')", "table_name column_name column_value reject_reason")
add("star_and_marts", f"SELECT c.organization_name, p.status, count(*) AS item_count, CAST(sum(p.total_amount) AS {MONEY}) AS total_amount FROM {{dim_payment_schedule}} p JOIN {{dim_customer}} c ON p.customer_id = c.customer_id GROUP BY 1, 2", "organization_name status item_count total_amount")


def all_sql() -> dict[str, str]:
    return dict(SQL)
