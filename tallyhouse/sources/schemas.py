"""Column names and types of the landing tables and of the warehouse tables.

Landing tables are written as DDL text; warehouse tables are derived from them,
because a warehouse table is mostly a projection of its landing tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Landing column names, with the types this engine gives them.
LANDING_DDL = {
    "ach_transactions": """
        update_datetime timestamp_ntz, lms_payment_schedule_item_id string, created_datetime timestamp_ntz
    """,
    "collection_lms_loan_map": """
        collection_id bigint, base_loan_id bigint, payment_schedule_id bigint, total_amount decimal(38,2),
        principal_amount decimal(38,2), interest_amount decimal(38,2), fees_amount decimal(38,2), other_amount
        decimal(38,2), delinquency_date date, fully_defaulted_date date, create_timestamp timestamp_ntz,
        update_timestamp timestamp_ntz, _snowflake_inserted_at timestamp_ntz, _snowflake_updated_at
        timestamp_ntz
    """,
    "collections": """
        customer_id bigint, status_code string, sub_status_code string, static_note_id bigint,
        escalation_level string, settlement_flag int, settlement_amount decimal(38,2),
        settlement_discounted_amount decimal(38,2), settlement_approval_timestamp timestamp_ntz,
        request_to_rotate_flag int, created_by_user_id bigint, collection_id bigint, created_timestamp
        timestamp_ntz
    """,
    "funding_payment_return": """
        return_time string, payment_schedule_item_id string, created_datetime timestamp_ntz
    """,
    "insurance_policy": """
        policy_number string, product_code string, policy_document_url string, insurance_provider_id bigint,
        id bigint, created_datetime timestamp_ntz
    """,
    "insurance_provider": """
        name string, code string, enquiry_email string, enquiry_phone string, customer_dashboard_url string,
        id bigint, created_datetime timestamp_ntz
    """,
    "protection_plan": """
        id bigint, protection_plan_application_id bigint, current_loan_status string, loan_status_updated_date
        date, pay_frequency string, external_reference string, end_of_coverage_datetime timestamp_ntz,
        created_span_id bigint, updated_span_id bigint, version int, policy_id bigint, created_datetime
        timestamp_ntz, updated_datetime timestamp_ntz, _snowflake_inserted_at timestamp_ntz,
        _snowflake_updated_at timestamp_ntz
    """,
    "protection_plan_status": """
        base_loan_id bigint, protection_plan_status_log_id bigint
    """,
    "protection_plan_status_log": """
        protection_plan_application_id bigint, id bigint, attempted_status string, status string, span_id
        bigint, created_datetime timestamp_ntz
    """,
    "lead_source": """
        description string, lead_source_id bigint, start_datetime timestamp_ntz
    """,
    "lms_base_loans": """
        base_loan_id bigint, loan_status string, customer_id bigint, loan_header_id bigint, origination_date
        date, effective_date date, due_date date, loan_type string, lms_entity_id bigint, stated_apr
        decimal(18,6), max_installments int, max_payments int, loan_fee_pct decimal(18,6), additional_fees
        decimal(38,2), loan_owner string, funding_method string, loan_amount decimal(38,2),
        requested_loan_amount decimal(38,2), is_paying int, last_due_date date, is_deleted int, paid_off_date
        date, first_pd date, is_e_consent int, is_online_draw_enabled int, cancellation_type string,
        is_technology_fee_charged int, is_cach_allowed int, created_datetime timestamp_ntz, updated_datetime
        timestamp_ntz, loan_interest_pct decimal(18,6)
    """,
    "lms_collection_cure_info": """
        lms_collection_cure_info_id bigint, rtc_notice bigint, default_time timestamp_ntz, is_cured int,
        cure_date date, base_loan_id bigint, is_enabled int, created_datetime timestamp_ntz
    """,
    "lms_customer_info_flat": """
        customer_id bigint, lastname string, firstname string, address string, address2 string, city string,
        state string, zip string, homephone string, cellphone string, alt_phone string, grossmonthly string,
        incometype string, ismilitary string, mla_flag int, email string, email2 string, bankname string,
        employer string, emp_industry string, bankphone string, empphone string, workphone string, otherphone
        string, supervisor string, title string, dob date, hiredate date, lastpaydate date, nextpaydate date,
        next_paydate_computed string, secondpaydate date, payfrequency string, paytype string, paycheck_amount
        string, nmi string, rent_amount decimal(38,2), dow string, day1 string, day2 string, movedir string,
        language string, optout_account_email string, optout_account_sms string, optout_marketing_sms string,
        optout_marketing_email string, dom1 string, dom2 string, accounttype string, routingnumber string,
        bank_institution_code string, bank_transit_code string, wire_aba string, is_online_bank int,
        account_number string, organization_id bigint, social_security_number string, ssn_last_four string,
        electronic_consent_signed string, electronic_consent_signed_timestamp timestamp_ntz, marital_status
        string, spouse_first_name string, spouse_last_name string, spouse_email string, spouse_address_1
        string, spouse_address_2 string, spouse_city string, spouse_state string, spouse_zip_code string,
        is_account_on_hold int, created_date timestamp_ntz, last_update timestamp_ntz
    """,
    "lms_deferred_outgoing_email": """
        outgoing_date date, is_sent int, lms_deferred_outgoing_email_id bigint, created_datetime timestamp_ntz
    """,
    "lms_entities": """
        entity_name string, organization_id bigint, lms_entity_id bigint
    """,
    "lms_loan_entity_parameters": """
        value string, base_loan_id bigint, parameter_name string, id bigint
    """,
    "lms_loan_header": """
        origination_timestamp timestamp_ntz, status string, created_date timestamp_ntz, last_update
        timestamp_ntz, followup_date date, first_name string, last_name string, state string, country string,
        required_items string, is_locked int, is_returning int, last_csr string, last_csr_name string,
        lead_sequence_id bigint, priority_note string, language string, status_extended string, approver_id
        bigint, originator_id bigint, withdrawer_id bigint, contact_attempts int, last_contact_date
        timestamp_ntz, bad_contact_info_flag int, n_outstanding_items int, task_remaining_flat string,
        approval_timestamp timestamp_ntz, qa_timestamp timestamp_ntz, payment_type string,
        payment_type_authorized string, campaign_id bigint, campaign_name string, q_check_valid string,
        q_check_agent string, is_nobankcall int, queue_priority string, last_express_time timestamp_ntz,
        spousal_notice string, cure_version int, cure_datafixed string, withdrawn_timestamp timestamp_ntz,
        kyc_start_timestamp timestamp_ntz, dl_status string, web_lasttouch string, web_lastpage string,
        is_dm_customer int, is_limit_override_approved int, qa_type string, is_dummy int, is_nc_auto_fund int,
        is_nc_auto_fund_flow int, nc_average_payment_amount decimal(38,2), rc_average_payment_amount
        decimal(38,2), risk_level_id bigint, bv_system_id bigint, tls_loan_id bigint, is_test_loan int,
        is_auto_fund_agent_assisted int, referrer_id bigint, loan_header_id bigint, lms_entity_id bigint,
        is_auto_fund int
    """,
    "lms_loanheader_state": """
        action_time timestamp_ntz, loan_header_id bigint, action string, id bigint
    """,
    "lms_payment_schedule_item_metadata": """
        value string, payment_schedule_item_id string, name string, created_datetime timestamp_ntz
    """,
    "lms_payment_schedule_items": """
        total_amount decimal(38,2), amount_fee decimal(38,2), amount_prin decimal(38,2), amount_int
        decimal(38,2), amount_other decimal(38,2), payment_schedule_id bigint, status string, item_type
        string, item_date date, updated_datetime timestamp_ntz, payment_schedule_item_id string, payment_mode
        string, amount_disc decimal(38,2), outstanding_fee_amount decimal(38,2), is_pif int, is_offcycle int,
        payment_sequence int, cure_info_id bigint, is_cure_master int, payment_failed_date date,
        reference_text string, is_created_by_customer_online int, is_created_by_ivr_payment int,
        original_item_date date, original_total_amount decimal(38,2), original_fee_amount decimal(38,2),
        original_interest_amount decimal(38,2), original_principal_amount decimal(38,2), original_other_amount
        decimal(38,2), original_outstanding_fee_amount decimal(38,2), split_from_payment_schedule_item_id
        bigint, online_payment_split_total_amount decimal(38,2), online_payment_split_fee_amount
        decimal(38,2), online_payment_split_interest_amount decimal(38,2),
        online_payment_split_principal_amount decimal(38,2), online_payment_split_other_amount decimal(38,2),
        auxiliary_type string, created_datetime timestamp_ntz, _snowflake_inserted_at timestamp_ntz,
        _snowflake_updated_at timestamp_ntz
    """,
    "lms_payment_schedules": """
        base_loan_id bigint, payment_schedule_id bigint, customer_id bigint, initial_apr decimal(18,6),
        is_active int, is_collections int, stored_payment_use string, theoretical_sep_amt decimal(38,2)
    """,
    "loan_status_change_history": """
        change_date date, loan_header_id bigint, to_status string
    """,
    "loc_fee_structure": """
        base_loan_id bigint, id bigint, daily_interest_code string
    """,
    "risk_level": """
        risk_code string, description string, id bigint, created_datetime timestamp_ntz
    """,
    "upm_organizations": """
        organization_name string, is_active int, email_domain string, organization_id bigint, created_datetime
        timestamp_ntz
    """,
}

INSERTED_AT = "_snowflake_inserted_at"
UPDATED_AT = "_snowflake_updated_at"
CHANGE_COLUMNS = (INSERTED_AT, UPDATED_AT)


def columns(table: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a landing table."""
    fields = " ".join(LANDING_DDL[table].split()).split(", ")
    return [tuple(field.split(" ", 1)) for field in fields]


def names(table: str, *without: str) -> list[str]:
    return [name for name, _ in columns(table) if name not in without]


def struct(table: str) -> T.StructType:
    """Explicit read schema of a landing table."""
    return T.StructType.fromDDL(LANDING_DDL[table])


# Which landing columns each warehouse table takes over unchanged.
CUSTOMER_PASS = names("lms_customer_info_flat")
LOAN_BASE_PASS = names("lms_base_loans", "loan_interest_pct")
LOAN_HEADER_PASS = names("lms_loan_header", "status", "loan_header_id", "lms_entity_id")
ITEM_PASS = names("lms_payment_schedule_items", *CHANGE_COLUMNS)
SCHEDULE_PASS = names("lms_payment_schedules", "payment_schedule_id")
MAP_PASS = names("collection_lms_loan_map", *CHANGE_COLUMNS)
COLLECTION_PASS = names("collections", "collection_id", "created_timestamp")
PLAN_PASS = names("protection_plan", "id", *CHANGE_COLUMNS)

AMOUNTS = ("total", "principal", "interest", "fees", "other")
COLLECTED = [f"collected_{a}_amount" for a in AMOUNTS]
OUTSTANDING = [f"outstanding_{a}_amount" for a in AMOUNTS]

# Columns written by a merge; the later updates add the *_LATER ones.
DIM_CUSTOMER = [*CUSTOMER_PASS, "lms_code", "organization_name", "is_active", "email_domain", "process_timestamp"]
DIM_LOAN = [
    *LOAN_BASE_PASS, *LOAN_HEADER_PASS, "lms_code", "entity_name", "organization_id", "organization_name",
    "lms_status", "risk_code", "risk_level_description", "agent_open_time", "process_timestamp",
]
DIM_LOAN_LATER = ["loan_interest_pct", "delinquent_date", "default_date"]
DIM_PAYMENT_SCHEDULE = [*ITEM_PASS, *SCHEDULE_PASS, "organization_id", "process_timestamp"]
DIM_PAYMENT_SCHEDULE_LATER = ["subid_tracking_id"]
FCT_COLLECTION_DETAIL = [*MAP_PASS, *COLLECTION_PASS, "process_timestamp"]
FCT_COLLECTION_DETAIL_LATER = [
    *COLLECTED, *OUTSTANDING, "open_cure_info_id", "open_rtc_notice_id", "rtc_outgoing_date",
    "rtc_default_date", "rtc_sent_flag", "rtc_cured_flag", "rtc_cure_date",
]
DIM_INSURANCE_PROTECTION_PLAN = [
    "protection_plan_id", *PLAN_PASS, "base_loan_id", "policy_number", "product_code", "policy_document_url",
    "insurance_provider_id", "insurance_provider_name", "insurance_provider_code", "enquiry_email",
    "enquiry_phone", "customer_dashboard_url", "process_timestamp",
]
DIM_INSURANCE_PROTECTION_PLAN_STATUS = [
    "base_loan_id", "protection_plan_status_log_id", "attempted_status", "status", "span_id",
    "created_datetime", "process_timestamp",
]

# Columns a merge writes on insert and never on update.
INSERT_ONLY = {
    "dim_customer": ["rent_amount", "nmi"],
    "dim_loan": ["lms_code"],
    "dim_payment_schedule": ["theoretical_sep_amt"],
    "fct_collection_detail": ["created_by_user_id"],
    "dim_insurance_protection_plan": [],
    "dim_insurance_protection_plan_status": [],
}
