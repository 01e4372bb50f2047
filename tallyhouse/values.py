"""Values of the lending domain that results depend on."""

# Codes, statuses and lists, as the source systems write them.
LMS_CODE = "JAG"
ACTIVE_LOAN = ("Originated", "Delinquent", "DEFAULT")
COLLECTED_ITEM = ("Cleared", "SENT")
FAILED_ITEM = ("MISSED", "Return")
OPEN_ITEM = ("scheduled", "bypass", "cancelled")
WITHDRAW = "Withdraw"
WITHDRAWABLE = ("Approve", "Bank QA Error", "Pending", "Pending Bank Approval", "QA Error", "Void")
DEFAULT_PREFIX = "DEFAULT%"
INTEREST_PREFIX = "interest%"
INTEREST_MODEL = "default_calculation_model"
INTEREST_ORGANIZATIONS = (1, 5, 6, 7)
INSTALLMENT_ORGANIZATION = 1
TRACKING_NAME = "subIdTrackingId"
NON_ACH = "NON-ACH"
CARD_PATTERN = "%card%"
CARD_FAILURE_DAYS = 3
PAY_PERIODS = {"B": "2.16667", "W": "4.3333", "S": "2"}
NULL_KEY_TEXT = "_dbt_null_"
NULL_KEY_SEPARATOR = "-"
CAMPAIGN_START = "2021-08-04 00:00:00"
FIRST_WATERMARK = "2000-01-01 12:00:00"
NIGHTLY_HOUR = 3
ORPHAN_TABLE = "lms_loan_header"
ORPHAN_COLUMN = "loan_header_id"
ORPHAN_REASON = "No base loan record"
ITEM_TYPES = ("C", "D")
NUMERIC_TEXT = "^[0-9.]+$"
NUMERIC_FIRST_CHARACTER = "^[0-9.]$"
ERROR_TEXT_LENGTH = 500
# Tenant slices that a payment load merges and logs one by one.
ORG_SLICES = (1, 2, 3, 4)
