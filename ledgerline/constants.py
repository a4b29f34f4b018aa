"""Fixed values of the sales/stores data contract.

These must stay exactly as written: they define which landing rows are
valid, the names of the rejection reasons and the landing column order.
"""

# --- fixed values: landing column order (by position, no header needed) ---
STORE_COLUMNS = ["store_group", "store_token", "store_name"]
SALES_COLUMNS = [
    "store_token",
    "transaction_id",
    "receipt_token",
    "transaction_time",
    "amount",
    "user_role",
]

# --- fixed values: validity patterns (anchored with \z, not $, so a trailing
# newline never passes; Java's $ would accept one) ---
STORE_TOKEN_RE = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\z"
TRANSACTION_ID_RE = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\z"
)
RECEIPT_TOKEN_RE = r"^[A-Za-z0-9]{5,30}\z"
STORE_GROUP_RE = r"^[0-9A-F]{8}\z"
RECEIPT_CHARS_RE = r"^[A-Za-z0-9]+\z"
# YYYYMMDDTHHMMSS.f{1,6}; a part of two digits may have one, and takes two if it can
TRANSACTION_TIME_RE = (r"^(\d{4})(\d{1,2}+)(\d{1,2}+)T(\d{1,2}+)(\d{1,2}+)(\d{1,2}+)"
                       r"\.(\d{1,6})\z")

# --- fixed values: file-name patterns for the batch date ---
STORES_FILE_RE = r"stores_(\d{8})\.csv"
SALES_FILE_RE = r"sales_(\d{8})(?:_\d+)?\.csv"

# --- fixed values: rejection reasons, in precedence order ---
REJECTION_REASONS = [
    "invalid_store_token",
    "invalid_transaction_id",
    "invalid_receipt_token",
    "invalid_transaction_time",
    "invalid_amount_format",
    "invalid_amount_negative",
    "invalid_user_role",
]

# --- fixed values: limits ---
USER_ROLE_MAX_LEN = 30
STORE_NAME_MIN_LEN = 1
STORE_NAME_MAX_LEN = 200
AMOUNT_TYPE = "decimal(11,2)"
REPORT_SUM_TYPE = "decimal(18,2)"
OUTPUT1_ROWS = 40
OUTPUT2_ROWS = 40
OUTPUT3_DATES = 10
OUTPUT3_TOP_K = 5

# SCD2 bookkeeping columns added to every snapshot table.
SCD_COLUMNS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]
