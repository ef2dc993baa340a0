"""Fixed values shared by every layer: code lists, thresholds, version tags.

These must stay equal to the values the produced tables are defined by.  Every
threshold is also a keyword argument of the operator that uses it.
"""

from decimal import Decimal

# -- code lists (fixed values) ------------------------------------------------
BASE_CURRENCY = "GBP"
QUOTE_CURRENCIES = ("USD", "EUR", "AED", "NGN", "CNY", "CHF", "JPY", "SGD")
BRONZE_CURRENCIES = ("GBP", "USD", "EUR", "AED", "NGN", "CNY")
SILVER_CURRENCIES = ("GBP", "USD", "EUR", "AED", "NGN", "CNY", "CHF", "JPY", "SGD")
TXN_TYPES = ("PURCHASE", "TRANSFER", "ATM_WITHDRAWAL", "DIRECT_DEBIT", "STANDING_ORDER", "REFUND")
CHANNELS = ("mobile_app", "online_banking", "branch", "atm", "pos_terminal")
HIGH_RISK_MCCS = ("9999", "6051", "7995", "5933", "5944")
HIGH_RISK_CHANNELS = ("atm", "online_banking")
MCC_RISK_LEVELS = ("LOW", "MEDIUM", "HIGH")
ENHANCED_DD_FLAGS = ("Y", "N")
ENTITY_TYPES = ("INDIVIDUAL", "ORGANISATION", "VESSEL", "AIRCRAFT")
SANCTION_PROGRAMS = ("OFAC_SDN", "UN_CONSOLIDATED", "EU_CONSOLIDATED", "HMT_CONSOLIDATED", "OFAC_CONSOLIDATED")
RISK_BANDS = ("LOW", "MEDIUM", "HIGH", "CRITICAL")
REGULATORY_STATUSES = ("CLEAR", "REVIEW", "REPORT")
HOME_COUNTRY = "GB"

# -- labels and defaults (fixed values) ---------------------------------------
PIPELINE_VERSION = "1.0.0"
TXN_SOURCE_SYSTEM = "kafka_simulator"
FX_PROVIDER = "exchangerate-api"
PENDING = "PENDING_REVIEW"
UNKNOWN_MERCHANT = "UNKNOWN"
UNKNOWN_MCC = "0000"

# -- thresholds (fixed values) ------------------------------------------------
STALE_AFTER_MINUTES = 30
MAX_SANE_RATE = 100_000
SIGNIFICANT_MOVE_PCT = 1.0
AMOUNT_CEILING = 1_000_000
NIGHT_HOURS = (0, 5)
VELOCITY_LIMIT = 10
LARGE_TXN = 5_000
NIGHT_TXN_LIMIT = 3
CROSS_BORDER_SHARE = 0.50
COUNTRY_LIMIT = 3
SAR_THRESHOLD = 10_000
STRUCTURING_DAYS = 3
STRUCTURING_TOTAL = 9_000
HIGH_RISK_CHANNEL_AMOUNT = 3_000
CAPITAL_BASE = 5_000_000
LARGE_EXPOSURE_PCT = 10
WATCH_EXPOSURE_PCT = Decimal("7.5")
RISK_WEIGHTS = {
    "PURCHASE": "1.00",
    "TRANSFER": "0.75",
    "ATM_WITHDRAWAL": "0.50",
    "DIRECT_DEBIT": "0.75",
    "STANDING_ORDER": "0.75",
    "REFUND": "0.00",
}
WATERMARK_DELAY = "1 hour"
MAX_FILES_PER_TRIGGER = 10
