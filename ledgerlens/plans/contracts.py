"""Quality rules of every dataset, stated as SQL predicates (names and predicates are fixed values)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens import values as V
from ledgerlens.functions.columns import query_time
from ledgerlens.operators.quality import Contract, null_reasons


def one_of(column: str, allowed) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in allowed)})"


def outside(column: str, allowed) -> str:
    """Not TRUE for NULL: a missing value is not an invalid one."""
    return f"{column} NOT IN ({', '.join(repr(v) for v in allowed)})"


def present(column: str) -> str:
    return f"{column} IS NOT NULL"


# -- FX -----------------------------------------------------------------------
FX_RAW = Contract(warn={
    "valid_rate_id": present("rate_id"),
    "positive_rate": "rate > 0",
    "valid_fetch_ts": present("fetch_ts"),
    "known_quote_ccy": one_of("quote_currency", V.QUOTE_CURRENCIES),
})
FX_PARSED = Contract(
    drop={"no_duplicate_rate_id": present("rate_id")},
    fail={"parsed_rate_positive": "rate > 0"},
    guard="rate",
)
FX_REASONS = {
    **null_reasons("rate_id"),
    "non_positive_rate": "rate <= 0",
    **null_reasons("fetch_ts"),
    "unexpected_base_currency": f"base_currency <> '{V.BASE_CURRENCY}'",
    "unknown_quote_currency": outside("quote_currency", V.QUOTE_CURRENCIES),
    "rate_suspiciously_high": f"rate > {V.MAX_SANE_RATE}",
}
FX_SILVER = Contract(
    drop={
        "silver_valid_rate_id": present("rate_id"),
        "silver_positive_rate": "rate > 0",
        "silver_valid_fetch_ts": present("fetch_ts"),
    },
    warn={
        "silver_known_currency": one_of("quote_currency", V.QUOTE_CURRENCIES),
        "silver_rate_ceiling": f"rate < {V.MAX_SANE_RATE}",
    },
)
FX_SILVER_REASONS = {
    **null_reasons("rate_id"),
    "non_positive_rate": "rate <= 0",
    **null_reasons("fetch_ts"),
    "rate_exceeds_ceiling": f"rate >= {V.MAX_SANE_RATE}",
    "unknown_currency": outside("quote_currency", V.QUOTE_CURRENCIES),
}


def fx_pivot_contract(required=("USD", "EUR"), base: str = V.BASE_CURRENCY) -> Contract:
    return Contract(
        fail={f"pivoted_has_{c.lower()}": present(f"{base}_{c}") for c in required}, guard="fetch_ts"
    )


# -- reference files ----------------------------------------------------------
MCC_RAW = Contract(warn={
    "valid_mcc_code": present("mcc_code"),
    "valid_risk_level": one_of("risk_level", V.MCC_RISK_LEVELS),
    "valid_enhanced_dd": one_of("requires_enhanced_dd", V.ENHANCED_DD_FLAGS),
    "valid_description": present("description"),
})
MCC_REASONS = {
    **null_reasons("mcc_code", "description"),
    "invalid_risk_level": outside("risk_level", V.MCC_RISK_LEVELS),
    "invalid_enhanced_dd_flag": outside("requires_enhanced_dd", V.ENHANCED_DD_FLAGS),
}
SANCTIONS_RAW = Contract(warn={
    "valid_entity_id": present("entity_id"),
    "valid_full_name": present("full_name"),
    "valid_entity_type": one_of("entity_type", V.ENTITY_TYPES),
    "valid_risk_score": "risk_score BETWEEN 0.0 AND 1.0",
    "valid_sanctions_program": one_of("sanctions_program", V.SANCTION_PROGRAMS),
})
SANCTIONS_REASONS = {
    **null_reasons("entity_id", "full_name"),
    "invalid_entity_type": outside("entity_type", V.ENTITY_TYPES),
    "invalid_sanctions_program": outside("sanctions_program", V.SANCTION_PROGRAMS),
    "risk_score_out_of_range": "risk_score < 0 OR risk_score > 1",
}

# -- transactions -------------------------------------------------------------
TXN_RAW = Contract(warn={
    "valid_txn_id": present("txn_id"),
    "valid_account_id": present("account_id"),
    "positive_amount": "amount > 0",
    "valid_event_ts": present("event_ts"),
    "known_currency": one_of("currency", V.BRONZE_CURRENCIES),
    "known_txn_type": one_of("txn_type", V.TXN_TYPES),
})
TXN_STAGE = Contract(
    fail={
        "cleansed_txn_id": present("txn_id"),
        "cleansed_account_id": present("account_id"),
        "cleansed_amount": "amount > 0",
        "cleansed_event_ts": present("event_ts"),
    },
    guard="txn_id",
)


def txn_reasons(currencies=V.BRONZE_CURRENCIES, strict_nulls: bool = False) -> dict[str, str]:
    """By default a NULL amount, currency or type fires nothing (and is not clean either);
    ``strict_nulls`` names those rows too."""
    reasons = {
        **null_reasons("txn_id", "account_id", "customer_id"),
        "non_positive_amount": "amount <= 0",
        **null_reasons("event_ts"),
        "invalid_currency": outside("currency", currencies),
        "invalid_txn_type": outside("txn_type", V.TXN_TYPES),
    }
    return {**reasons, **null_reasons("amount", "currency", "txn_type")} if strict_nulls else reasons


def txn_clean_rules(currencies=V.BRONZE_CURRENCIES) -> dict[str, str]:
    return {
        "has_txn_id": present("txn_id"),
        "has_account_id": present("account_id"),
        "has_customer_id": present("customer_id"),
        "positive_amount": "amount > 0",
        "has_event_ts": present("event_ts"),
        "known_currency": one_of("currency", currencies),
        "known_txn_type": one_of("txn_type", V.TXN_TYPES),
    }


def txn_silver_contract(as_of: Column | datetime | None = None) -> Contract:
    return Contract(
        drop={
            "silver_valid_txn_id": present("txn_id"),
            "silver_valid_account": present("account_id"),
            "silver_positive_amount": "amount > 0",
            "silver_valid_event_ts": present("event_ts"),
            "silver_event_not_future": F.col("event_ts") <= query_time(as_of),
            "silver_valid_currency": one_of("currency", V.SILVER_CURRENCIES),
        },
        warn={
            "silver_valid_txn_type": one_of("txn_type", V.TXN_TYPES),
            "silver_valid_channel": one_of("channel", V.CHANNELS),
            "silver_amount_ceiling": f"amount < {V.AMOUNT_CEILING}",
        },
    )


def txn_silver_reasons(as_of: Column | datetime | None = None) -> dict:
    return {
        **null_reasons("txn_id", "account_id"),
        "non_positive_amount": "amount <= 0",
        "amount_exceeds_ceiling": f"amount >= {V.AMOUNT_CEILING}",
        **null_reasons("event_ts"),
        "event_ts_in_future": F.col("event_ts") > query_time(as_of),
        "invalid_currency": outside("currency", V.SILVER_CURRENCIES),
        "invalid_txn_type": outside("txn_type", V.TXN_TYPES),
        "invalid_channel": outside("channel", V.CHANNELS),
    }


# -- gold ---------------------------------------------------------------------
DAILY_RISK = Contract(
    fail={"valid_event_date": present("event_date")},
    warn={"positive_volume": "total_gbp_volume > 0", "valid_risk_band": one_of("daily_risk_band", V.RISK_BANDS)},
    guard="event_date",
)
ANOMALY_FLAGS = Contract(
    fail={"valid_customer_id": present("customer_id"), "valid_event_date": present("event_date")},
    guard="customer_id",
)
FX_EXPOSURE = Contract(
    fail={"valid_currency": present("currency"), "valid_event_date": present("event_date")},
    warn={"positive_exposure": "total_gbp_exposure >= 0"},
    guard="currency",
)
AML_REPORT = Contract(
    fail={
        "valid_txn_id": present("txn_id"),
        "valid_regulatory_status": one_of("regulatory_status", V.REGULATORY_STATUSES),
    },
    warn={"valid_report_date": present("report_date")},
    guard="txn_id",
)
CAPITAL_EXPOSURE = Contract(
    fail={"valid_customer_id": present("customer_id"), "valid_report_date": present("report_date")},
    warn={"positive_exposure": "total_gbp_exposure >= 0"},
    guard="customer_id",
)
