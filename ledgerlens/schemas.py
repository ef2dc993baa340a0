"""Column layouts of the sources and of the produced tables (fixed values)."""

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
    "rates": T.MapType(T.StringType(), T.DoubleType()),
}


def _layout(text: str) -> T.StructType:
    """``name type, name type, ...``; needs no running session."""
    pairs = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


TXN_SOURCE = _layout("""
    txn_id string, account_id string, customer_id string, counterparty_id string, txn_type string, channel string,
    amount double, currency string, merchant_name string, merchant_mcc string, country_code string,
    is_international boolean, device_id string, ip_address string, event_ts timestamp,
    kafka_offset int, kafka_partition int
""")

FX_STAGE = _layout("""
    rate_id string, base_currency string, quote_currency string, rate double, source_ts string,
    fetch_ts timestamp, provider string, pipeline_version string
""")

FX_PAYLOAD = _layout("""
    result string, base_code string, time_last_update_utc string, conversion_rates rates
""")

MCC_FILE = _layout("""
    mcc_code string, description string, category string, risk_level string, requires_enhanced_dd string,
    effective_date string, last_updated string
""")

SANCTION_RECORD = _layout("""
    entity_id string, entity_type string, full_name string, aliases strings, country_of_origin string,
    sanctions_program string, listed_date string, last_updated string, is_active boolean, risk_score double,
    source_list string
""")

SANCTION_ENVELOPE = _layout("schema_version string, generated_at string, record_count string").add(
    "records", T.ArrayType(SANCTION_RECORD)
)

FX_SILVER = _layout("""
    rate_id string, base_currency string, quote_currency string, rate double, source_ts timestamp,
    fetch_ts timestamp, rate_date date, rate_age_minutes double, prev_rate double, rate_change_pct double,
    daily_avg_rate double, significant_move boolean, provider string, silver_processed_ts timestamp,
    pipeline_version string
""")

TXN_SILVER = _layout("""
    txn_id string, account_id string, customer_id string, counterparty_id string, txn_type string, channel string,
    amount double, currency string, gbp_amount double, merchant_name string, merchant_mcc string,
    merchant_risk_level string, country_code string, is_international boolean, is_cross_border boolean,
    is_high_risk_merchant boolean, counterparty_sanctioned boolean, device_id string, ip_address string,
    event_ts timestamp, event_date date, txn_hour int, txn_day_of_week int, silver_processed_ts timestamp,
    pipeline_version string
""")

DAILY_RISK = _layout("""
    event_date date, total_txn_count bigint, total_gbp_volume double, distinct_customers bigint,
    distinct_accounts bigint, high_risk_txn_count bigint, high_risk_gbp_volume double, cross_border_count bigint,
    cross_border_gbp_volume double, sanctioned_count bigint, late_night_count bigint, refund_count bigint,
    refund_rate_pct double, avg_txn_gbp_value double, max_single_txn_gbp double, daily_risk_band string,
    gold_processed_ts timestamp, pipeline_version string
""")

ANOMALY_FLAGS = _layout("""
    customer_id string, event_date date, daily_txn_count bigint, cross_border_count bigint, night_txn_count bigint,
    max_single_txn_gbp double, sanctioned_count bigint, distinct_countries bigint, total_customer_gbp double,
    velocity_flag boolean, large_txn_flag boolean, night_owl_flag boolean, cross_border_spike_flag boolean,
    sanctioned_flag boolean, multi_country_flag boolean, any_flag boolean, gold_processed_ts timestamp,
    pipeline_version string
""")

FX_EXPOSURE = _layout("""
    currency string, event_date date, txn_count bigint, total_original_amount double, total_gbp_exposure double,
    avg_gbp_per_txn double, distinct_customers bigint, daily_avg_rate double, daily_low_rate double,
    daily_high_rate double, rate_risk_flag boolean, implied_rate double, gold_processed_ts timestamp,
    pipeline_version string
""")

AML_REPORT = _layout("""
    txn_id string, account_id string, customer_id string, counterparty_id string, txn_type string, channel string,
    amount double, currency string, gbp_amount double, country_code string, is_international boolean,
    merchant_mcc string, event_ts timestamp, event_date date, threshold_breach boolean, sanctions_hit boolean,
    structuring_flag boolean, high_risk_channel boolean, sar_candidate boolean, rolling_3d_gbp double,
    regulatory_status string, report_reference string, report_date date, report_period_start date,
    report_period_end date, report_generated_ts timestamp, pipeline_version string
""")

CAPITAL_EXPOSURE = _layout("""
    customer_id string, event_date date, total_gbp_exposure double, txn_count bigint, risk_weighted_assets double,
    largest_single_txn double, currency_count bigint, country_count bigint, international_txn_count bigint,
    sanctions_exposure_count bigint, exposure_pct_of_capital double, large_exposure_flag boolean,
    capital_adequacy_band string, report_date date, report_generated_ts timestamp, pipeline_version string
""")

FX_AUDIT = _layout("""
    run_ts timestamp, total_rows bigint, good_rows bigint, quarantine_rows bigint, quarantine_pct double,
    max_rate_age_mins double, stale_rate_count bigint, provider_stale boolean, rate_snapshot string,
    top_failure_reasons string, audit_status string
""")

MCC_AUDIT = _layout("""
    run_ts timestamp, mcc_total_rows bigint, mcc_quarantine_rows bigint, mcc_quarantine_pct double,
    mcc_files_processed bigint, mcc_top_failures string, audit_status string
""")

SANCTIONS_AUDIT = _layout("""
    run_ts timestamp, sanctions_total_rows bigint, sanctions_quarantine_rows bigint, sanctions_quarantine_pct double,
    sanctions_files_processed bigint, sanctions_top_failures string, audit_status string
""")

TXN_AUDIT = _layout("""
    run_ts timestamp, total_rows bigint, good_rows bigint, quarantine_rows bigint, quarantine_pct double,
    currency_dist string, top_failure_reasons string, audit_status string
""")

TXN_SILVER_AUDIT = _layout("""
    run_ts timestamp, total_rows bigint, quarantine_rows bigint, quarantine_pct double, sanctioned_count bigint,
    high_risk_count bigint, cross_border_count bigint, total_gbp_volume double, channel_dist string,
    top_failure_reasons string, audit_status string
""")

FX_SILVER_AUDIT = _layout("""
    run_ts timestamp, total_rows bigint, quarantine_rows bigint, quarantine_pct double, currency_pairs bigint,
    distinct_dates bigint, significant_move_count bigint, avg_rate_change_pct double, top_failure_reasons string,
    audit_status string
""")

DAILY_RISK_AUDIT = _layout("""
    run_ts timestamp, summary_days bigint, total_pipeline_gbp_volume double, high_risk_days bigint,
    total_sanctioned_hits bigint, anomaly_rows bigint, flagged_customers bigint, sanctioned_customers bigint,
    fx_exposure_rows bigint, fx_risk_flag_count bigint, risk_band_dist string, audit_status string
""")

REGULATORY_LOG = _layout("""
    run_id string, run_ts timestamp, report_date date, period_start date, period_end date, aml_total_rows bigint,
    aml_report_count bigint, aml_review_count bigint, basel_total_rows bigint, basel_breach_count bigint,
    basel_watch_count bigint, report_hash string, pipeline_version string, status string
""")

REGULATORY_AUDIT = _layout("""
    run_ts timestamp, aml_rows bigint, sar_count bigint, review_count bigint, sanctions_count bigint,
    basel_rows bigint, breach_count bigint, watch_count bigint, run_id string, report_hash string,
    log_status string, audit_status string
""")
