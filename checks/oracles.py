"""The registered queries in DuckDB SQL, written from the definitions and not from the Spark plans.

``VIEWS`` are common table expressions; ``_sql`` puts in front of a query those it needs.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2024-01-31 12:00:00'"
TODAY = "DATE '2024-01-31'"
INSIDE = "TIMESTAMP '2024-01-28 12:00:00'"
CCY = ("USD", "EUR", "AED", "NGN", "CNY", "CHF", "JPY", "SGD")
QUOTES = "(" + ", ".join(f"'{c}'" for c in CCY) + ")"
BRONZE_CCY = "('GBP', 'USD', 'EUR', 'AED', 'NGN', 'CNY')"
SILVER_CCY = "('GBP', " + QUOTES[1:]
TYPES = "('PURCHASE', 'TRANSFER', 'ATM_WITHDRAWAL', 'DIRECT_DEBIT', 'STANDING_ORDER', 'REFUND')"
CHANNELS = "('mobile_app', 'online_banking', 'branch', 'atm', 'pos_terminal')"
STAMP = f"{AS_OF} AS quarantine_ts, 'PENDING_REVIEW' AS quarantine_status"
INGESTED = f"{AS_OF} AS ingestion_ts, {TODAY} AS ingestion_date, '1.0.0' AS pipeline_version"
TXN_REASONS = f"""concat_ws(', ',
    CASE WHEN txn_id IS NULL THEN 'null_txn_id' END,
    CASE WHEN account_id IS NULL THEN 'null_account_id' END,
    CASE WHEN customer_id IS NULL THEN 'null_customer_id' END,
    CASE WHEN amount <= 0 THEN 'non_positive_amount' END,
    CASE WHEN event_ts IS NULL THEN 'null_event_ts' END,
    CASE WHEN currency NOT IN {BRONZE_CCY} THEN 'invalid_currency' END,
    CASE WHEN txn_type NOT IN {TYPES} THEN 'invalid_txn_type' END)"""
TXN_CLEAN = f"""txn_id IS NOT NULL AND account_id IS NOT NULL AND customer_id IS NOT NULL AND amount > 0
    AND event_ts IS NOT NULL AND currency IN {BRONZE_CCY} AND txn_type IN {TYPES}"""
FX_REASONS = f"""concat_ws(', ',
    CASE WHEN rate_id IS NULL THEN 'null_rate_id' END,
    CASE WHEN rate <= 0 THEN 'non_positive_rate' END,
    CASE WHEN fetch_ts IS NULL THEN 'null_fetch_ts' END,
    CASE WHEN base_currency <> 'GBP' THEN 'unexpected_base_currency' END,
    CASE WHEN quote_currency NOT IN {QUOTES} THEN 'unknown_quote_currency' END,
    CASE WHEN rate > 100000 THEN 'rate_suspiciously_high' END)"""
PARSED_TS = (
    "CASE WHEN regexp_matches(source_ts, '^\\w+,\\s*') THEN "
    "try_strptime(regexp_replace(regexp_replace(source_ts, '^\\w+,\\s*', ''), ' \\+0000$', ''), '%d %b %Y %H:%M:%S') END"
)


def parsed_from(stage: str) -> str:
    """Bronze FX parsing with one row per id, the latest fetched and then the highest rate."""
    return f"""
        SELECT rate_id, base_currency, quote_currency, rate, parsed AS source_ts, fetch_ts, provider, pipeline_version,
               CAST(fetch_ts AS DATE) AS rate_date,
               (epoch(date_trunc('second', fetch_ts)) - epoch(parsed)) / 60 AS rate_age_minutes,
               (epoch(date_trunc('second', fetch_ts)) - epoch(parsed)) / 60 > 30 AS is_stale
        FROM (SELECT *, {PARSED_TS} AS parsed,
                     row_number() OVER (PARTITION BY rate_id ORDER BY fetch_ts DESC NULLS LAST, rate DESC) AS rn
              FROM {stage} WHERE rate_id IS NOT NULL)
        WHERE rn = 1"""


def silver_from(parsed: str, extra: str = "TRUE") -> str:
    return f"""
        SELECT rate_id, base_currency, quote_currency, rate, source_ts, fetch_ts, rate_date, rate_age_minutes, prev_rate,
               rate_change_pct, daily_avg_rate, coalesce(abs(rate_change_pct) > 1.0, FALSE) AS significant_move,
               provider, {AS_OF} AS silver_processed_ts, '1.0.0' AS pipeline_version
        FROM (SELECT *, CASE WHEN prev_rate > 0 THEN round((rate - prev_rate) / prev_rate * 100, 6) END AS rate_change_pct
              FROM (SELECT *, lag(rate) OVER (PARTITION BY quote_currency ORDER BY fetch_ts NULLS FIRST, rate_id) AS prev_rate,
                           round(avg(rate) OVER (PARTITION BY quote_currency, rate_date), 6) AS daily_avg_rate
                    FROM {parsed} WHERE rate > 0 AND rate_id IS NOT NULL AND {extra}))
        WHERE fetch_ts IS NOT NULL"""


def gbp(op: str) -> str:
    """Conversion of an amount with the day's rates."""
    arms = " ".join(f"WHEN '{c}' THEN {op.format(rate=f'CAST(GBP_{c} AS DECIMAL(18,6))')}" for c in CCY)
    return f"CASE currency WHEN 'GBP' THEN amount {arms} END"


def mean(total: str, n: str, digits: int = 2) -> str:
    """Exact half-up mean of non-negative DECIMAL(…,2) values, from integers."""
    scale = 10**digits
    cents = f"CAST({total} * 100 AS HUGEINT)"
    return f"coalesce(((2 * {cents} * {scale} // 100 + {n}) // nullif(2 * {n}, 0)) / {scale}.0, 0.0)"


VIEWS = {
    "ev": """
        SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k, CAST(value AS DECIMAL(18,2)) AS v FROM events""",
    "txn_source": """
        SELECT CAST(event_id AS VARCHAR) AS txn_id, CAST(user_id % 97 AS VARCHAR) AS account_id,
               CAST(user_id AS VARCHAR) AS customer_id,
               CASE WHEN k % 5 < 3 THEN 'CP' || CAST(k + 100 * (event_id % 10) AS VARCHAR) END AS counterparty_id,
               CASE event_type WHEN 'purchase' THEN 'PURCHASE' WHEN 'click' THEN 'TRANSFER' WHEN 'view' THEN 'DIRECT_DEBIT'
                    WHEN 'signup' THEN 'ATM_WITHDRAWAL' WHEN 'error' THEN 'REFUND' END AS txn_type,
               CASE event_id % 6 WHEN 0 THEN 'mobile_app' WHEN 1 THEN 'online_banking' WHEN 2 THEN 'branch'
                    WHEN 3 THEN 'atm' WHEN 4 THEN 'pos_terminal' ELSE 'fax' END AS channel,
               CAST(CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 89 = 0 THEN v * -40 ELSE v * 40 END AS DECIMAL(18,2)) AS amount,
               CASE event_id % 12 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' WHEN 2 THEN 'AED' WHEN 3 THEN 'NGN' WHEN 4 THEN 'CNY'
                    WHEN 5 THEN 'XXX' WHEN 6 THEN NULL ELSE 'GBP' END AS currency,
               CASE WHEN k % 10 <> 0 THEN 'Merchant ' || CAST(k % 8 AS VARCHAR) END AS merchant_name,
               CASE WHEN k = 99 THEN '9999' WHEN k % 10 <> 0 THEN CAST(1000 + k AS VARCHAR) END AS merchant_mcc,
               CASE k % 8 WHEN 0 THEN 'US' WHEN 1 THEN 'NG' WHEN 2 THEN 'CN' WHEN 3 THEN 'AE' ELSE 'GB' END AS country_code,
               k % 8 < 4 AS is_international,
               CASE WHEN k % 10 >= 3 THEN 'DEV' || CAST(user_id % 5000 AS VARCHAR) END AS device_id,
               '10.0.' || CAST(k AS VARCHAR) || '.' || CAST(user_id % 256 AS VARCHAR) AS ip_address,
               ts AS event_ts, CAST(event_id % 1000000 AS INTEGER) AS kafka_offset, CAST(event_id % 8 AS INTEGER) AS kafka_partition
        FROM ev""",
    "txn_raw": f"SELECT *, {INGESTED}, 'kafka_simulator' AS source_system FROM txn_source",
    "txn_clean": f"SELECT * FROM txn_raw WHERE {TXN_CLEAN}",
    "txn_held": f"SELECT * FROM (SELECT *, {TXN_REASONS} AS failure_reasons FROM txn_source) WHERE failure_reasons <> ''",
    "fx_grouped": """
        SELECT date_trunc('day', ts) + to_hours(CAST(6 * (hour(ts) // 6) AS INTEGER)) AS fetch_ts, k % 8 AS i,
               CAST(sum(v) * 100 AS HUGEINT) AS cents, count(*) AS n FROM ev GROUP BY 1, 2""",
    "fx_stage": """
        SELECT 'GBP' || q || '_' || strftime(fetch_ts, '%Y%m%d%H%M') AS rate_id, 'GBP' AS base_currency, q AS quote_currency,
               rate, CASE WHEN i = 3 AND hour(fetch_ts) = 0 THEN NULL WHEN i = 2 AND hour(fetch_ts) = 18 THEN 'n/a'
                          ELSE strftime(fetch_ts - to_minutes(5 + 5 * i), '%a, %d %b %Y %H:%M:%S +0000') END AS source_ts,
               fetch_ts, 'exchangerate-api' AS provider, '1.0.0' AS pipeline_version
        FROM (SELECT *, ['USD', 'EUR', 'AED', 'NGN', 'CNY', 'CHF', 'JPY', 'SGD'][i + 1] AS q,
                     CAST((4 * cents + n) // (2 * n) AS DOUBLE) / 10000 AS rate FROM fx_grouped)""",
    "fx_faulty": """
        SELECT CASE WHEN NOT (d = 7 AND h = 0) THEN rate_id END AS rate_id,
               CASE WHEN d = 13 AND h = 6 THEN 'USD' ELSE base_currency END AS base_currency,
               CASE WHEN d = 15 AND h = 0 THEN 'XXX' ELSE quote_currency END AS quote_currency,
               CASE WHEN d = 17 AND h = 6 THEN -rate WHEN d = 19 AND h = 12 THEN rate * 10000000::DOUBLE ELSE rate END AS rate,
               source_ts, CASE WHEN NOT (d = 23 AND h = 18) THEN fetch_ts END AS fetch_ts, provider, pipeline_version
        FROM (SELECT *, day(fetch_ts) AS d, hour(fetch_ts) AS h FROM fx_stage)""",
    "fx_twice": "SELECT * FROM fx_faulty UNION ALL SELECT * REPLACE (rate + 0.5::DOUBLE AS rate) FROM fx_faulty",
    "fx_twice_parsed": parsed_from("fx_twice"),
    "fx_faulty_parsed": parsed_from("fx_faulty"),
    "fx_parsed": parsed_from("fx_stage"),
    "fx_held": f"SELECT * FROM (SELECT *, {FX_REASONS} AS failure_reasons FROM fx_faulty) WHERE failure_reasons <> ''",
    "fx_silver": silver_from("fx_parsed"),
    "fx_faulty_silver": silver_from("fx_faulty_parsed"),
    "fx_silver_held": f"""
        SELECT * FROM (SELECT *, concat_ws(', ',
            CASE WHEN rate_id IS NULL THEN 'null_rate_id' END, CASE WHEN rate <= 0 THEN 'non_positive_rate' END,
            CASE WHEN fetch_ts IS NULL THEN 'null_fetch_ts' END, CASE WHEN rate >= 100000 THEN 'rate_exceeds_ceiling' END,
            CASE WHEN quote_currency NOT IN {QUOTES} THEN 'unknown_currency' END) AS failure_reasons FROM fx_faulty_parsed)
        WHERE failure_reasons <> ''""",
    "fx_pivot": f"""
        SELECT fetch_ts, rate_date, base_currency,
               {", ".join(f"min_by(rate, rate_id) FILTER (WHERE quote_currency = '{c}') AS GBP_{c}" for c in CCY)},
               {AS_OF} AS silver_processed_ts, '1.0.0' AS pipeline_version
        FROM fx_silver GROUP BY fetch_ts, rate_date, base_currency""",
    "fx_daily": f"""
        SELECT rate_date AS event_date, {", ".join(f"GBP_{c}" for c in CCY)}
        FROM fx_pivot QUALIFY row_number() OVER (PARTITION BY rate_date ORDER BY fetch_ts DESC) = 1""",
    "mcc": """
        SELECT CAST(1000 + p_partkey % 500 AS VARCHAR) AS mcc_code, CASE WHEN p_partkey % 41 <> 0 THEN p_name END AS description,
               p_type AS category,
               CASE WHEN p_partkey % 37 = 0 THEN 'BAD' WHEN p_size <= 20 THEN 'LOW' WHEN p_size <= 40 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
               CASE WHEN p_partkey % 43 = 0 THEN '?' WHEN p_partkey % 4 = 0 THEN 'Y' WHEN p_partkey % 4 < 3 THEN 'N' END AS requires_enhanced_dd,
               '2024-01-01' AS effective_date, '2024-02-01' AS last_updated,
               'mcc_' || CAST(p_partkey // 500 AS VARCHAR) || '.csv' AS source_file,
               TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(p_partkey // 500 AS INTEGER)) AS source_file_modified_ts
        FROM part""",
    "mcc_held": """
        SELECT * FROM (SELECT *, concat_ws(', ',
            CASE WHEN mcc_code IS NULL THEN 'null_mcc_code' END, CASE WHEN description IS NULL THEN 'null_description' END,
            CASE WHEN risk_level NOT IN ('LOW', 'MEDIUM', 'HIGH') THEN 'invalid_risk_level' END,
            CASE WHEN requires_enhanced_dd NOT IN ('Y', 'N') THEN 'invalid_enhanced_dd_flag' END) AS failure_reasons FROM mcc)
        WHERE failure_reasons <> ''""",
    "mcc_levels": """
        SELECT mcc_code AS merchant_mcc, risk_level AS merchant_risk_level FROM mcc
        QUALIFY row_number() OVER (PARTITION BY mcc_code ORDER BY source_file_modified_ts DESC) = 1""",
    "sanctions": """
        SELECT 'CP' || CAST(s_suppkey AS VARCHAR) AS entity_id,
               ['INDIVIDUAL', 'ORGANISATION', 'VESSEL', 'AIRCRAFT', 'GHOST'][s_nationkey % 5 + 1] AS entity_type,
               CASE WHEN s_suppkey % 29 <> 28 THEN s_name END AS full_name, s_name AS aliases,
               CAST(s_nationkey AS VARCHAR) AS country_of_origin,
               ['OFAC_SDN', 'UN_CONSOLIDATED', 'EU_CONSOLIDATED', 'HMT_CONSOLIDATED', 'OFAC_CONSOLIDATED', 'NONE'][s_nationkey % 6 + 1] AS sanctions_program,
               '2023-06-15' AS listed_date, '2024-01-01' AS last_updated, s_acctbal > 9500 AS is_active,
               s_acctbal / 10000::DOUBLE AS risk_score, 'OFAC_SDN' AS source_list,
               'sanctions_' || CAST(s_suppkey // 100 AS VARCHAR) || '.json' AS source_file,
               TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(s_suppkey // 100 AS INTEGER)) AS source_file_modified_ts
        FROM supplier""",
    "sanctions_held": """
        SELECT * FROM (SELECT *, concat_ws(', ',
            CASE WHEN entity_id IS NULL THEN 'null_entity_id' END, CASE WHEN full_name IS NULL THEN 'null_full_name' END,
            CASE WHEN entity_type NOT IN ('INDIVIDUAL', 'ORGANISATION', 'VESSEL', 'AIRCRAFT') THEN 'invalid_entity_type' END,
            CASE WHEN sanctions_program NOT IN ('OFAC_SDN', 'UN_CONSOLIDATED', 'EU_CONSOLIDATED', 'HMT_CONSOLIDATED', 'OFAC_CONSOLIDATED')
                 THEN 'invalid_sanctions_program' END,
            CASE WHEN risk_score < 0 OR risk_score > 1 THEN 'risk_score_out_of_range' END) AS failure_reasons FROM sanctions)
        WHERE failure_reasons <> ''""",
    "active_ids": "SELECT DISTINCT entity_id AS counterparty_id FROM sanctions WHERE is_active",
    "silver": f"""
        SELECT t.*, CAST(round({gbp("amount * {rate}")}, 2) AS DECIMAL(18,2)) AS gbp_amount, l.merchant_risk_level,
               a.counterparty_id IS NOT NULL AS counterparty_sanctioned
        FROM (SELECT * REPLACE (coalesce(merchant_name, 'UNKNOWN') AS merchant_name, coalesce(merchant_mcc, '0000') AS merchant_mcc),
                     CAST(event_ts AS DATE) AS event_date, CAST(hour(event_ts) AS INTEGER) AS txn_hour,
                     CAST(dayofweek(event_ts) + 1 AS INTEGER) AS txn_day_of_week, country_code <> 'GB' AS is_cross_border,
                     coalesce(merchant_mcc IN ('9999', '6051', '7995', '5933', '5944'), FALSE) AS is_high_risk_merchant
              FROM txn_clean WHERE event_ts <= {AS_OF}) t
        LEFT JOIN fx_daily f ON f.event_date = t.event_date
        LEFT JOIN mcc_levels l ON l.merchant_mcc = t.merchant_mcc
        LEFT JOIN active_ids a ON a.counterparty_id = t.counterparty_id""",
    "silver_out": f"""
        SELECT txn_id, account_id, customer_id, counterparty_id, txn_type, channel, CAST(amount AS DOUBLE) AS amount, currency,
               CAST(gbp_amount AS DOUBLE) AS gbp_amount, merchant_name, merchant_mcc, merchant_risk_level, country_code,
               is_international, is_cross_border, is_high_risk_merchant, counterparty_sanctioned, device_id, ip_address,
               event_ts, event_date, txn_hour, txn_day_of_week, {AS_OF} AS silver_processed_ts, '1.0.0' AS pipeline_version
        FROM silver""",
    "silver_held": f"""
        SELECT * FROM (SELECT *, concat_ws(', ',
            CASE WHEN txn_id IS NULL THEN 'null_txn_id' END, CASE WHEN account_id IS NULL THEN 'null_account_id' END,
            CASE WHEN amount <= 0 THEN 'non_positive_amount' END, CASE WHEN amount >= 1000000 THEN 'amount_exceeds_ceiling' END,
            CASE WHEN event_ts IS NULL THEN 'null_event_ts' END, CASE WHEN event_ts > {AS_OF} THEN 'event_ts_in_future' END,
            CASE WHEN currency NOT IN {SILVER_CCY} THEN 'invalid_currency' END,
            CASE WHEN txn_type NOT IN {TYPES} THEN 'invalid_txn_type' END,
            CASE WHEN channel NOT IN {CHANNELS} THEN 'invalid_channel' END) AS failure_reasons FROM txn_clean)
        WHERE failure_reasons <> ''""",
    "risk_days": f"""
        SELECT event_date, count(*) AS n, coalesce(sum(gbp_amount), 0) AS gbp, count(DISTINCT customer_id) AS customers,
               count(DISTINCT account_id) AS accounts, count_if(is_high_risk_merchant) AS high_risk,
               coalesce(sum(gbp_amount) FILTER (WHERE is_high_risk_merchant), 0) AS high_risk_gbp,
               count_if(is_cross_border) AS cross_border,
               coalesce(sum(gbp_amount) FILTER (WHERE is_cross_border), 0) AS cross_border_gbp,
               count_if(counterparty_sanctioned) AS sanctioned, count_if(txn_hour BETWEEN 0 AND 5) AS night,
               count_if(txn_type = 'REFUND') AS refunds, {mean("sum(gbp_amount)", "count(gbp_amount)")} AS mean_gbp,
               coalesce(max(gbp_amount), 0) AS largest
        FROM silver GROUP BY event_date""",
    "risk": f"""
        SELECT event_date, CAST(n AS BIGINT) AS total_txn_count, CAST(gbp AS DOUBLE) AS total_gbp_volume,
               customers AS distinct_customers, accounts AS distinct_accounts, CAST(high_risk AS BIGINT) AS high_risk_txn_count,
               CAST(high_risk_gbp AS DOUBLE) AS high_risk_gbp_volume, CAST(cross_border AS BIGINT) AS cross_border_count,
               CAST(cross_border_gbp AS DOUBLE) AS cross_border_gbp_volume, CAST(sanctioned AS BIGINT) AS sanctioned_count,
               CAST(night AS BIGINT) AS late_night_count, CAST(refunds AS BIGINT) AS refund_count,
               round(refunds / n * 100, 4) AS refund_rate_pct, CAST(mean_gbp AS DOUBLE) AS avg_txn_gbp_value,
               CAST(largest AS DOUBLE) AS max_single_txn_gbp,
               CASE WHEN score >= 100 THEN 'CRITICAL' WHEN score >= 50 THEN 'HIGH' WHEN score >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS daily_risk_band,
               {AS_OF} AS gold_processed_ts, '1.0.0' AS pipeline_version
        FROM (SELECT *, (CASE WHEN sanctioned > 0 THEN 100 ELSE 0 END) + (CASE WHEN high_risk > n * 0.1::DOUBLE THEN 30 ELSE 0 END)
                   + (CASE WHEN cross_border / n > 0.3::DOUBLE THEN 20 ELSE 0 END) + (CASE WHEN night > n * 0.05::DOUBLE THEN 15 ELSE 0 END)
                   + (CASE WHEN round(refunds / n * 100, 4) > 5.0 THEN 10 ELSE 0 END) + (CASE WHEN largest > 10000 THEN 10 ELSE 0 END) AS score
              FROM risk_days)""",
    "anomalies": f"""
        SELECT *, velocity_flag OR large_txn_flag OR night_owl_flag OR cross_border_spike_flag OR sanctioned_flag OR multi_country_flag AS any_flag,
               {AS_OF} AS gold_processed_ts, '1.0.0' AS pipeline_version
        FROM (SELECT customer_id, event_date, count(*) AS daily_txn_count, CAST(count_if(is_cross_border) AS BIGINT) AS cross_border_count,
                     CAST(count_if(txn_hour BETWEEN 0 AND 5) AS BIGINT) AS night_txn_count,
                     CAST(coalesce(max(gbp_amount), 0) AS DOUBLE) AS max_single_txn_gbp,
                     CAST(count_if(counterparty_sanctioned) AS BIGINT) AS sanctioned_count,
                     count(DISTINCT country_code) AS distinct_countries,
                     CAST(coalesce(sum(gbp_amount), 0) AS DOUBLE) AS total_customer_gbp,
                     count(*) > 3 AS velocity_flag, coalesce(max(gbp_amount), 0) > 5000 AS large_txn_flag,
                     count_if(txn_hour BETWEEN 0 AND 5) > 0 AS night_owl_flag,
                     count_if(is_cross_border) / count(*) > 0.5::DOUBLE AS cross_border_spike_flag,
                     count_if(counterparty_sanctioned) > 0 AS sanctioned_flag, count(DISTINCT country_code) > 3 AS multi_country_flag
              FROM silver GROUP BY customer_id, event_date)""",
    "exposure": f"""
        SELECT t.currency, t.event_date, t.txn_count, CAST(t.orig AS DOUBLE) AS total_original_amount,
               CAST(t.gbp AS DOUBLE) AS total_gbp_exposure, CAST(t.mean_gbp AS DOUBLE) AS avg_gbp_per_txn, t.distinct_customers,
               r.daily_avg_rate, r.daily_low_rate, r.daily_high_rate, coalesce(r.moved, FALSE) AS rate_risk_flag,
               CASE WHEN t.orig > 0 THEN round(CAST(t.gbp AS DOUBLE) / CAST(t.orig AS DOUBLE), 6) END AS implied_rate,
               {AS_OF} AS gold_processed_ts, '1.0.0' AS pipeline_version
        FROM (SELECT currency, event_date, count(*) AS txn_count, coalesce(sum(amount), 0) AS orig, coalesce(sum(gbp_amount), 0) AS gbp,
                     {mean("sum(gbp_amount)", "count(gbp_amount)")} AS mean_gbp, count(DISTINCT customer_id) AS distinct_customers
              FROM silver WHERE currency <> 'GBP' GROUP BY currency, event_date) t
        LEFT JOIN (SELECT quote_currency, rate_date, round(avg(rate), 6) AS daily_avg_rate, round(min(rate), 6) AS daily_low_rate,
                          round(max(rate), 6) AS daily_high_rate, bool_or(significant_move) AS moved
                   FROM fx_silver GROUP BY quote_currency, rate_date) r
               ON r.quote_currency = t.currency AND r.rate_date = t.event_date""",
    "rolled": """
        SELECT *, sum(gbp_amount) OVER (PARTITION BY customer_id ORDER BY CAST(floor(epoch(event_ts)) AS BIGINT)
                                        RANGE BETWEEN 259200 PRECEDING AND CURRENT ROW) AS rolling FROM silver""",
    "aml": f"""
        SELECT txn_id, account_id, customer_id, counterparty_id, txn_type, channel, CAST(amount AS DOUBLE) AS amount, currency,
               CAST(gbp_amount AS DOUBLE) AS gbp_amount, country_code, is_international, merchant_mcc, event_ts, event_date,
               threshold_breach, counterparty_sanctioned AS sanctions_hit, structuring_flag,
               channel IN ('atm', 'online_banking') AND is_international AND gbp_amount > 3000 AS high_risk_channel,
               threshold_breach OR counterparty_sanctioned OR structuring_flag AS sar_candidate,
               CAST(rolling AS DOUBLE) AS rolling_3d_gbp,
               CASE WHEN counterparty_sanctioned THEN 'REPORT' WHEN threshold_breach OR structuring_flag THEN 'REVIEW' ELSE 'CLEAR' END AS regulatory_status,
               'AML-' || strftime(event_date, '%Y%m%d') || '-' || txn_id AS report_reference, {TODAY} AS report_date,
               CAST({TODAY} - 1 AS DATE) AS report_period_start, {TODAY} AS report_period_end, {AS_OF} AS report_generated_ts,
               '1.0.0' AS pipeline_version
        FROM (SELECT *, gbp_amount >= 10000 AS threshold_breach, rolling >= 9000 AND gbp_amount < 10000 AS structuring_flag FROM rolled)""",
    "capital": f"""
        SELECT customer_id, event_date, CAST(gbp AS DOUBLE) AS total_gbp_exposure, n AS txn_count, CAST(rwa AS DOUBLE) AS risk_weighted_assets,
               CAST(largest AS DOUBLE) AS largest_single_txn, currency_count, country_count, international_txn_count,
               sanctions_exposure_count, CAST(share AS DOUBLE) AS exposure_pct_of_capital, share > 10 AS large_exposure_flag,
               CASE WHEN sanctions_exposure_count > 0 OR share >= 10 THEN 'BREACH' WHEN share >= 7.5 THEN 'WATCH' ELSE 'ADEQUATE' END AS capital_adequacy_band,
               {TODAY} AS report_date, {AS_OF} AS report_generated_ts, '1.0.0' AS pipeline_version
        FROM (SELECT *, round(CAST(gbp AS DECIMAL(28,2)) * CAST(0.001 AS DECIMAL(4,3)), 4) AS share
              FROM (SELECT customer_id, event_date, count(*) AS n, coalesce(sum(gbp_amount), 0) AS gbp,
                           coalesce(round(sum(CAST(gbp_amount AS DECIMAL(18,2)) * CASE txn_type WHEN 'PURCHASE' THEN 1.00 WHEN 'TRANSFER' THEN 0.75
                               WHEN 'ATM_WITHDRAWAL' THEN 0.50 WHEN 'DIRECT_DEBIT' THEN 0.75 WHEN 'STANDING_ORDER' THEN 0.75
                               WHEN 'REFUND' THEN 0.00 END), 2), 0) AS rwa,
                           coalesce(max(gbp_amount), 0) AS largest, count(DISTINCT currency) AS currency_count,
                           count(DISTINCT country_code) AS country_count, CAST(count_if(is_international) AS BIGINT) AS international_txn_count,
                           CAST(count_if(counterparty_sanctioned) AS BIGINT) AS sanctions_exposure_count
                    FROM silver GROUP BY customer_id, event_date))""",
    "log_parts": """
        SELECT a.*, c.* FROM
          (SELECT count(*) AS aml_total_rows, CAST(count_if(regulatory_status = 'REPORT') AS BIGINT) AS aml_report_count,
                  CAST(count_if(regulatory_status = 'REVIEW') AS BIGINT) AS aml_review_count,
                  CAST(count_if(sanctions_hit) AS BIGINT) AS hits, min(event_date) AS period_start, max(event_date) AS period_end FROM aml) a,
          (SELECT count(*) AS basel_total_rows, CAST(count_if(capital_adequacy_band = 'BREACH') AS BIGINT) AS basel_breach_count,
                  CAST(count_if(capital_adequacy_band = 'WATCH') AS BIGINT) AS basel_watch_count FROM capital) c""",
    "log": f"""
        SELECT substr(report_hash, 1, 16) AS run_id, {AS_OF} AS run_ts, {TODAY} AS report_date, * EXCLUDE (hits), '1.0.0' AS pipeline_version,
               CASE WHEN basel_breach_count > 0 THEN 'BREACH_DETECTED' WHEN aml_report_count > 0 THEN 'SAR_REQUIRED'
                    WHEN aml_review_count > 0 THEN 'REVIEW_REQUIRED' ELSE 'CLEAR' END AS status
        FROM (SELECT *, sha256('aml_total=' || aml_total_rows || '|aml_report=' || aml_report_count || '|aml_review=' || aml_review_count
                || '|basel_total=' || basel_total_rows || '|basel_breach=' || basel_breach_count || '|period_start=' || period_start
                || '|period_end=' || period_end) AS report_hash FROM log_parts)""",
    "fraud_raw": """
        SELECT CAST(event_id AS VARCHAR) AS txn_id, CAST(user_id AS VARCHAR) AS user_id, value AS amount,
               CASE WHEN event_type = 'error' THEN 'Unknown' ELSE event_type END AS merchant, CAST(hour(ts) AS INTEGER) AS hour,
               CAST(value > 200 AS INTEGER) AS is_fraud, ts FROM ev""",
    "scored": """
        SELECT is_fraud, amount / CASE WHEN merchant = 'Unknown' THEN 1024 ELSE 512 END AS p,
               CAST(amount / CASE WHEN merchant = 'Unknown' THEN 1024 ELSE 512 END > 0.25::DOUBLE AS INTEGER) AS guess
        FROM fraud_raw""",
}


def _needs(sql: str, seen: list[str]) -> None:
    for name, body in VIEWS.items():
        if name not in seen and re.search(rf"\b(?:FROM|JOIN)\s+\(*\s*{name}\b", sql):
            _needs(body, seen)
            if name not in seen:
                seen.append(name)


def _sql(body: str) -> str:
    needed: list[str] = []
    _needs(body, needed)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed) + "\n" + body


def profile(view: str, rules: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS rule, CAST(count_if(coalesce({p}, FALSE)) AS BIGINT) AS passed, "
        f"CAST(count_if(NOT coalesce({p}, FALSE)) AS BIGINT) AS failed FROM {view}"
        for n, p in rules.items()
    )


def top_json(view: str, count: str = "count") -> str:
    """Five most frequent reasons as a JSON array."""
    return f"""(SELECT '[' || coalesce(string_agg('{{"failure_reasons":"' || failure_reasons || '","{count}":' || n || '}}', ',' ORDER BY n DESC, failure_reasons), '') || ']'
        FROM (SELECT failure_reasons, count(*) AS n FROM {view} GROUP BY 1 ORDER BY n DESC, failure_reasons LIMIT 5))"""


def map_json(view: str, key: str) -> str:
    return f"""(SELECT '{{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}}'
        FROM (SELECT coalesce({key}, 'NULL') AS k, count(*) AS n FROM {view} GROUP BY 1))"""


def share(q: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN round({q} / {total} * 100, 4) ELSE 0.0 END"


def features(where: str = "TRUE") -> str:
    return f"""SELECT user_id, count(txn_id) AS txn_count_7d, round(avg(amount), 6) AS avg_amount_7d, max(amount) AS max_amount_7d,
        round(stddev_samp(amount), 6) AS std_amount_7d, CAST(count_if(merchant = 'Unknown') AS BIGINT) AS unknown_merchant_count
        FROM fraud_raw WHERE {where} GROUP BY user_id"""


def files_audit(view: str, held: str, p: str) -> str:
    return f"""SELECT {AS_OF} AS run_ts, *, CASE WHEN {p}_total_rows > 0 AND {p}_quarantine_pct <= 5.0 THEN 'PASS' ELSE 'FAIL' END AS audit_status
        FROM (SELECT *, {share(f"{p}_quarantine_rows", f"{p}_total_rows")} AS {p}_quarantine_pct
              FROM (SELECT count(*) AS {p}_total_rows, count(DISTINCT source_file) AS {p}_files_processed,
                           (SELECT count(*) FROM {held}) AS {p}_quarantine_rows, {top_json(held)} AS {p}_top_failures FROM {view}))"""


TXN_SILVER_AUDIT = f"""SELECT {AS_OF} AS run_ts, *, CASE WHEN total_rows = 0 OR quarantine_pct > 5.0 OR sanctioned_count > 0 THEN 'FAIL' ELSE 'PASS' END AS audit_status
    FROM (SELECT *, {share("quarantine_rows", "total_rows")} AS quarantine_pct
          FROM (SELECT count(*) AS total_rows, (SELECT count(*) FROM silver_held) AS quarantine_rows,
                       CAST(count_if(counterparty_sanctioned) AS BIGINT) AS sanctioned_count,
                       CAST(count_if(is_high_risk_merchant) AS BIGINT) AS high_risk_count,
                       CAST(count_if(is_cross_border) AS BIGINT) AS cross_border_count,
                       CAST(coalesce(sum(gbp_amount), 0) AS DOUBLE) AS total_gbp_volume,
                       {map_json("silver", "channel")} AS channel_dist, {top_json("silver_held")} AS top_failure_reasons FROM silver))"""

SANCTION_ROWS = f"SELECT * EXCLUDE (source_file, source_file_modified_ts), {INGESTED} FROM sanctions"
HELD_TXN = f"SELECT *, {INGESTED}, 'kafka_simulator' AS source_system, {STAMP} FROM txn_held"
FATE = f"""SELECT CASE WHEN c AND q THEN 'both' WHEN c THEN 'clean' WHEN q THEN 'quarantine' ELSE 'unaccounted' END AS row_fate, count(*) AS row_count
    FROM (SELECT coalesce({TXN_CLEAN}, FALSE) AS c, {TXN_REASONS} <> '' OR {{extra}} AS q FROM txn_source) GROUP BY 1"""
FLAGGED = """SELECT t.txn_id, t.counterparty_id, a.counterparty_id IS NOT NULL AS counterparty_sanctioned
    FROM txn_clean t LEFT JOIN active_ids a ON a.counterparty_id = t.counterparty_id"""

BODIES = {
    # quality framework
    "expectation_profile": profile("txn_source", {
        "valid_txn_id": "txn_id IS NOT NULL", "valid_account_id": "account_id IS NOT NULL", "positive_amount": "amount > 0",
        "valid_event_ts": "event_ts IS NOT NULL", "known_currency": f"currency IN {BRONZE_CCY}", "known_txn_type": f"txn_type IN {TYPES}"}),
    "expectation_profile_fx": profile("fx_faulty", {
        "valid_rate_id": "rate_id IS NOT NULL", "positive_rate": "rate > 0", "valid_fetch_ts": "fetch_ts IS NOT NULL",
        "known_quote_ccy": f"quote_currency IN {QUOTES}"}),
    "expectation_profile_mcc": profile("mcc", {
        "valid_mcc_code": "mcc_code IS NOT NULL", "valid_risk_level": "risk_level IN ('LOW', 'MEDIUM', 'HIGH')",
        "valid_enhanced_dd": "requires_enhanced_dd IN ('Y', 'N')", "valid_description": "description IS NOT NULL"}),
    "expectation_profile_sanctions": profile("sanctions", {
        "valid_entity_id": "entity_id IS NOT NULL", "valid_full_name": "full_name IS NOT NULL",
        "valid_entity_type": "entity_type IN ('INDIVIDUAL', 'ORGANISATION', 'VESSEL', 'AIRCRAFT')",
        "valid_risk_score": "risk_score BETWEEN 0.0 AND 1.0",
        "valid_sanctions_program": "sanctions_program IN ('OFAC_SDN', 'UN_CONSOLIDATED', 'EU_CONSOLIDATED', 'HMT_CONSOLIDATED', 'OFAC_CONSOLIDATED')"}),
    "expectation_metrics": profile("txn_source", {
        "valid_txn_id": "txn_id IS NOT NULL", "valid_account_id": "account_id IS NOT NULL", "positive_amount": "amount > 0",
        "valid_event_ts": "event_ts IS NOT NULL", "known_currency": f"currency IN {BRONZE_CCY}", "known_txn_type": f"txn_type IN {TYPES}"}),
    "merchant_distribution_bounded": """SELECT CASE WHEN r <= 3 THEN m ELSE '(others)' END AS merchant_name, CAST(sum(n) AS BIGINT) AS count
        FROM (SELECT *, row_number() OVER (ORDER BY n DESC, m) AS r
              FROM (SELECT coalesce(merchant_name, 'NULL') AS m, count(*) AS n FROM txn_source GROUP BY 1)) GROUP BY 1""",
    "distinct_sketches": """SELECT CAST(date_trunc('week', event_ts) AS DATE) AS week, count(DISTINCT customer_id) AS customers,
        count(DISTINCT txn_id) AS txns, TRUE AS within_bound FROM txn_source GROUP BY 1""",
    "mcc_malformed": f"""SELECT 'c' || p_partkey AS mcc_code, CAST(p_size AS VARCHAR) AS description, NULL AS category, NULL AS risk_level,
        NULL AS requires_enhanced_dd, NULL AS effective_date, NULL AS last_updated, 'c' || p_partkey || ',' || p_size AS broken_record,
        'malformed_record' AS failure_reasons, {STAMP} FROM part WHERE p_partkey % 41 = 0""",
    "expect_or_drop": f"""SELECT txn_id, amount, currency, event_ts FROM txn_source
        WHERE amount > 0 AND event_ts <= {AS_OF} AND currency IN {SILVER_CCY} AND account_id IS NOT NULL""",
    "expect_or_fail": "SELECT txn_id, account_id, amount FROM txn_clean",
    "row_fate": FATE.format(extra="FALSE"),
    "row_fate_strict_nulls": FATE.format(extra="amount IS NULL OR currency IS NULL OR txn_type IS NULL"),
    "top_reasons": "SELECT failure_reasons, count(*) AS count FROM txn_held GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5",
    "currency_distribution": "SELECT coalesce(currency, 'NULL') AS currency, count(*) AS count FROM txn_source GROUP BY 1",
    "quarantine_share_by_channel": f"""SELECT channel, round(count_if({TXN_REASONS} <> '') / count(*) * 100, 4) AS quarantine_pct
        FROM txn_source GROUP BY channel""",
    "gate_checks": f"""SELECT unnest(['has_rows', 'quarantine_rate', 'no_sanctioned', 'status_pass']) AS check,
        unnest([total_rows > 0, quarantine_pct <= 5.0, sanctioned_count = 0, audit_status = 'PASS']) AS passed FROM ({TXN_SILVER_AUDIT})""",
    # bronze
    "fx_raw": "SELECT * FROM fx_faulty",
    "fx_parsed": "SELECT * FROM fx_twice_parsed",
    "fx_quarantine": f"SELECT *, {STAMP} FROM fx_held",
    "fx_audit": f"""SELECT {AS_OF} AS run_ts, *, max_rate_age_mins > 30 AS provider_stale,
            CASE WHEN total_rows = 0 OR quarantine_pct > 5.0 OR stale_rate_count > 0 THEN 'FAIL' ELSE 'PASS' END AS audit_status
        FROM (SELECT *, {share("quarantine_rows", "total_rows")} AS quarantine_pct
              FROM (SELECT (SELECT count(*) FROM fx_faulty) AS total_rows, count(*) AS good_rows,
                           (SELECT count(*) FROM fx_held) AS quarantine_rows, coalesce(max(rate_age_minutes), 0.0) AS max_rate_age_mins,
                           CAST(count_if(is_stale) AS BIGINT) AS stale_rate_count,
                           (SELECT '{{' || string_agg('"' || q || '":' || r, ',' ORDER BY q) || '}}' FROM
                               (SELECT quote_currency AS q, round(arg_max(rate, (fetch_ts, rate_id)), 6) AS r
                                FROM fx_faulty_parsed WHERE fetch_ts IS NOT NULL GROUP BY 1)) AS rate_snapshot,
                           {top_json("fx_held")} AS top_failure_reasons FROM fx_faulty_parsed))""",
    "fx_from_payload": f"""SELECT * REPLACE (strftime(fetch_ts, '%Y-%m-%d') AS source_ts) FROM fx_stage
        WHERE hour(fetch_ts) <> 18""",
    "mcc_ingest": f"SELECT * EXCLUDE (source_file, source_file_modified_ts), {INGESTED} FROM mcc",
    "mcc_quarantine": f"SELECT *, {STAMP} FROM mcc_held",
    "mcc_audit": files_audit("mcc", "mcc_held", "mcc"),
    "sanctions_from_documents": f"SELECT *, {INGESTED} FROM sanctions",
    "sanctions_ingest": SANCTION_ROWS,
    "sanctions_quarantine": f"SELECT * EXCLUDE (aliases), {STAMP} FROM sanctions_held",
    "sanctions_audit": files_audit("sanctions", "sanctions_held", "sanctions"),
    "txn_ingest": "SELECT * FROM txn_raw",
    "txn_quarantine": HELD_TXN,
    "txn_clean": "SELECT * FROM txn_clean",
    "txn_audit": f"""SELECT {AS_OF} AS run_ts, *, CASE WHEN total_rows > 0 AND quarantine_pct < 10.0 THEN 'PASS' ELSE 'FAIL' END AS audit_status
        FROM (SELECT *, {share("quarantine_rows", "total_rows")} AS quarantine_pct
              FROM (SELECT count(*) AS total_rows, (SELECT count(*) FROM txn_clean) AS good_rows, (SELECT count(*) FROM txn_held) AS quarantine_rows,
                           {map_json("txn_source", "currency")} AS currency_dist, {top_json("txn_held", "cnt")} AS top_failure_reasons FROM txn_source))""",
    # silver
    "txn_silver": "SELECT * FROM silver_out",
    "txn_silver_stream": "SELECT * FROM silver_out",
    "txn_high_risk": """SELECT * FROM silver_out WHERE counterparty_sanctioned OR is_high_risk_merchant
        OR (is_cross_border AND gbp_amount > 5000) OR (txn_hour BETWEEN 0 AND 5 AND gbp_amount > 1000)""",
    "txn_silver_quarantine": f"SELECT *, 'silver' AS quarantine_layer, {STAMP} FROM silver_held",
    "txn_silver_audit": TXN_SILVER_AUDIT,
    "fx_silver": "SELECT * FROM fx_silver",
    "fx_silver_without_stale": silver_from("fx_parsed", "NOT coalesce(is_stale, FALSE)"),
    "fx_pivot": "SELECT * FROM fx_pivot",
    "fx_pivot_required": "SELECT * FROM fx_pivot WHERE GBP_USD IS NOT NULL AND GBP_EUR IS NOT NULL",
    "fx_silver_quarantine": f"SELECT *, 'silver' AS quarantine_layer, {STAMP} FROM fx_silver_held",
    "fx_silver_audit": f"""SELECT {AS_OF} AS run_ts, *, CASE WHEN total_rows = 0 OR quarantine_pct > 5.0 OR currency_pairs < 8 THEN 'FAIL' ELSE 'PASS' END AS audit_status
        FROM (SELECT *, {share("quarantine_rows", "total_rows")} AS quarantine_pct
              FROM (SELECT count(*) AS total_rows, (SELECT count(*) FROM fx_silver_held) AS quarantine_rows,
                           count(DISTINCT quote_currency) AS currency_pairs, count(DISTINCT rate_date) AS distinct_dates,
                           CAST(count_if(significant_move) AS BIGINT) AS significant_move_count,
                           coalesce(round(avg(rate_change_pct), 6), 0.0) AS avg_rate_change_pct,
                           {top_json("fx_silver_held")} AS top_failure_reasons FROM fx_faulty_silver))""",
    # joins and money
    "join_fx": "SELECT t.txn_id, CAST(t.event_ts AS DATE) AS event_date, f.* EXCLUDE (event_date) FROM txn_clean t LEFT JOIN fx_daily f ON f.event_date = CAST(t.event_ts AS DATE)",
    "join_mcc": """SELECT t.txn_id, coalesce(t.merchant_mcc, '0000') AS merchant_mcc, l.merchant_risk_level
        FROM txn_clean t LEFT JOIN mcc_levels l ON l.merchant_mcc = coalesce(t.merchant_mcc, '0000')""",
    "flag_sanctioned": FLAGGED,
    "flag_sanctioned_large_list": FLAGGED,
    "to_base_inverted": f"""SELECT txn_id, currency, CAST(round({gbp("CAST(amount AS DOUBLE) / CAST({rate} AS DOUBLE)")}, 2) AS DOUBLE) AS gbp_amount
        FROM txn_clean t LEFT JOIN fx_daily f ON f.event_date = CAST(t.event_ts AS DATE)""",
    # gold
    "daily_risk_summary": "SELECT * FROM risk",
    "daily_anomaly_flags": "SELECT * FROM anomalies",
    "daily_fx_exposure": "SELECT * FROM exposure",
    "daily_risk_audit": f"""SELECT {AS_OF} AS run_ts, *, CASE WHEN summary_days = 0 OR total_sanctioned_hits > 0 OR sanctioned_customers > 0 THEN 'FAIL' ELSE 'PASS' END AS audit_status
        FROM (SELECT count(*) AS summary_days, round(sum(total_gbp_volume), 2) AS total_pipeline_gbp_volume,
                     CAST(count_if(daily_risk_band IN ('HIGH', 'CRITICAL')) AS BIGINT) AS high_risk_days,
                     CAST(sum(sanctioned_count) AS BIGINT) AS total_sanctioned_hits, {map_json("risk", "daily_risk_band")} AS risk_band_dist FROM risk),
             (SELECT count(*) AS anomaly_rows, CAST(count_if(any_flag) AS BIGINT) AS flagged_customers,
                     CAST(count_if(sanctioned_flag) AS BIGINT) AS sanctioned_customers FROM anomalies),
             (SELECT count(*) AS fx_exposure_rows, CAST(count_if(rate_risk_flag) AS BIGINT) AS fx_risk_flag_count FROM exposure)""",
    "aml_report": "SELECT * FROM aml",
    "capital_exposure": "SELECT * FROM capital",
    "regulatory_log": "SELECT * FROM log",
    "regulatory_audit": f"""SELECT {AS_OF} AS run_ts, p.aml_total_rows AS aml_rows, p.aml_report_count AS sar_count, p.aml_review_count AS review_count,
            p.hits AS sanctions_count, p.basel_total_rows AS basel_rows, p.basel_breach_count AS breach_count, p.basel_watch_count AS watch_count,
            l.run_id, l.report_hash, l.status AS log_status,
            CASE WHEN p.aml_total_rows = 0 OR p.basel_total_rows = 0 OR p.hits > 0 OR p.basel_breach_count > 0 THEN 'FAIL' ELSE 'PASS' END AS audit_status
        FROM log_parts p, (SELECT * FROM log) l""",
    # aggregates and keys
    "aggregates_by_type": f"""SELECT txn_type, count(*) AS row_count, CAST(count_if(country_code <> 'GB') AS BIGINT) AS foreign_count,
            CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total, CAST(coalesce(sum(amount) FILTER (WHERE currency = 'USD'), 0) AS DOUBLE) AS usd_total,
            CAST({mean("sum(amount)", "count(amount)")} AS DOUBLE) AS mean, CAST(coalesce(max(amount), 0) AS DOUBLE) AS largest,
            count(DISTINCT counterparty_id) AS counterparties, bool_or(is_international) AS any_international,
            round(stddev_samp(CAST(amount AS DOUBLE)), 4) AS deviation FROM txn_source GROUP BY txn_type""",
    "count_rows_by_day_and_currency": "SELECT CAST(event_ts AS DATE) AS event_date, currency, count(*) AS row_count FROM txn_source GROUP BY 1, 2",
    "weighted_sum": """SELECT currency, CAST(coalesce(round(sum(amount * CASE txn_type WHEN 'PURCHASE' THEN 1.00 WHEN 'ATM_WITHDRAWAL' THEN 0.50
            WHEN 'DIRECT_DEBIT' THEN 0.75 WHEN 'REFUND' THEN 0.00 END), 2), 0) AS DOUBLE) AS weighted FROM txn_source GROUP BY currency""",
    "content_hash": "SELECT sha256('rows=' || count(*) || '|first=' || min(currency) || '|last=' || max(country_code) || '|none=None') AS digest FROM txn_source",
    "latest_row": "SELECT * FROM txn_source ORDER BY event_ts DESC, CAST(txn_id AS BIGINT) DESC LIMIT 1",
    "dedupe_newest": """SELECT * FROM txn_source QUALIFY row_number() OVER
        (PARTITION BY customer_id, txn_type ORDER BY event_ts DESC, CAST(txn_id AS BIGINT) DESC) = 1""",
    "latest_rate_per_currency": """SELECT quote_currency, rate, fetch_ts FROM fx_stage
        QUALIFY row_number() OVER (PARTITION BY quote_currency ORDER BY fetch_ts DESC, rate_id DESC) = 1""",
    "rate_snapshot": "SELECT quote_currency, round(arg_max(rate, (fetch_ts, rate_id)), 6) AS rate FROM fx_parsed GROUP BY 1",
    "pivot_channels": "SELECT customer_id, "
        + ", ".join(f"CAST(sum(amount) FILTER (WHERE channel = '{c}') AS DOUBLE) AS {c}"
                    for c in ("mobile_app", "online_banking", "branch", "atm", "pos_terminal"))
        + " FROM txn_source GROUP BY customer_id",
    "top_customers": """SELECT customer_id, CAST(coalesce(sum(amount), 0) AS DOUBLE) AS total FROM txn_source
        GROUP BY 1 ORDER BY coalesce(sum(amount), 0) DESC, customer_id LIMIT 5""",
    "key_violations": """SELECT account_id, counterparty_id, count(*) AS row_count FROM txn_source GROUP BY 1, 2
        HAVING count(*) > 1 OR account_id IS NULL OR counterparty_id IS NULL""",
    "upsert": f"""SELECT a.user_id, coalesce(b.txn_count_7d, a.txn_count_7d) AS txn_count_7d, coalesce(b.max_amount_7d, a.max_amount_7d) AS max_amount_7d,
            coalesce(b.unknown_merchant_count, a.unknown_merchant_count) AS unknown_merchant_count
        FROM ({features()}) a LEFT JOIN ({features("merchant = 'purchase'")}) b ON a.user_id = b.user_id""",
    "customer_risk_points": """SELECT customer_id, refund_rate_pct, risk_score, CASE WHEN risk_score >= 100 THEN 'CRITICAL' WHEN risk_score >= 50 THEN 'HIGH'
            WHEN risk_score >= 20 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band
        FROM (SELECT customer_id, refund_rate_pct, CAST((CASE WHEN risky > n * 0.1::DOUBLE THEN 30 ELSE 0 END)
                + (CASE WHEN abroad / n > 0.3::DOUBLE THEN 20 ELSE 0 END) + (CASE WHEN night > n * 0.05::DOUBLE THEN 15 ELSE 0 END)
                + (CASE WHEN refund_rate_pct > 5.0 THEN 10 ELSE 0 END) + (CASE WHEN largest > 10000 THEN 10 ELSE 0 END) AS INTEGER) AS risk_score
              FROM (SELECT customer_id, count(*) AS n, count_if(merchant_mcc = '9999') AS risky, count_if(country_code <> 'GB') AS abroad,
                           count_if(hour(event_ts) BETWEEN 0 AND 5) AS night, max(amount) AS largest,
                           round(count_if(txn_type = 'REFUND') / count(*) * 100, 4) AS refund_rate_pct FROM txn_source GROUP BY customer_id))""",
    # windows
    "rate_change": """SELECT rate_id, rate, prev_rate, change AS rate_change_pct, coalesce(abs(change) > 5.0, FALSE) AS significant_move
        FROM (SELECT *, CASE WHEN prev_rate > 0 THEN round((rate - prev_rate) / prev_rate * 100, 6) END AS change
              FROM (SELECT *, lag(rate) OVER (PARTITION BY quote_currency ORDER BY fetch_ts, rate_id) AS prev_rate FROM fx_parsed))""",
    "daily_average": "SELECT rate_id, rate_date, round(avg(rate) OVER (PARTITION BY quote_currency, rate_date), 6) AS daily_avg_rate FROM fx_parsed",
    "rolling_sum": """SELECT txn_id, account_id, CAST(sum(amount) OVER (PARTITION BY account_id ORDER BY CAST(floor(epoch(event_ts)) AS BIGINT)
        RANGE BETWEEN 604800 PRECEDING AND CURRENT ROW) AS DOUBLE) AS rolling_7d FROM txn_source""",
    "structuring": "SELECT txn_id, rolling >= 9000 AND gbp_amount < 10000 AS structuring_flag FROM rolled",
    # streaming
    "txn_quarantine_stream": HELD_TXN,
    "dedupe_stream": "SELECT DISTINCT txn_id, customer_id, event_ts FROM txn_source",
    "late_rows": """SELECT event_id, event_ts, batch_id FROM
          (SELECT event_id, ts AS event_ts, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + CASE WHEN k < 10 THEN 4 ELSE 0 END AS INTEGER) AS batch_id FROM ev) e
        JOIN (SELECT b, max(peak) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL 1 HOUR AS mark
              FROM (SELECT CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + CASE WHEN k < 10 THEN 4 ELSE 0 END AS INTEGER) AS b,
                           date_trunc('millisecond', max(ts)) AS peak FROM ev GROUP BY 1)) m ON m.b = e.batch_id
        WHERE event_ts <= mark""",
    # features and model
    "user_features": features(),
    "user_features_windowed": features(f"ts <= {AS_OF} AND ts >= {AS_OF} - INTERVAL 7 DAY"),
    "training_set": f"""SELECT r.txn_id, r.amount, r.hour, f.txn_count_7d, f.avg_amount_7d, f.max_amount_7d,
            coalesce(f.std_amount_7d, 0.0) AS std_amount_7d, f.unknown_merchant_count, r.is_fraud
        FROM fraud_raw r LEFT JOIN ({features()}) f ON f.user_id = r.user_id""",
    "stratified_split": """SELECT txn_id, CASE WHEN CAST('0x' || substr(md5(CAST(is_fraud AS VARCHAR) || '|' || txn_id || '|42'), 1, 8) AS BIGINT) % 1000 < 800
        THEN 'train' ELSE 'test' END AS side FROM fraud_raw""",
    "confusion": "SELECT is_fraud AS actual, guess AS predicted, count(*) AS row_count FROM scored GROUP BY 1, 2",
    "class_report": """SELECT class, round(coalesce(hit / nullif(claimed, 0), 0.0), 4) AS precision, round(coalesce(hit / nullif(support, 0), 0.0), 4) AS recall,
            round(coalesce(2 * hit / nullif(claimed + support, 0), 0.0), 4) AS f1, support
        FROM (SELECT 'legit' AS class, count_if(is_fraud = 0 AND guess = 0) AS hit, count_if(guess = 0) AS claimed, CAST(count_if(is_fraud = 0) AS BIGINT) AS support FROM scored
              UNION ALL SELECT 'fraud', count_if(is_fraud = 1 AND guess = 1), count_if(guess = 1), CAST(count_if(is_fraud = 1) AS BIGINT) FROM scored)""",
    "report_averages": """SELECT average, round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1, round(accuracy, 4) AS accuracy, CAST(support AS BIGINT) AS support
        FROM (SELECT unnest(['macro', 'weighted']) AS average, unnest([avg(p), sum(p * support) / sum(support)]) AS precision, unnest([avg(r), sum(r * support) / sum(support)]) AS recall,
                     unnest([avg(f), sum(f * support) / sum(support)]) AS f1, sum(hit) / sum(support) AS accuracy, sum(support) AS support
              FROM (SELECT coalesce(hit / nullif(claimed, 0), 0.0) AS p, coalesce(hit / nullif(support, 0), 0.0) AS r, coalesce(2 * hit / nullif(claimed + support, 0), 0.0) AS f, hit, support
                    FROM (SELECT count_if(is_fraud = k AND guess = k) AS hit, count_if(guess = k) AS claimed, count_if(is_fraud = k) AS support
                          FROM scored CROSS JOIN (VALUES (0), (1)) v(k) GROUP BY k)))""",
    "auc": """SELECT round((sum(place) FILTER (is_fraud = 1) - p1 * (p1 + 1) / 2) / (p1 * p0), 4) AS auc
        FROM (SELECT is_fraud, rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS place,
                     count_if(is_fraud = 1) OVER () AS p1, count_if(is_fraud = 0) OVER () AS p0 FROM scored)
        GROUP BY p1, p0""",
    "stratified_split_exact": """SELECT txn_id, CASE WHEN row_number() OVER (PARTITION BY is_fraud ORDER BY CAST('0x' || substr(md5(
            CAST(is_fraud AS VARCHAR) || '|' || txn_id || '|42'), 1, 15) AS BIGINT), txn_id) <= floor(0.2 * count(*) OVER (PARTITION BY is_fraud) + 0.5)
            THEN 'test' ELSE 'train' END AS side FROM fraud_raw""",
    "roc_curve": """SELECT p AS threshold, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp,
            round(sum(pos) OVER w / sum(pos) OVER (), 9) AS tpr, round(sum(neg) OVER w / sum(neg) OVER (), 9) AS fpr
        FROM (SELECT p, count_if(is_fraud = 1) AS pos, count_if(is_fraud = 0) AS neg FROM scored GROUP BY p) WINDOW w AS (ORDER BY p DESC)""",
    "fraud_scores": """SELECT side, is_fraud, count(*) AS row_count, count(*) AS sound, TRUE AS separates FROM (
            SELECT is_fraud, CASE WHEN row_number() OVER (PARTITION BY is_fraud ORDER BY CAST('0x' || substr(md5(
            CAST(is_fraud AS VARCHAR) || '|' || txn_id || '|42'), 1, 15) AS BIGINT), txn_id) <= floor(0.2 * count(*) OVER (PARTITION BY is_fraud) + 0.5)
            THEN 'test' ELSE 'train' END AS side FROM fraud_raw) GROUP BY side, is_fraud""",
    "fraud_scores_stream": """SELECT CASE WHEN CAST(txn_id AS BIGINT) % 2 = 0 THEN 'first' ELSE 'second' END AS model, count(*) AS row_count,
            count(*) AS as_batch FROM fraud_raw GROUP BY 1""",
    "roc_points": """SELECT bin / 64 AS threshold, round(sum(neg) OVER (ORDER BY bin DESC) / nullif(sum(neg) OVER (), 0), 6) AS fpr,
            round(sum(pos) OVER (ORDER BY bin DESC) / nullif(sum(pos) OVER (), 0), 6) AS tpr
        FROM (SELECT least(CAST(floor(p * 64) AS INTEGER), 63) AS bin, count_if(is_fraud = 1) AS pos, count_if(is_fraud = 0) AS neg FROM scored GROUP BY 1)""",
}

ORACLES = {name: _sql(body) for name, body in BODIES.items()}
# These run inside the data, so that the rules on future events find some.
for _name in ("expect_or_drop", "txn_silver"):
    ORACLES[_name] = ORACLES[_name].replace(AS_OF, INSIDE)
for _text in (f"event_ts > {AS_OF}", f"{AS_OF} AS quarantine_ts"):
    ORACLES["txn_silver_quarantine"] = ORACLES["txn_silver_quarantine"].replace(_text, _text.replace(AS_OF, INSIDE))
