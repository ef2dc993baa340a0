"""Gold: daily risk, customer anomalies, FX exposure and the regulatory reports.

The transaction table is the large input.  Aggregations with several distinct counts first
roll it up to the finest needed grain, so that Spark expands the small roll-up and not the
transactions, and a hot day or customer is merged from partial sums.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens import values as V
from ledgerlens.functions import domain
from ledgerlens.functions.columns import (
    any_holds,
    any_true,
    avg0,
    count_where,
    distinct,
    max0,
    pct,
    query_time,
    ratio0,
    sum0,
    weight_of,
)
from ledgerlens.operators.relational import conform
from ledgerlens.operators.windows import rolling_sum
from ledgerlens.plans import contracts as C

AsOf = Column | datetime | None


def _stamped(as_of: AsOf, ts_column: str = "gold_processed_ts") -> dict[str, Column]:
    return {ts_column: query_time(as_of), "pipeline_version": F.lit(V.PIPELINE_VERSION)}


# -- daily risk ---------------------------------------------------------------
def daily_risk_summary(
    txn: DataFrame, as_of: AsOf = None, approx: bool = False, night_hours: tuple[int, int] = V.NIGHT_HOURS
) -> DataFrame:
    """One row per day: volumes, counts, refund rate and the risk band of the additive score."""
    gbp = F.col("gbp_amount")
    night = domain.in_night("txn_hour", night_hours)
    rollup = txn.groupBy("event_date", "customer_id", "account_id").agg(
        F.count("*").alias("n"),
        F.count(gbp).alias("n_gbp"),
        F.sum(gbp).alias("gbp"),
        F.max(gbp).alias("largest"),
        count_where("is_high_risk_merchant").alias("high_risk"),
        F.sum(F.when(F.col("is_high_risk_merchant"), gbp)).alias("high_risk_gbp"),
        count_where("is_cross_border").alias("cross_border"),
        F.sum(F.when(F.col("is_cross_border"), gbp)).alias("cross_border_gbp"),
        count_where("counterparty_sanctioned").alias("sanctioned"),
        count_where(night).alias("late_night"),
        count_where(F.col("txn_type") == "REFUND").alias("refunds"),
    )
    days = rollup.groupBy("event_date").agg(
        F.sum("n").alias("total_txn_count"),
        sum0("gbp").alias("total_gbp_volume"),
        distinct("customer_id", approx).alias("distinct_customers"),
        distinct("account_id", approx).alias("distinct_accounts"),
        F.sum("high_risk").alias("high_risk_txn_count"),
        sum0("high_risk_gbp").alias("high_risk_gbp_volume"),
        F.sum("cross_border").alias("cross_border_count"),
        sum0("cross_border_gbp").alias("cross_border_gbp_volume"),
        F.sum("sanctioned").alias("sanctioned_count"),
        F.sum("late_night").alias("late_night_count"),
        F.sum("refunds").alias("refund_count"),
        ratio0(F.sum("gbp"), F.sum("n_gbp")).alias("avg_txn_gbp_value"),
        max0("largest", 2).alias("max_single_txn_gbp"),
    )
    scored = days.withColumn("refund_rate_pct", pct("refund_count", "total_txn_count"))
    banded = scored.withColumns({"daily_risk_band": domain.band(domain.risk_score()), **_stamped(as_of)})
    return C.DAILY_RISK.enforce(conform(banded, schemas.DAILY_RISK))


def daily_anomaly_flags(
    txn: DataFrame,
    velocity: int = V.VELOCITY_LIMIT,
    large: float = V.LARGE_TXN,
    night: int = V.NIGHT_TXN_LIMIT,
    cross_border_pct: float = V.CROSS_BORDER_SHARE,
    countries: int = V.COUNTRY_LIMIT,
    night_hours: tuple[int, int] = V.NIGHT_HOURS,
    as_of: AsOf = None,
    approx: bool = False,
) -> DataFrame:
    """One row per customer and day: seven aggregates, six flags and whether any is set."""
    days = txn.groupBy("customer_id", "event_date").agg(
        F.count("*").alias("daily_txn_count"),
        count_where("is_cross_border").alias("cross_border_count"),
        count_where(domain.in_night("txn_hour", night_hours)).alias("night_txn_count"),
        max0("gbp_amount").alias("max_single_txn_gbp"),
        count_where("counterparty_sanctioned").alias("sanctioned_count"),
        distinct("country_code", approx).alias("distinct_countries"),
        sum0("gbp_amount").alias("total_customer_gbp"),
    )
    flags = {
        "velocity_flag": F.col("daily_txn_count") > velocity,
        "large_txn_flag": F.col("max_single_txn_gbp") > large,
        "night_owl_flag": F.col("night_txn_count") > night,
        "cross_border_spike_flag": F.col("cross_border_count") / F.col("daily_txn_count") > cross_border_pct,
        "sanctioned_flag": F.col("sanctioned_count") > 0,
        "multi_country_flag": F.col("distinct_countries") > countries,
    }
    flagged = days.withColumns(flags).withColumns({"any_flag": any_holds([F.col(f) for f in flags]), **_stamped(as_of)})
    return C.ANOMALY_FLAGS.enforce(conform(flagged, schemas.ANOMALY_FLAGS))


def fx_day_rates(fx: DataFrame) -> DataFrame:
    """Mean, low, high and move flag per currency and day, keyed like the exposure."""
    return fx.groupBy(F.col("quote_currency").alias("currency"), F.col("rate_date").alias("event_date")).agg(
        F.round(F.avg("rate"), 6).alias("daily_avg_rate"),
        F.round(F.min("rate"), 6).alias("daily_low_rate"),
        F.round(F.max("rate"), 6).alias("daily_high_rate"),
        any_true("significant_move").alias("moved"),
    )


def daily_fx_exposure(
    txn: DataFrame, fx: DataFrame, base: str = V.BASE_CURRENCY, as_of: AsOf = None, approx: bool = False
) -> DataFrame:
    """One row per foreign currency and day: exposure beside that day's rates and move flag."""
    exposure = txn.filter(F.col("currency") != base).groupBy("currency", "event_date").agg(
        F.count("*").alias("txn_count"),
        sum0("amount").alias("total_original_amount"),
        sum0("gbp_amount").alias("total_gbp_exposure"),
        avg0("gbp_amount").alias("avg_gbp_per_txn"),
        distinct("customer_id", approx).alias("distinct_customers"),
    )
    # Both sides hold one row per currency and day: unique keys, so a plain join has no hot key.
    joined = exposure.join(fx_day_rates(fx), ["currency", "event_date"], "left")
    original = F.col("total_original_amount")
    implied = F.when(original > 0, F.round(F.col("total_gbp_exposure") / F.nullif(original, F.lit(0)), 6))
    done = joined.withColumns(
        {"rate_risk_flag": F.coalesce("moved", F.lit(False)), "implied_rate": implied, **_stamped(as_of)}
    )
    return C.FX_EXPOSURE.enforce(conform(done, schemas.FX_EXPOSURE))


# -- regulatory ---------------------------------------------------------------
def aml_report(
    txn: DataFrame,
    sar: float = V.SAR_THRESHOLD,
    days: int = V.STRUCTURING_DAYS,
    structuring_total: float = V.STRUCTURING_TOTAL,
    channel_amount: float = V.HIGH_RISK_CHANNEL_AMOUNT,
    as_of: AsOf = None,
) -> DataFrame:
    """Every transaction with its threshold, sanctions, structuring and channel flags, status and reference."""
    rolled = rolling_sum(txn, "customer_id", "event_ts", "gbp_amount", days, "rolling_3d_gbp")
    flagged = rolled.withColumns(
        {
            "threshold_breach": F.col("gbp_amount") >= sar,
            "sanctions_hit": F.col("counterparty_sanctioned"),
            "structuring_flag": domain.structuring(total=structuring_total, sar=sar),
            "high_risk_channel": domain.high_risk_channel(channel_amount),
        }
    )
    rules = ("threshold_breach", "sanctions_hit", "structuring_flag")
    done = flagged.withColumns(
        {
            "sar_candidate": domain.sar_candidate(*rules),
            "regulatory_status": domain.regulatory_status(*rules),
            "pipeline_version": F.lit(V.PIPELINE_VERSION),
            **domain.report_fields(as_of),
        }
    )
    return C.AML_REPORT.enforce(conform(done, schemas.AML_REPORT))


def capital_exposure(
    txn: DataFrame,
    capital: float = V.CAPITAL_BASE,
    weights: Mapping[str, str] = V.RISK_WEIGHTS,
    large_pct: float = V.LARGE_EXPOSURE_PCT,
    as_of: AsOf = None,
    approx: bool = False,
) -> DataFrame:
    """One row per customer and day: exposure, risk-weighted assets, share of capital and band."""
    gbp = F.col("gbp_amount")
    keys = ["customer_id", "event_date"]
    rollup = txn.groupBy(*keys, "currency", "country_code").agg(
        F.count("*").alias("n"),
        F.sum(gbp).alias("gbp"),
        F.sum(gbp * weight_of("txn_type", weights)).alias("weighted"),
        F.max(gbp).alias("largest"),
        count_where("is_international").alias("international"),
        count_where("counterparty_sanctioned").alias("sanctioned"),
    )
    per_day = rollup.groupBy(*keys).agg(
        sum0("gbp").alias("total_gbp_exposure"),
        F.sum("n").alias("txn_count"),
        sum0("weighted").alias("risk_weighted_assets"),
        max0("largest", 2).alias("largest_single_txn"),
        distinct("currency", approx).alias("currency_count"),
        distinct("country_code", approx).alias("country_count"),
        F.sum("international").alias("international_txn_count"),
        F.sum("sanctioned").alias("sanctions_exposure_count"),
    )
    share = per_day.withColumn(
        "exposure_pct_of_capital", F.round(F.col("total_gbp_exposure") / F.lit(capital) * 100, 4)
    )
    now = query_time(as_of)
    done = share.withColumns(
        {
            "large_exposure_flag": F.col("exposure_pct_of_capital") > large_pct,
            "capital_adequacy_band": domain.capital_band(),
            "report_date": F.to_date(now),
            **_stamped(as_of, "report_generated_ts"),
        }
    )
    return C.CAPITAL_EXPOSURE.enforce(conform(done, schemas.CAPITAL_EXPOSURE))
