"""Domain rules for transactions: conversion, flags, scores and bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens import values as V
from ledgerlens.functions.columns import ColumnLike, col, holds, query_time


def rate_column(currency: str, base: str = V.BASE_CURRENCY) -> str:
    return f"{base}_{currency}"


def convert(
    amount: ColumnLike, currency: ColumnLike, rate: ColumnLike, invert: bool = False, base: str = V.BASE_CURRENCY
) -> Column:
    """Amount in the base currency, 2 digits; NULL without a rate.

    Rates are stored as *quote units per base unit*.  The defined result nevertheless
    multiplies by the rate; ``invert=True`` divides, which is the true conversion.
    """
    converted = col(amount) / F.nullif(col(rate), F.lit(0)) if invert else col(amount) * col(rate)
    return F.round(F.when(col(currency) == base, col(amount)).otherwise(converted), 2)


def to_base(
    amount: ColumnLike,
    currency: ColumnLike,
    quotes: Sequence[str] = V.QUOTE_CURRENCIES,
    base: str = V.BASE_CURRENCY,
    invert: bool = False,
) -> Column:
    """``convert`` with the rate picked from wide ``<base>_<currency>`` columns; NULL for another currency."""
    picks = [F.when(col(currency) == c, F.col(rate_column(c, base))) for c in quotes]
    return convert(amount, currency, F.coalesce(*picks), invert, base)


def is_cross_border(country: ColumnLike = "country_code", home: str = V.HOME_COUNTRY) -> Column:
    return col(country) != home


def is_high_risk_mcc(mcc: ColumnLike = "merchant_mcc", listed: Sequence[str] = V.HIGH_RISK_MCCS) -> Column:
    """A missing code is not high-risk."""
    return F.coalesce(col(mcc).isin(*listed), F.lit(False))


def in_night(hour: ColumnLike = "txn_hour", hours: tuple[int, int] = V.NIGHT_HOURS) -> Column:
    return col(hour).between(*hours)


def needs_due_diligence(large: float = 5_000, night_large: float = 1_000) -> Column:
    """Sanctioned, or high-risk merchant, or large cross-border, or a sizeable night transaction."""
    return (
        F.col("counterparty_sanctioned")
        | F.col("is_high_risk_merchant")
        | (F.col("is_cross_border") & (F.col("gbp_amount") > large))
        | (in_night() & (F.col("gbp_amount") > night_large))
    )


def points(*terms: tuple[Column, int]) -> Column:
    """Additive score: each term whose condition is TRUE adds its points."""
    return reduce(lambda acc, t: acc + F.when(t[0], F.lit(t[1])).otherwise(F.lit(0)), terms, F.lit(0))


def risk_score(
    sanctioned: ColumnLike = "sanctioned_count",
    high_risk: ColumnLike = "high_risk_txn_count",
    cross_border: ColumnLike = "cross_border_count",
    late_night: ColumnLike = "late_night_count",
    refund_pct: ColumnLike = "refund_rate_pct",
    largest: ColumnLike = "max_single_txn_gbp",
    total: ColumnLike = "total_txn_count",
) -> Column:
    n = col(total)
    return points(
        (col(sanctioned) > 0, 100),
        (col(high_risk) > n * 0.10, 30),
        (col(cross_border) / n > 0.30, 20),
        (col(late_night) > n * 0.05, 15),
        (col(refund_pct) > 5.0, 10),
        (col(largest) > 10_000, 10),
    )


def band(score: ColumnLike, cuts: Mapping[str, int] | None = None, floor: str = "LOW") -> Column:
    """Name of the highest cut the score reaches, else ``floor``."""
    cuts = {"CRITICAL": 100, "HIGH": 50, "MEDIUM": 20} if cuts is None else cuts
    ladder = [F.when(col(score) >= cut, F.lit(name)) for name, cut in sorted(cuts.items(), key=lambda kv: -kv[1])]
    return F.coalesce(*ladder, F.lit(floor))


def capital_band(
    exposure_pct: ColumnLike = "exposure_pct_of_capital",
    sanctions: ColumnLike = "sanctions_exposure_count",
    breach: float = V.LARGE_EXPOSURE_PCT,
    watch=V.WATCH_EXPOSURE_PCT,
) -> Column:
    breached = (col(sanctions) > 0) | (col(exposure_pct) >= breach)
    return F.when(breached, "BREACH").when(col(exposure_pct) >= watch, "WATCH").otherwise("ADEQUATE")


def structuring(
    rolling: ColumnLike = "rolling_3d_gbp",
    amount: ColumnLike = "gbp_amount",
    total: float = V.STRUCTURING_TOTAL,
    sar: float = V.SAR_THRESHOLD,
) -> Column:
    """Small own amount inside a large rolling total; NULL when the amount is unknown."""
    return (col(rolling) >= total) & (col(amount) < sar)


def high_risk_channel(amount: float = V.HIGH_RISK_CHANNEL_AMOUNT, channels: Sequence[str] = V.HIGH_RISK_CHANNELS) -> Column:
    return F.col("channel").isin(*channels) & F.col("is_international") & (F.col("gbp_amount") > amount)


def sar_candidate(threshold: ColumnLike, sanctions: ColumnLike, structured: ColumnLike) -> Column:
    """Three-valued OR: NULL when nothing is TRUE and the amount is unknown."""
    return col(threshold) | col(sanctions) | col(structured)


def regulatory_status(threshold: ColumnLike, sanctions: ColumnLike, structured: ColumnLike) -> Column:
    return (
        F.when(holds(col(sanctions)), "REPORT")
        .when(holds(col(threshold)) | holds(col(structured)), "REVIEW")
        .otherwise("CLEAR")
    )


def report_fields(as_of: Column | datetime | None = None, prefix: str = "AML") -> dict[str, Column]:
    """Reference id and reporting period (the day before ``as_of`` up to its day)."""
    now = query_time(as_of)
    today = F.to_date(now)
    return {
        "report_reference": F.concat_ws("-", F.lit(prefix), F.date_format("event_date", "yyyyMMdd"), F.col("txn_id")),
        "report_date": today,
        "report_period_start": F.date_sub(today, 1),
        "report_period_end": today,
        "report_generated_ts": now,
    }
