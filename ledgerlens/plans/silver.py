"""Silver: enriched transactions and FX change metrics."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens import values as V
from ledgerlens.functions import domain
from ledgerlens.functions.columns import query_time
from ledgerlens.operators.lookups import fits_broadcast, lookup_join
from ledgerlens.operators.quality import quarantine
from ledgerlens.operators.relational import conform, dedupe, latest_per, pivot_wide
from ledgerlens.operators.windows import daily_average, rate_change
from ledgerlens.plans import contracts as C
from ledgerlens.sources.files import BROKEN

AsOf = Column | datetime | None


# -- FX -----------------------------------------------------------------------
def fx_silver(
    parsed: DataFrame, move_pct: float = V.SIGNIFICANT_MOVE_PCT, exclude_stale: bool = False, as_of: AsOf = None
) -> DataFrame:
    """Previous rate, change, significant move and daily mean per currency.

    Stale rates stay in unless ``exclude_stale``.  A rate without a fetch time is dropped
    only at the end, so it still counts as the rate before a currency's first dated one.
    """
    rows = parsed.filter("rate > 0 AND rate_id IS NOT NULL")
    if exclude_stale:
        rows = rows.filter(~F.coalesce("is_stale", F.lit(False)))
    measured = C.FX_SILVER.enforce(daily_average(rate_change(rows, move_pct=move_pct)))
    stamped = measured.withColumns(
        {"silver_processed_ts": query_time(as_of), "pipeline_version": F.lit(V.PIPELINE_VERSION)}
    )
    return conform(stamped, schemas.FX_SILVER)


def fx_valid(parsed: DataFrame) -> DataFrame:
    """The rows of ``fx_silver`` without its change metrics: all that the pivot and the day's rates need."""
    return C.FX_SILVER.enforce(parsed)


def fx_pivot(
    fx: DataFrame,
    currencies: Sequence[str] = V.QUOTE_CURRENCIES,
    base: str = V.BASE_CURRENCY,
    required: Sequence[str] = ("USD", "EUR"),
    as_of: AsOf = None,
) -> DataFrame:
    """One row per fetch, one ``<base>_<currency>`` column per currency.

    Of several rates of one pair at one fetch, the one with the smallest id is taken.
    A row without a ``required`` currency stops the run.
    """
    keys = ["fetch_ts", "rate_date", "base_currency"]
    wide = pivot_wide(fx, keys, "quote_currency", currencies, F.min_by("rate", "rate_id"))
    named = wide.select(*keys, *[F.col(c).alias(domain.rate_column(c, base)) for c in currencies])
    checked = C.fx_pivot_contract(required, base).enforce(named)
    return checked.withColumns(
        {"silver_processed_ts": query_time(as_of), "pipeline_version": F.lit(V.PIPELINE_VERSION)}
    )


def fx_complete(fx: DataFrame, required: Sequence[str] = ("USD", "EUR")) -> DataFrame:
    """Rows of the fetches that have a rate of every required currency: what the pivot's fail rules let pass."""
    fetch = ["fetch_ts", "rate_date", "base_currency"]
    has = [F.max(F.col("quote_currency") == c) for c in required]
    whole = fx.filter(F.col("rate").isNotNull()).groupBy(*fetch).agg(reduce(Column.__and__, has, F.lit(True)).alias("_whole"))
    return fx.join(whole.filter("_whole").drop("_whole"), fetch, "left_semi")


def fx_silver_quarantine(parsed: DataFrame, as_of: AsOf = None) -> DataFrame:
    return quarantine(parsed, C.FX_SILVER_REASONS, layer="silver", as_of=as_of)


def fx_daily(
    pivoted: DataFrame,
    currencies: Sequence[str] = V.QUOTE_CURRENCIES,
    base: str = V.BASE_CURRENCY,
    rate_type: str = "double",
) -> DataFrame:
    """The day's last fetch, keyed by ``event_date``.

    ``rate_type`` types the rates here, once per day and not once per converted row; a decimal
    type keeps decimal money decimal.
    """
    last = latest_per(pivoted, ["rate_date"], [F.desc("fetch_ts"), F.asc("base_currency")])
    rates = [F.col(domain.rate_column(c, base)).cast(rate_type).alias(domain.rate_column(c, base)) for c in currencies]
    return last.select(F.col("rate_date").alias("event_date"), *rates)


def daily_rates(
    daily: DataFrame, currencies: Sequence[str] = V.QUOTE_CURRENCIES, base: str = V.BASE_CURRENCY
) -> DataFrame:
    """``fx_daily`` in long form: one row per day and currency, ``rate`` NULL where the day has none."""
    entries = F.array(
        *[F.struct(F.lit(c).alias("currency"), F.col(domain.rate_column(c, base)).alias("rate")) for c in currencies]
    )
    return daily.select("event_date", F.inline(entries))


# -- reference tables ---------------------------------------------------------
def mcc_levels(mcc: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """One risk level per code, keyed by ``merchant_mcc``.

    Default order: newest file first.  Pass another where the lineage columns are missing.
    Broken lines, where the table keeps them, name no code.
    """
    if BROKEN in mcc.columns:
        mcc = mcc.filter(F.col(BROKEN).isNull())
    order = order or [F.desc_nulls_last("source_file_modified_ts"), F.desc_nulls_last("source_file"), F.asc("risk_level")]
    one = dedupe(mcc.filter("mcc_code IS NOT NULL"), ["mcc_code"], order)
    return one.select(F.col("mcc_code").alias("merchant_mcc"), F.col("risk_level").alias("merchant_risk_level"))


def active_sanctions(sanctions: DataFrame) -> DataFrame:
    """Distinct ids of active entities, keyed by ``counterparty_id``."""
    active = sanctions.filter(F.col("is_active") & F.col("entity_id").isNotNull())
    return active.select(F.col("entity_id").alias("counterparty_id")).distinct().withColumn("is_sanctioned", F.lit(True))


# -- joins --------------------------------------------------------------------
def join_fx(txn: DataFrame, daily: DataFrame, **limits) -> DataFrame:
    return lookup_join(txn, daily, ["event_date"], **limits)


def join_mcc(txn: DataFrame, levels: DataFrame, **limits) -> DataFrame:
    return lookup_join(txn, levels, ["merchant_mcc"], **limits)


def flag_sanctioned(txn: DataFrame, active: DataFrame, **limits) -> DataFrame:
    """Add ``counterparty_sanctioned``: whether the counterparty is on the active list."""
    joined = lookup_join(txn, active, ["counterparty_id"], **limits)
    flag = F.coalesce(F.col("is_sanctioned"), F.lit(False))
    return joined.withColumn("counterparty_sanctioned", flag).drop("is_sanctioned")


# -- transactions -------------------------------------------------------------
def txn_enrich(
    clean: DataFrame,
    daily: DataFrame,
    levels: DataFrame,
    active: DataFrame,
    as_of: AsOf = None,
    money: str = "double",
    invert: bool = False,
    **limits,
) -> DataFrame:
    """Typed, converted, flagged and enriched transactions in the silver layout.

    ``clean`` is already deduplicated (``dedupe_stream``, or ``dedupe`` in batch).  ``daily``,
    ``levels`` and ``active`` come from ``fx_daily``, ``mcc_levels`` and ``active_sanctions``.
    Rows already written by a stream are not revised when a later rate arrives: re-run the
    batch form for rows without ``gbp_amount``.  ``money`` is the type of the two amounts:
    double, or a decimal type for order-independent sums (then with decimal rates).
    """
    typed = clean.withColumns(
        {
            "event_ts": F.col("event_ts").cast("timestamp"),
            "amount": F.col("amount").cast(money),
            "is_international": F.col("is_international").cast("boolean"),
        }
    )
    typed = C.txn_silver_contract(as_of).enforce(typed)
    flagged = typed.withColumns(
        {
            "event_date": F.to_date("event_ts"),
            "txn_hour": F.hour("event_ts"),
            "txn_day_of_week": F.dayofweek("event_ts"),
            "is_cross_border": domain.is_cross_border(),
            "is_high_risk_merchant": domain.is_high_risk_mcc(),
            "merchant_name": F.coalesce("merchant_name", F.lit(V.UNKNOWN_MERCHANT)),
            "merchant_mcc": F.coalesce("merchant_mcc", F.lit(V.UNKNOWN_MCC)),
        }
    )
    # Long rates: one column and one product per row, not eight columns and a nine-way choice.
    rates = daily_rates(daily)
    fx_fits, mcc_fits, list_fits = fits_broadcast(rates, levels, active, **limits)
    rated = lookup_join(flagged, rates, ["event_date", "currency"], fits=fx_fits)
    joined = flag_sanctioned(join_mcc(rated, levels, fits=mcc_fits), active, fits=list_fits)
    done = joined.withColumns(
        {
            "gbp_amount": domain.convert("amount", "currency", "rate", invert).cast(money),
            "silver_processed_ts": query_time(as_of),
            "pipeline_version": F.lit(V.PIPELINE_VERSION),
        }
    )
    layout = {f.name: f.dataType for f in schemas.TXN_SILVER.fields}
    amounts = ("amount", "gbp_amount")
    return done.select(*[F.col(n) if n in amounts else F.col(n).cast(t).alias(n) for n, t in layout.items()])


def high_risk(txn: DataFrame) -> DataFrame:
    """Transactions that require enhanced due diligence."""
    return txn.filter(domain.needs_due_diligence())


def txn_silver_quarantine(clean: DataFrame, as_of: AsOf = None) -> DataFrame:
    return quarantine(clean, C.txn_silver_reasons(as_of), layer="silver", as_of=as_of)
