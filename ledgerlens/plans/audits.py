"""One audit row per layer and run: counts, quarantine share, distributions, top failures, status.

Each input is scanned once: it is counted per category first, and totals and the JSON cells are
taken from the few category rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens import schemas
from ledgerlens import values as V
from ledgerlens.functions.columns import content_hash, count_where, distinct, json_map, query_time, ratio0, sum0
from ledgerlens.operators.audit import (
    CELL_CHARS,
    CELL_ENTRIES,
    audit_status,
    bounded,
    combine_scalars,
    distribution_json,
    held_summary,
    scalars,
)
from ledgerlens.operators.quality import quarantine_pct
from ledgerlens.operators.relational import conform, top_k

AsOf = Column | datetime | None


def _finish(parts: DataFrame, schema: StructType, as_of: AsOf, fail_when: list[Column]) -> DataFrame:
    done = parts.withColumns({"run_ts": query_time(as_of), "audit_status": audit_status(fail_when)})
    return conform(done, schema)


def _total(n) -> Column:
    return F.coalesce(F.sum(n), F.lit(0))


def _row_total(df: DataFrame, alias: str) -> DataFrame:
    return scalars(df, **{alias: F.count("*")})


def named(column: str) -> Column:
    """A category with NULL as the text ``NULL``: one entry for both in a distribution."""
    return F.coalesce(F.col(column), F.lit("NULL")).alias(column)


# -- bronze -------------------------------------------------------------------
def _snapshot(parsed: DataFrame) -> DataFrame:
    newest = F.max_by("rate", F.struct("fetch_ts", "rate_id"))
    currency = F.substring(named("quote_currency"), 1, CELL_CHARS).alias("quote_currency")
    return parsed.groupBy(currency).agg(F.round(newest, 6).alias("rate"), F.count("*").alias("n"))


def rate_snapshot(parsed: DataFrame) -> DataFrame:
    """Latest rate per quote currency, as rows."""
    return _snapshot(parsed).drop("n")


def snapshot_json(parsed: DataFrame, entries: int = CELL_ENTRIES) -> DataFrame:
    """``rate_snapshot`` as one cell, with the ``entries`` currencies that have most rows; the others are in the rows only."""
    top = top_k(_snapshot(parsed), [F.desc("n"), F.asc("quote_currency")], entries)
    return top.agg(json_map("quote_currency", "rate").alias("rate_snapshot"))


def fx_audit(
    raw: DataFrame,
    parsed: DataFrame,
    held: DataFrame,
    as_of: AsOf = None,
    max_quarantine_pct: float = 5.0,
    stale_after_min: float = V.STALE_AFTER_MINUTES,
) -> DataFrame:
    """FAIL if nothing arrived, too much is quarantined or any rate is stale."""
    parts = combine_scalars(
        _row_total(raw, "total_rows"),
        scalars(
            parsed,
            good_rows=F.count("*"),
            max_rate_age_mins=F.coalesce(F.max("rate_age_minutes"), F.lit(0.0)),
            stale_rate_count=count_where("is_stale"),
        ),
        snapshot_json(parsed),
        held_summary(held),
    ).withColumns(
        {
            "quarantine_pct": quarantine_pct("quarantine_rows", "total_rows"),
            "provider_stale": F.col("max_rate_age_mins") > stale_after_min,
        }
    )
    return _finish(
        parts,
        schemas.FX_AUDIT,
        as_of,
        [
            F.col("total_rows") == 0,
            F.col("quarantine_pct") > max_quarantine_pct,
            F.col("stale_rate_count") > 0,
        ],
    )


def _files_audit(
    raw: DataFrame, held: DataFrame, prefix: str, schema: StructType, as_of: AsOf, max_quarantine_pct: float
) -> DataFrame:
    total, held_rows, share, files, top = (
        f"{prefix}_{n}" for n in ("total_rows", "quarantine_rows", "quarantine_pct", "files_processed", "top_failures")
    )
    parts = combine_scalars(
        scalars(raw, **{total: F.count("*"), files: distinct("source_file")}),
        held_summary(held, held_rows, top),
    ).withColumn(share, quarantine_pct(held_rows, total))
    return _finish(parts, schema, as_of, [F.col(total) == 0, F.col(share) > max_quarantine_pct])


def mcc_audit(raw: DataFrame, held: DataFrame, as_of: AsOf = None, max_quarantine_pct: float = 5.0) -> DataFrame:
    """FAIL if no row was read or too much is quarantined."""
    return _files_audit(raw, held, "mcc", schemas.MCC_AUDIT, as_of, max_quarantine_pct)


def sanctions_audit(raw: DataFrame, held: DataFrame, as_of: AsOf = None, max_quarantine_pct: float = 5.0) -> DataFrame:
    return _files_audit(raw, held, "sanctions", schemas.SANCTIONS_AUDIT, as_of, max_quarantine_pct)


def txn_audit(
    raw: DataFrame, clean: DataFrame, held: DataFrame, as_of: AsOf = None, quarantine_pct_limit: float = 10.0
) -> DataFrame:
    """FAIL if nothing arrived or the quarantine share reaches the limit."""
    parts = combine_scalars(
        distribution_json(raw, "currency", "currency_dist", rows="total_rows"),
        _row_total(clean, "good_rows"),
        held_summary(held, count_name="cnt"),
    ).withColumn("quarantine_pct", quarantine_pct("quarantine_rows", "total_rows"))
    return _finish(
        parts,
        schemas.TXN_AUDIT,
        as_of,
        [F.col("total_rows") == 0, F.col("quarantine_pct") >= quarantine_pct_limit],
    )


# -- silver -------------------------------------------------------------------
def txn_silver_audit(txn: DataFrame, held: DataFrame, as_of: AsOf = None, max_quarantine_pct: float = 5.0) -> DataFrame:
    """FAIL if empty, too much is quarantined, or any counterparty is sanctioned."""
    channels = bounded(txn.groupBy(named("channel")).agg(
        F.count("*").alias("n"),
        F.sum("gbp_amount").alias("gbp"),
        count_where("counterparty_sanctioned").alias("sanctioned"),
        count_where("is_high_risk_merchant").alias("high_risk"),
        count_where("is_cross_border").alias("cross_border"),
    ), "channel", "n", sums=("gbp", "sanctioned", "high_risk", "cross_border"))
    parts = combine_scalars(
        scalars(
            channels,
            total_rows=_total("n"),
            total_gbp_volume=sum0("gbp"),
            sanctioned_count=_total("sanctioned"),
            high_risk_count=_total("high_risk"),
            cross_border_count=_total("cross_border"),
            channel_dist=json_map("channel", "n"),
        ),
        held_summary(held),
    ).withColumn("quarantine_pct", quarantine_pct("quarantine_rows", "total_rows"))
    return _finish(
        parts,
        schemas.TXN_SILVER_AUDIT,
        as_of,
        [
            F.col("total_rows") == 0,
            F.col("quarantine_pct") > max_quarantine_pct,
            F.col("sanctioned_count") > 0,
        ],
    )


def fx_silver_audit(
    fx: DataFrame,
    held: DataFrame,
    as_of: AsOf = None,
    max_quarantine_pct: float = 5.0,
    expected_pairs: int = len(V.QUOTE_CURRENCIES),
) -> DataFrame:
    """FAIL if empty, too much is quarantined, or a currency pair is missing."""
    pair_days = fx.groupBy("quote_currency", "rate_date").agg(
        F.count("*").alias("n"),
        count_where("significant_move").alias("moves"),
        F.sum("rate_change_pct").alias("change"),
        F.count("rate_change_pct").alias("changes"),
    )
    parts = combine_scalars(
        scalars(
            pair_days,
            total_rows=_total("n"),
            currency_pairs=distinct("quote_currency"),
            distinct_dates=distinct("rate_date"),
            significant_move_count=_total("moves"),
            avg_rate_change_pct=ratio0(F.sum("change"), F.sum("changes"), 6),
        ),
        held_summary(held),
    ).withColumn("quarantine_pct", quarantine_pct("quarantine_rows", "total_rows"))
    return _finish(
        parts,
        schemas.FX_SILVER_AUDIT,
        as_of,
        [
            F.col("total_rows") == 0,
            F.col("quarantine_pct") > max_quarantine_pct,
            F.col("currency_pairs") < expected_pairs,
        ],
    )


# -- gold ---------------------------------------------------------------------
def daily_risk_audit(summary: DataFrame, anomalies: DataFrame, exposure: DataFrame, as_of: AsOf = None) -> DataFrame:
    """FAIL if there is no day or anyone is sanctioned."""
    bands = summary.groupBy("daily_risk_band").agg(
        F.count("*").alias("n"), F.sum("total_gbp_volume").alias("gbp"), F.sum("sanctioned_count").alias("hits")
    )
    parts = combine_scalars(
        scalars(
            bands,
            summary_days=_total("n"),
            total_pipeline_gbp_volume=sum0("gbp"),
            high_risk_days=_total(F.when(F.col("daily_risk_band").isin("HIGH", "CRITICAL"), F.col("n"))),
            total_sanctioned_hits=_total("hits"),
            risk_band_dist=json_map("daily_risk_band", "n"),
        ),
        scalars(
            anomalies,
            anomaly_rows=F.count("*"),
            flagged_customers=count_where("any_flag"),
            sanctioned_customers=count_where("sanctioned_flag"),
        ),
        scalars(exposure, fx_exposure_rows=F.count("*"), fx_risk_flag_count=count_where("rate_risk_flag")),
    )
    return _finish(
        parts,
        schemas.DAILY_RISK_AUDIT,
        as_of,
        [
            F.col("summary_days") == 0,
            F.col("total_sanctioned_hits") > 0,
            F.col("sanctioned_customers") > 0,
        ],
    )


def _aml_counts(**names: str) -> dict[str, Column]:
    status = F.col("regulatory_status")
    return {
        names["total"]: F.count("*"),
        names["report"]: count_where(status == "REPORT"),
        names["review"]: count_where(status == "REVIEW"),
    }


def _capital_counts(**names: str) -> dict[str, Column]:
    band = F.col("capital_adequacy_band")
    return {
        names["total"]: F.count("*"),
        names["breach"]: count_where(band == "BREACH"),
        names["watch"]: count_where(band == "WATCH"),
    }


def regulatory_log(aml: DataFrame, capital: DataFrame, as_of: AsOf = None) -> DataFrame:
    """One log row per run: counts by status, period, hash over both, run id and run status.

    The hash covers counts and period only, so equal runs share an id; ``run_ts`` tells them
    apart.  Append it to the log; nothing rewrites earlier rows.
    """
    parts = combine_scalars(
        scalars(
            aml,
            **_aml_counts(total="aml_total_rows", report="aml_report_count", review="aml_review_count"),
            period_start=F.min("event_date"),
            period_end=F.max("event_date"),
        ),
        scalars(
            capital, **_capital_counts(total="basel_total_rows", breach="basel_breach_count", watch="basel_watch_count")
        ),
    )
    # Names and order inside the hashed text are fixed values.
    digest = content_hash(
        {
            "aml_total": "aml_total_rows",
            "aml_report": "aml_report_count",
            "aml_review": "aml_review_count",
            "basel_total": "basel_total_rows",
            "basel_breach": "basel_breach_count",
            "period_start": "period_start",
            "period_end": "period_end",
        }
    )
    now = query_time(as_of)
    status = (
        F.when(F.col("basel_breach_count") > 0, "BREACH_DETECTED")
        .when(F.col("aml_report_count") > 0, "SAR_REQUIRED")
        .when(F.col("aml_review_count") > 0, "REVIEW_REQUIRED")
        .otherwise("CLEAR")
    )
    done = parts.withColumn("report_hash", digest).withColumns(
        {
            "run_id": F.substring("report_hash", 1, 16),
            "run_ts": now,
            "report_date": F.to_date(now),
            "pipeline_version": F.lit(V.PIPELINE_VERSION),
            "status": status,
        }
    )
    return conform(done, schemas.REGULATORY_LOG)


def regulatory_audit(aml: DataFrame, capital: DataFrame, log: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Status counts beside the latest log row.  FAIL if a report is empty, or on any hit or breach."""
    newest = log.agg(F.max_by(F.struct("run_id", "report_hash", "status"), "run_ts").alias("r")).select(
        F.coalesce("r.run_id", F.lit("N/A")).alias("run_id"),
        F.coalesce("r.report_hash", F.lit("N/A")).alias("report_hash"),
        F.coalesce("r.status", F.lit("N/A")).alias("log_status"),
    )
    parts = combine_scalars(
        scalars(
            aml,
            **_aml_counts(total="aml_rows", report="sar_count", review="review_count"),
            sanctions_count=count_where("sanctions_hit"),
        ),
        scalars(capital, **_capital_counts(total="basel_rows", breach="breach_count", watch="watch_count")),
        newest,
    )
    return _finish(
        parts,
        schemas.REGULATORY_AUDIT,
        as_of,
        [
            F.col("aml_rows") == 0,
            F.col("basel_rows") == 0,
            F.col("sanctions_count") > 0,
            F.col("breach_count") > 0,
        ],
    )
