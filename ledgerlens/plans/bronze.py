"""Bronze: landed rows, their quarantine and their clean part.

All functions take batch or streaming frames alike.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import values as V
from ledgerlens.functions.columns import age_minutes, parse_rfc1123
from ledgerlens.operators.quality import clean, failure_reasons, quarantine, with_fate
from ledgerlens.operators.relational import dedupe
from ledgerlens.plans import contracts as C
from ledgerlens.sources.files import BROKEN, with_ingestion

AsOf = Column | datetime | None


# -- FX -----------------------------------------------------------------------
def fx_raw(stage: DataFrame) -> DataFrame:
    """Staged rates as they are; watch them with ``contracts.FX_RAW``."""
    return stage


def fx_parse(
    raw: DataFrame, stale_after_min: float = V.STALE_AFTER_MINUTES, order: list[Column] | None = None, fail: bool = True
) -> DataFrame:
    """Typed source time, rate date, age and staleness; one row per rate id.

    ``order`` picks the row kept among copies of an id (default: the latest fetched).
    ``fail=False`` leaves out the rule that a non-positive rate stops the run.
    """
    order = order or [F.desc_nulls_last("fetch_ts"), F.desc_nulls_last("rate")]
    typed = raw.withColumn("source_ts", parse_rfc1123("source_ts")).withColumns(
        {"rate_date": F.to_date("fetch_ts"), "rate_age_minutes": age_minutes("fetch_ts", "source_ts")}
    )
    typed = typed.withColumn("is_stale", F.col("rate_age_minutes") > stale_after_min)
    return dedupe(C.FX_PARSED.enforce(typed, fail=fail), ["rate_id"], order)


def fx_quarantine(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return quarantine(raw, C.FX_REASONS, as_of=as_of)


# -- reference files ----------------------------------------------------------
def with_broken(reasons: dict, raw: DataFrame) -> dict:
    """The reasons and, where the raw table keeps broken lines or files, one for them."""
    return reasons | ({"malformed_record": F.col(BROKEN).isNotNull()} if BROKEN in raw.columns else {})


def mcc_quarantine(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return quarantine(raw, with_broken(C.MCC_REASONS, raw), as_of=as_of)


def sanctions_quarantine(raw: DataFrame, as_of: AsOf = None) -> DataFrame:
    return quarantine(raw, with_broken(C.SANCTIONS_REASONS, raw), as_of=as_of)


# -- transactions -------------------------------------------------------------
def txn_raw(source: DataFrame, as_of: AsOf = None) -> DataFrame:
    return with_ingestion(source, V.PIPELINE_VERSION, V.TXN_SOURCE_SYSTEM, as_of)


def txn_quarantine(raw: DataFrame, as_of: AsOf = None, **reasons) -> DataFrame:
    return quarantine(raw, C.txn_reasons(**reasons), as_of=as_of)


def txn_clean(raw: DataFrame, currencies=V.BRONZE_CURRENCIES, fail: bool = True) -> DataFrame:
    """Quality-passed rows; the fail rules guard against a clean filter that lets a fault through."""
    return C.TXN_STAGE.enforce(clean(raw, C.txn_clean_rules(currencies)), fail=fail)


def txn_routed(raw: DataFrame, **reasons) -> DataFrame:
    """Raw rows with their fate and reasons, so that one scan can feed both sides.

    Write it partitioned by ``row_fate``; readers of one side then prune the other.
    """
    rules = C.txn_reasons(**reasons)
    return with_fate(raw, C.txn_clean_rules(), rules).withColumn("failure_reasons", failure_reasons(rules))
