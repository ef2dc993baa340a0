"""FX provider payloads (JSON documents landed as text) to staged rate rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens import values as V
from ledgerlens.functions.columns import ColumnLike, col
from ledgerlens.operators.relational import conform


def fx_from_payload(
    payloads: DataFrame,
    currencies: Sequence[str] = V.QUOTE_CURRENCIES,
    fetch_ts: ColumnLike = "fetch_ts",
    text: str = "value",
    provider: str | Column = V.FX_PROVIDER,
) -> DataFrame:
    """One row per wanted currency present in a successful payload's rates."""
    doc = payloads.select(col(fetch_ts).alias("fetch_ts"), F.from_json(text, schemas.FX_PAYLOAD).alias("d"))
    rates = doc.filter(F.col("d.result") == "success").select(
        "fetch_ts",
        F.col("d.base_code").alias("base_currency"),
        F.col("d.time_last_update_utc").alias("source_ts"),
        F.explode("d.conversion_rates").alias("quote_currency", "rate"),
    )
    wanted = rates.filter(F.col("quote_currency").isin(*currencies))
    minute = F.date_format("fetch_ts", "yyyyMMddHHmm")
    named = wanted.withColumns(
        {
            "rate_id": F.concat("base_currency", "quote_currency", F.lit("_"), minute),
            "provider": F.lit(provider) if isinstance(provider, str) else provider,
            "pipeline_version": F.lit(V.PIPELINE_VERSION),
        }
    )
    return conform(named, schemas.FX_STAGE)
