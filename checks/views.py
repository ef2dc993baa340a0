"""The library's input tables as views over the driver tables (FIXTURES.md section 3).

Every view covers its whole source table.  Faults are part of the derived values.
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens import values as V
from ledgerlens.plans import bronze, silver
from ledgerlens.sources.tables import hand_over

#: The time of a run, after the last event, so that every event counts; and one inside the data, for the rules on future events.
AS_OF = datetime(2024, 1, 31, 12, tzinfo=UTC)
INSIDE = datetime(2024, 1, 28, 12, tzinfo=UTC)
MONEY = "decimal(18,2)"
RATE = "decimal(18,6)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def choose(index, *options: str | None):
    """Option number ``index`` (0-based)."""
    return F.element_at(F.array(*[F.lit(o) for o in options]), (index + 1).cast("int"))


# -- transactions -------------------------------------------------------------
def txn_from_events(events: DataFrame) -> DataFrame:
    """``transactions_source`` rows from an events frame, batch or streaming."""
    e = events.select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").cast("timestamp").alias("event_ts"),
        F.col("value").cast(MONEY).alias("v"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )
    eid, uid, k = F.col("event_id"), F.col("user_id"), F.col("k")
    currency = choose(eid % 12, "USD", "EUR", "AED", "NGN", "CNY", "XXX", None, "GBP", "GBP", "GBP", "GBP", "GBP")
    country = choose(F.least(k % 8, F.lit(4)), "US", "NG", "CN", "AE", "GB")
    amount = F.when(eid % 97 == 0, None).when(eid % 89 == 0, F.col("v") * -40).otherwise(F.col("v") * 40)
    txn_type = (
        F.when(F.col("event_type") == "purchase", "PURCHASE")
        .when(F.col("event_type") == "click", "TRANSFER")
        .when(F.col("event_type") == "view", "DIRECT_DEBIT")
        .when(F.col("event_type") == "signup", "ATM_WITHDRAWAL")
        .when(F.col("event_type") == "error", "REFUND")
    )
    return e.select(
        eid.cast("string").alias("txn_id"),
        (uid % 97).cast("string").alias("account_id"),
        uid.cast("string").alias("customer_id"),
        F.when(k % 5 < 3, F.concat(F.lit("CP"), (k + 100 * (eid % 10)).cast("string"))).alias("counterparty_id"),
        txn_type.alias("txn_type"),
        choose(eid % 6, "mobile_app", "online_banking", "branch", "atm", "pos_terminal", "fax").alias("channel"),
        amount.cast(MONEY).alias("amount"),
        currency.alias("currency"),
        F.when(k % 10 != 0, F.concat(F.lit("Merchant "), (k % 8).cast("string"))).alias("merchant_name"),
        F.when(k == 99, "9999").when(k % 10 != 0, (k + 1000).cast("string")).alias("merchant_mcc"),
        country.alias("country_code"),
        (k % 8 < 4).alias("is_international"),
        F.when(k % 10 >= 3, F.concat(F.lit("DEV"), (uid % 5000).cast("string"))).alias("device_id"),
        F.concat_ws(".", F.lit("10.0"), k.cast("string"), (uid % 256).cast("string")).alias("ip_address"),
        "event_ts",
        (eid % 1_000_000).cast("int").alias("kafka_offset"),
        (eid % 8).cast("int").alias("kafka_partition"),
    )


def txn_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return txn_from_events(table(spark, sf_dir, "events"))


def txn_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze.txn_clean(bronze.txn_raw(txn_source(spark, sf_dir), AS_OF))


# -- FX -----------------------------------------------------------------------
def fx_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate per currency and six-hour fetch: the mean event value / 50, 4 digits.

    Stored like the staging table it stands for, so that a query reads the events once for it.
    """
    ts = F.col("ts").cast("timestamp")
    e = table(spark, sf_dir, "events").select(
        (F.date_trunc("DAY", ts) + F.make_dt_interval(hours=F.floor(F.hour(ts) / 6).cast("int") * 6)).alias("fetch_ts"),
        (F.get_json_object("props", "$.k").cast("int") % 8).alias("i"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )
    mean = F.sum("cents").cast("decimal(20,0)") / (F.count("cents") * 5000)
    r = e.groupBy("fetch_ts", "i").agg(F.round(mean, 4).cast("double").alias("rate"))
    quote = choose(F.col("i"), *V.QUOTE_CURRENCIES)
    source = F.col("fetch_ts") - F.make_dt_interval(mins=5 + 5 * F.col("i"))
    text = F.concat(F.date_format(source, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    hour = F.hour("fetch_ts")
    text = F.when((F.col("i") == 3) & (hour == 0), None).when((F.col("i") == 2) & (hour == 18), "n/a").otherwise(text)
    stage = r.select(
        F.concat(F.lit(V.BASE_CURRENCY), quote, F.lit("_"), F.date_format("fetch_ts", "yyyyMMddHHmm")).alias("rate_id"),
        F.lit(V.BASE_CURRENCY).alias("base_currency"),
        quote.alias("quote_currency"),
        "rate",
        text.alias("source_ts"),
        "fetch_ts",
        F.lit(V.FX_PROVIDER).alias("provider"),
        F.lit(V.PIPELINE_VERSION).alias("pipeline_version"),
    )
    return hand_over(stage, "fx_rates_stage")


def fx_stage_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fx_stage`` with one kind of fault in each of six fetches of the month."""
    s = fx_stage(spark, sf_dir)

    def at(day: int, hour: int):
        return (F.dayofmonth("fetch_ts") == day) & (F.hour("fetch_ts") == hour)

    return s.select(
        F.when(~at(7, 0), F.col("rate_id")).alias("rate_id"),
        F.when(at(13, 6), "USD").otherwise(F.col("base_currency")).alias("base_currency"),
        F.when(at(15, 0), "XXX").otherwise(F.col("quote_currency")).alias("quote_currency"),
        F.when(at(17, 6), -F.col("rate")).when(at(19, 12), F.col("rate") * 10_000_000).otherwise(F.col("rate")).alias("rate"),
        "source_ts",
        F.when(~at(23, 18), F.col("fetch_ts")).alias("fetch_ts"),
        "provider",
        "pipeline_version",
    )


def fx_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.fx_silver(bronze.fx_parse(fx_stage(spark, sf_dir)), as_of=AS_OF)


def fx_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The day's rates, stored: the joins that follow are planned with their real size."""
    valid = silver.fx_valid(bronze.fx_parse(fx_stage(spark, sf_dir)))
    pivoted = silver.fx_pivot(valid, required=(), as_of=AS_OF)
    return hand_over(silver.fx_daily(pivoted, rate_type=RATE), "fx_daily")


# -- reference tables ---------------------------------------------------------
def mcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MCC rows with lineage columns; several files list the same code, the newest has the largest part key."""
    key, size = F.col("p_partkey"), F.col("p_size")
    level = F.when(key % 37 == 0, "BAD").when(size <= 20, "LOW").when(size <= 40, "MEDIUM").otherwise("HIGH")
    file_no = F.floor(key / 500)
    return table(spark, sf_dir, "part").select(
        (key % 500 + 1000).cast("string").alias("mcc_code"),
        F.when(key % 41 != 0, F.col("p_name")).alias("description"),
        F.col("p_type").alias("category"),
        level.alias("risk_level"),
        F.when(key % 43 == 0, "?").when(key % 4 == 0, "Y").when(key % 4 < 3, "N").alias("requires_enhanced_dd"),
        F.lit("2024-01-01").alias("effective_date"),
        F.lit("2024-02-01").alias("last_updated"),
        F.concat(F.lit("mcc_"), file_no.cast("string"), F.lit(".csv")).alias("source_file"),
        (F.expr("TIMESTAMP '2024-01-01 00:00:00'") + F.make_dt_interval(mins=file_no.cast("int"))).alias(
            "source_file_modified_ts"
        ),
    )


def sanctions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sanctions rows with lineage columns; ids match the transactions' counterparties."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    file_no = F.floor(key / 100)
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("CP"), key.cast("string")).alias("entity_id"),
        choose(nation % 5, *V.ENTITY_TYPES, "GHOST").alias("entity_type"),
        F.when(key % 29 != 28, F.col("s_name")).alias("full_name"),
        F.array("s_name").alias("aliases"),
        nation.cast("string").alias("country_of_origin"),
        choose(nation % 6, *V.SANCTION_PROGRAMS, "NONE").alias("sanctions_program"),
        F.lit("2023-06-15").alias("listed_date"),
        F.lit("2024-01-01").alias("last_updated"),
        (F.col("s_acctbal") > 9500).alias("is_active"),
        (F.col("s_acctbal") / 10_000).alias("risk_score"),
        F.lit("OFAC_SDN").alias("source_list"),
        F.concat(F.lit("sanctions_"), file_no.cast("string"), F.lit(".json")).alias("source_file"),
        (F.expr("TIMESTAMP '2024-01-01 00:00:00'") + F.make_dt_interval(mins=file_no.cast("int"))).alias(
            "source_file_modified_ts"
        ),
    )


def sanction_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope document per sanctions file (at most 100 records each), as JSON text."""
    names = [f.name for f in schemas.SANCTION_RECORD.fields]
    docs = sanctions(spark, sf_dir).groupBy("source_file", "source_file_modified_ts").agg(
        F.count("*").alias("record_count"), F.collect_list(F.struct(*names)).alias("records")
    )
    body = F.struct(
        F.lit("1.0").alias("schema_version"), F.lit("2024-01-01").alias("generated_at"), "record_count", "records"
    )
    return docs.select(F.to_json(body).alias("value"), "source_file", "source_file_modified_ts")


# -- silver -------------------------------------------------------------------
def enrich(spark: SparkSession, sf_dir: str, clean: DataFrame, as_of: datetime = AS_OF) -> DataFrame:
    return silver.txn_enrich(
        clean,
        fx_daily(spark, sf_dir),
        silver.mcc_levels(mcc(spark, sf_dir)),
        silver.active_sanctions(sanctions(spark, sf_dir)),
        as_of=as_of,
        money=MONEY,
    )


def txn_silver(spark: SparkSession, sf_dir: str, as_of: datetime = AS_OF) -> DataFrame:
    return enrich(spark, sf_dir, txn_clean(spark, sf_dir), as_of)


# -- fraud --------------------------------------------------------------------
def fraud_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("txn_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("value").alias("amount"),
        F.when(F.col("event_type") == "error", "Unknown").otherwise(F.col("event_type")).alias("merchant"),
        F.hour(ts).alias("hour"),
        (F.col("value") > 200).cast("int").alias("is_fraud"),
        ts.alias("ts"),
    )
