"""Registered queries: one per operator or dataset, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from checks import views as D
from checks.views import AS_OF, INSIDE
from ledgerlens import schemas
from ledgerlens import values as V
from ledgerlens.functions import columns as fc
from ledgerlens.functions import domain
from ledgerlens.operators import audit as oa
from ledgerlens.operators import quality, relational, windows
from ledgerlens.plans import audits, bronze, contracts, fraud, gold, medallion, silver
from ledgerlens.session import tune
from ledgerlens.sources import files, fx_payload, tables
from ledgerlens.streaming import runs

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the driver tables have them."""
    return df.select(
        *[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else f.name
          for f in df.schema.fields]
    )


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return plain_times(fn(spark, sf_dir.rstrip("/")))

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


# -- quality framework --------------------------------------------------------
@query
def expectation_profile(spark, sf_dir):
    """Passed and failed counts of the raw transaction rules."""
    return quality.expectation_profile(D.txn_source(spark, sf_dir), contracts.TXN_RAW.rules)


@query
def expectation_profile_fx(spark, sf_dir):
    return quality.expectation_profile(D.fx_stage_faulty(spark, sf_dir), contracts.FX_RAW.rules)


@query
def expectation_profile_mcc(spark, sf_dir):
    return quality.expectation_profile(D.mcc(spark, sf_dir), contracts.MCC_RAW.rules)


@query
def expectation_profile_sanctions(spark, sf_dir):
    return quality.expectation_profile(D.sanctions(spark, sf_dir), contracts.SANCTIONS_RAW.rules)


@query
def expectation_metrics(spark, sf_dir):
    """The counts a run stores while it drains a stream of many small batches, for the raw transaction rules."""
    root = tables.fresh_path(spark, "metrics")
    source = D.table(spark, sf_dir, "events")
    files_a_batch = tables.land(source, f"{root}/landing", batches=24)
    store = medallion.Store(spark, root)
    events = tables.stream_table(spark, f"{root}/landing", source.schema, files_a_batch)
    store.run("transactions_raw", bronze.txn_raw(D.txn_from_events(events), AS_OF), contracts.TXN_RAW)
    return store.get(medallion.METRICS).select("rule", "passed", "failed")


@query
def expect_or_drop(spark, sf_dir):
    rules = contracts.txn_silver_contract(INSIDE).drop
    return quality.expect_or_drop(D.txn_source(spark, sf_dir), rules).select("txn_id", "amount", "currency", "event_ts")


@query
def expect_or_fail(spark, sf_dir):
    """Guarded clean rows: the guard rides on txn_id and finds nothing to stop at."""
    guarded = quality.expect_or_fail(D.txn_clean(spark, sf_dir), contracts.TXN_STAGE.fail, "txn_id")
    return guarded.select("txn_id", "account_id", "amount")


@query
def row_fate(spark, sf_dir):
    return quality.row_fate(D.txn_source(spark, sf_dir), contracts.txn_clean_rules(), contracts.txn_reasons())


@query
def row_fate_strict_nulls(spark, sf_dir):
    strict = contracts.txn_reasons(strict_nulls=True)
    return quality.row_fate(D.txn_source(spark, sf_dir), contracts.txn_clean_rules(), strict)


@query
def top_reasons(spark, sf_dir):
    return oa.top_reasons(bronze.txn_quarantine(D.txn_source(spark, sf_dir), AS_OF))


@query
def currency_distribution(spark, sf_dir):
    return oa.distribution(D.txn_source(spark, sf_dir), "currency")


@query
def merchant_distribution_bounded(spark, sf_dir):
    """The three most frequent merchants and all others, as the audits' cells have them."""
    return oa.bounded(oa.distribution(D.txn_source(spark, sf_dir), "merchant_name"), "merchant_name", "count", entries=3)


@query
def distinct_sketches(spark, sf_dir):
    """Customers per ISO week from the union of stored daily sketches, against the exact count."""
    txn = D.txn_source(spark, sf_dir).select(F.to_date("event_ts").alias("day"), F.date_trunc("week", "event_ts").cast("date").alias("week"), "customer_id", "txn_id")
    days = tables.hand_over(txn.groupBy("week", "day").agg(fc.distinct_sketch("customer_id").alias("customers"), fc.distinct_sketch("txn_id").alias("txns")), "day_sketches")
    about = days.groupBy("week").agg(fc.distinct_of("customers").alias("about"), fc.distinct_of("txns").alias("about_txns"))
    exact = txn.groupBy("week").agg(fc.distinct("customer_id").alias("customers"), fc.distinct("txn_id").alias("txns"))
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 0.04 * F.col(b) + 0.5
    return about.join(exact, "week").select("week", "customers", "txns", (near("about", "customers") & near("about_txns", "txns")).alias("within_bound"))


@query
def quarantine_share_by_channel(spark, sf_dir):
    held = quality.any_holds(contracts.txn_reasons().values())
    counts = D.txn_source(spark, sf_dir).groupBy("channel").agg(
        F.count("*").alias("total"), fc.count_where(held).alias("held")
    )
    return counts.select("channel", quality.quarantine_pct("held", "total").alias("quarantine_pct"))


@query
def gate_checks(spark, sf_dir):
    """The strict silver gate on the latest of two audit rows."""
    txn = D.txn_silver(spark, sf_dir)
    held = silver.txn_silver_quarantine(D.txn_clean(spark, sf_dir), AS_OF)
    earlier = audits.txn_silver_audit(txn.filter("false"), held, AS_OF - timedelta(days=1))
    log = earlier.unionByName(audits.txn_silver_audit(txn, held, AS_OF))
    return oa.gate_checks(log, max_quarantine_pct=5.0, require_pass=True, require_no_sanctioned=True)


# -- bronze -------------------------------------------------------------------
@query
def fx_raw(spark, sf_dir):
    return bronze.fx_raw(D.fx_stage_faulty(spark, sf_dir))


@query
def fx_parsed(spark, sf_dir):
    """Every staged row comes twice, the second time with another rate."""
    stage = D.fx_stage_faulty(spark, sf_dir)
    again = stage.withColumn("rate", F.col("rate") + 0.5)
    return bronze.fx_parse(stage.unionByName(again), fail=False)


@query
def fx_quarantine(spark, sf_dir):
    return bronze.fx_quarantine(D.fx_stage_faulty(spark, sf_dir), AS_OF)


@query
def fx_audit(spark, sf_dir):
    raw = D.fx_stage_faulty(spark, sf_dir)
    return audits.fx_audit(raw, bronze.fx_parse(raw, fail=False), bronze.fx_quarantine(raw, AS_OF), AS_OF)


@query
def fx_from_payload(spark, sf_dir):
    """Payload documents of one fetch each, rendered by Spark from the staged rates."""
    stage = D.fx_stage(spark, sf_dir)
    docs = stage.groupBy("fetch_ts").agg(
        F.map_from_entries(F.collect_list(F.struct("quote_currency", "rate"))).alias("conversion_rates")
    )
    body = F.struct(
        F.when(F.hour("fetch_ts") == 18, "error").otherwise("success").alias("result"),
        F.lit("GBP").alias("base_code"),
        F.date_format("fetch_ts", "yyyy-MM-dd").alias("time_last_update_utc"),
        # A code that nobody asked for.
        F.map_concat("conversion_rates", F.create_map(F.lit("ZZZ"), F.lit(1.0))).alias("conversion_rates"),
    )
    payloads = docs.select("fetch_ts", F.to_json(body).alias("value"))
    return fx_payload.fx_from_payload(payloads, currencies=V.QUOTE_CURRENCIES)


@query
def mcc_ingest(spark, sf_dir):
    """CSV files written by Spark, then read as a stream with lineage columns."""
    landing = tables.fresh_path(spark, "landing_mcc")
    names = [f.name for f in schemas.MCC_FILE.fields]
    D.mcc(spark, sf_dir).select(*names).write.options(header=True, escape='"').csv(landing)
    stored = tables.fresh_path(spark, "mcc_codes_raw")
    runs.run_stream(files.mcc_ingest(spark, landing, AS_OF), stored, f"{stored}_checkpoint")
    return tables.read_table(spark, stored).drop("source_file", "source_file_modified_ts")


@query
def mcc_malformed(spark, sf_dir):
    """Landed MCC lines of which every 41st is cut off: kept by a stream with their text, and held for it."""
    names = [f.name for f in schemas.MCC_FILE.fields]
    key = D.table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("k"), F.col("p_size").cast("string").alias("size"))
    line = F.concat_ws(",", F.concat(F.lit("c"), "k"), "size", F.lit("Hotels"), F.lit("LOW"), F.lit("N"), F.lit("2024-01-01"), F.lit("2024-02-01"))
    landing = tables.fresh_path(spark, "mcc_landing")
    key.select(F.when(F.col("k").cast("bigint") % 41 == 0, F.concat_ws(",", F.concat(F.lit("c"), "k"), "size")).otherwise(line)).write.text(landing)
    stored = tables.fresh_path(spark, "mcc_raw")
    runs.run_stream(files.mcc_ingest(spark, landing, AS_OF, keep_broken=True, header="false"), stored, f"{stored}_checkpoint")
    held = bronze.mcc_quarantine(tables.read_table(spark, stored), AS_OF)
    return held.select(*names, files.BROKEN, "failure_reasons", "quarantine_ts", "quarantine_status")


@query
def mcc_quarantine(spark, sf_dir):
    return bronze.mcc_quarantine(D.mcc(spark, sf_dir), AS_OF)


@query
def mcc_audit(spark, sf_dir):
    raw = D.mcc(spark, sf_dir)
    return audits.mcc_audit(raw, bronze.mcc_quarantine(raw, AS_OF), AS_OF)


@query
def sanctions_from_documents(spark, sf_dir):
    """Batch form of the envelope reader."""
    exploded = files.explode_envelopes(D.sanction_documents(spark, sf_dir), schemas.SANCTION_ENVELOPE)
    return files.sanctions_records(exploded, AS_OF).withColumn("aliases", F.concat_ws("|", "aliases"))


@query
def sanctions_ingest(spark, sf_dir):
    """Envelope documents written one per file, then read as a stream of whole files."""
    landing = tables.fresh_path(spark, "landing_sanctions")
    D.sanction_documents(spark, sf_dir).select("value").write.option("maxRecordsPerFile", 1).text(landing)
    stored = tables.fresh_path(spark, "sanctions_raw")
    runs.run_stream(files.sanctions_ingest(spark, landing, AS_OF), stored, f"{stored}_checkpoint")
    flat = tables.read_table(spark, stored).drop("source_file", "source_file_modified_ts")
    return flat.withColumn("aliases", F.concat_ws("|", "aliases"))


@query
def sanctions_quarantine(spark, sf_dir):
    return bronze.sanctions_quarantine(D.sanctions(spark, sf_dir).drop("aliases"), AS_OF)


@query
def sanctions_audit(spark, sf_dir):
    raw = D.sanctions(spark, sf_dir)
    return audits.sanctions_audit(raw, bronze.sanctions_quarantine(raw, AS_OF), AS_OF)


def _events_stream(spark, sf_dir):
    # A pattern, as a stream takes a directory or a pattern and the table may be one file.
    source = tables.stream_table(spark, f"{sf_dir}/event[s].parquet", D.table(spark, sf_dir, "events").schema)
    return D.txn_from_events(source)


@query
def txn_ingest(spark, sf_dir):
    """The transaction source as a stream with ingestion columns."""
    stored = tables.fresh_path(spark, "transactions_raw")
    runs.run_stream(bronze.txn_raw(_events_stream(spark, sf_dir), AS_OF), stored, f"{stored}_checkpoint")
    return tables.read_table(spark, stored)


@query
def txn_quarantine(spark, sf_dir):
    return bronze.txn_quarantine(bronze.txn_raw(D.txn_source(spark, sf_dir), AS_OF), AS_OF)


@query
def txn_clean(spark, sf_dir):
    return D.txn_clean(spark, sf_dir)


@query
def txn_audit(spark, sf_dir):
    raw = D.txn_source(spark, sf_dir)
    return audits.txn_audit(raw, bronze.txn_clean(raw), bronze.txn_quarantine(raw, AS_OF), AS_OF)


# -- silver -------------------------------------------------------------------
@query
def txn_silver(spark, sf_dir):
    """Enriched transactions from a source that delivers every row twice."""
    clean = D.txn_clean(spark, sf_dir)
    twice = runs.dedupe_stream(clean.unionByName(clean))
    return _as_double(D.enrich(spark, sf_dir, twice, INSIDE))


def _as_double(txn: DataFrame) -> DataFrame:
    return relational.conform(txn, schemas.TXN_SILVER)


@query
def txn_silver_stream(spark, sf_dir):
    """The same as one triggered stream: watermark, deduplication, stream-static joins."""
    source = bronze.txn_raw(_events_stream(spark, sf_dir), AS_OF)
    clean = bronze.txn_clean(source.unionByName(source))
    stored = tables.fresh_path(spark, "transactions_cleansed")
    runs.run_stream(D.enrich(spark, sf_dir, runs.dedupe_stream(clean)), stored, f"{stored}_checkpoint")
    return _as_double(tables.read_table(spark, stored))


@query
def txn_high_risk(spark, sf_dir):
    return _as_double(silver.high_risk(D.txn_silver(spark, sf_dir)))


@query
def txn_silver_quarantine(spark, sf_dir):
    return silver.txn_silver_quarantine(D.txn_clean(spark, sf_dir), INSIDE)


@query
def txn_silver_audit(spark, sf_dir):
    held = silver.txn_silver_quarantine(D.txn_clean(spark, sf_dir), AS_OF)
    return audits.txn_silver_audit(D.txn_silver(spark, sf_dir), held, AS_OF)


@query
def fx_silver(spark, sf_dir):
    return D.fx_silver(spark, sf_dir)


@query
def fx_silver_without_stale(spark, sf_dir):
    return silver.fx_silver(bronze.fx_parse(D.fx_stage(spark, sf_dir)), exclude_stale=True, as_of=AS_OF)


@query
def fx_pivot(spark, sf_dir):
    return silver.fx_pivot(D.fx_silver(spark, sf_dir), required=(), as_of=AS_OF)


@query
def fx_pivot_required(spark, sf_dir):
    """Fetches that have both required currencies, with the fail rules on them in force."""
    required = ("USD", "EUR")
    return silver.fx_pivot(silver.fx_complete(D.fx_silver(spark, sf_dir), required), required=required, as_of=AS_OF)


@query
def fx_silver_quarantine(spark, sf_dir):
    parsed = bronze.fx_parse(D.fx_stage_faulty(spark, sf_dir), fail=False)
    return silver.fx_silver_quarantine(parsed, AS_OF)


@query
def fx_silver_audit(spark, sf_dir):
    parsed = bronze.fx_parse(D.fx_stage_faulty(spark, sf_dir), fail=False)
    held = silver.fx_silver_quarantine(parsed, AS_OF)
    return audits.fx_silver_audit(silver.fx_silver(parsed, as_of=AS_OF), held, AS_OF)


# -- joins and money ----------------------------------------------------------
@query
def join_fx(spark, sf_dir):
    clean = D.txn_clean(spark, sf_dir).select("txn_id", F.to_date("event_ts").alias("event_date"))
    joined = silver.join_fx(clean, D.fx_daily(spark, sf_dir))
    return joined.select("txn_id", "event_date", *[F.col(f"GBP_{c}").cast("double").alias(f"GBP_{c}") for c in V.QUOTE_CURRENCIES])


@query
def join_mcc(spark, sf_dir):
    code = F.coalesce("merchant_mcc", F.lit(V.UNKNOWN_MCC)).alias("merchant_mcc")
    return silver.join_mcc(D.txn_clean(spark, sf_dir).select("txn_id", code), silver.mcc_levels(D.mcc(spark, sf_dir)))


@query
def flag_sanctioned(spark, sf_dir):
    txn = D.txn_clean(spark, sf_dir).select("txn_id", "counterparty_id")
    return silver.flag_sanctioned(txn, silver.active_sanctions(D.sanctions(spark, sf_dir)))


@query
def flag_sanctioned_large_list(spark, sf_dir):
    """The same beyond the broadcast limit: a shuffle join that splits the keys of more than a few rows."""
    txn = D.txn_clean(spark, sf_dir).select("txn_id", "counterparty_id")
    return silver.flag_sanctioned(txn, silver.active_sanctions(D.sanctions(spark, sf_dir)), max_rows=0, heavy_rows=8)


@query
def to_base_inverted(spark, sf_dir):
    """The true conversion: amount divided by the rate."""
    txn = D.txn_clean(spark, sf_dir).withColumn("event_date", F.to_date("event_ts"))
    joined = silver.join_fx(txn, D.fx_daily(spark, sf_dir))
    gbp = domain.to_base("amount", "currency", invert=True)
    return joined.select("txn_id", "currency", gbp.cast("double").alias("gbp_amount"))


# -- gold ---------------------------------------------------------------------
@query
def daily_risk_summary(spark, sf_dir):
    return gold.daily_risk_summary(D.txn_silver(spark, sf_dir), AS_OF)


def _anomalies(txn):
    return gold.daily_anomaly_flags(txn, velocity=3, night=0, as_of=AS_OF)


@query
def daily_anomaly_flags(spark, sf_dir):
    return _anomalies(D.txn_silver(spark, sf_dir))


@query
def daily_fx_exposure(spark, sf_dir):
    return gold.daily_fx_exposure(D.txn_silver(spark, sf_dir), D.fx_silver(spark, sf_dir), as_of=AS_OF)


@query
def daily_risk_audit(spark, sf_dir):
    txn, fx = tables.hand_over(D.txn_silver(spark, sf_dir), "txn_silver"), D.fx_silver(spark, sf_dir)
    summary, exposure = gold.daily_risk_summary(txn, AS_OF), gold.daily_fx_exposure(txn, fx, as_of=AS_OF)
    return audits.daily_risk_audit(summary, _anomalies(txn), exposure, AS_OF)


@query
def aml_report(spark, sf_dir):
    return gold.aml_report(D.txn_silver(spark, sf_dir), as_of=AS_OF)


def _capital(txn):
    return gold.capital_exposure(txn, capital=100_000, as_of=AS_OF)


@query
def capital_exposure(spark, sf_dir):
    return _capital(D.txn_silver(spark, sf_dir))


def _reports(spark, sf_dir):
    """The two stored regulatory reports over one stored silver table."""
    txn = tables.hand_over(D.txn_silver(spark, sf_dir), "txn_silver")
    aml = tables.hand_over(gold.aml_report(txn, as_of=AS_OF), "aml_report")
    return aml, tables.hand_over(_capital(txn), "capital_exposure")


@query
def regulatory_log(spark, sf_dir):
    return audits.regulatory_log(*_reports(spark, sf_dir), AS_OF)


@query
def regulatory_audit(spark, sf_dir):
    aml, capital = _reports(spark, sf_dir)
    return audits.regulatory_audit(aml, capital, audits.regulatory_log(aml, capital, AS_OF), AS_OF)


# -- aggregates and keys ------------------------------------------------------
@query
def aggregates_by_type(spark, sf_dir):
    """The generic aggregate columns, one of each kind."""
    return D.txn_source(spark, sf_dir).groupBy("txn_type").agg(
        F.count("*").alias("row_count"),
        fc.count_where("country_code <> 'GB'").alias("foreign_count"),
        fc.sum0("amount").cast("double").alias("total"),
        fc.sum_where("currency = 'USD'", "amount").cast("double").alias("usd_total"),
        fc.avg0("amount").cast("double").alias("mean"),
        fc.max0("amount").cast("double").alias("largest"),
        fc.distinct("counterparty_id").alias("counterparties"),
        fc.any_true("is_international").alias("any_international"),
        F.round(fc.stddev(F.col("amount").cast("double")), 4).alias("deviation"),
    )


@query
def count_rows_by_day_and_currency(spark, sf_dir):
    txn = D.txn_source(spark, sf_dir).withColumn("event_date", F.to_date("event_ts"))
    return relational.count_rows(txn, ["event_date", "currency"])


@query
def weighted_sum(spark, sf_dir):
    """Risk-weighted amount per currency; the unlisted type counts nothing."""
    weights = {k: w for k, w in V.RISK_WEIGHTS.items() if k != "TRANSFER"}
    return D.txn_source(spark, sf_dir).groupBy("currency").agg(
        fc.weighted_sum("amount", "txn_type", weights).cast("double").alias("weighted")
    )


@query
def content_hash(spark, sf_dir):
    counts = D.txn_source(spark, sf_dir).agg(F.count("*").alias("n"), F.min("currency").alias("first"), F.max("country_code").alias("last"))
    return counts.select(fc.content_hash({"rows": "n", "first": "first", "last": "last", "none": F.lit(None)}).alias("digest"))


@query
def latest_row(spark, sf_dir):
    return relational.latest(D.txn_source(spark, sf_dir), F.struct("event_ts", F.col("txn_id").cast("bigint")))


@query
def dedupe_newest(spark, sf_dir):
    """Newest transaction per customer and type."""
    order = [F.desc("event_ts"), F.desc(F.col("txn_id").cast("bigint"))]
    return relational.dedupe(D.txn_source(spark, sf_dir), ["customer_id", "txn_type"], order)


@query
def latest_rate_per_currency(spark, sf_dir):
    order = [F.desc("fetch_ts"), F.desc("rate_id")]
    return relational.latest_per(D.fx_stage(spark, sf_dir), ["quote_currency"], order).select("quote_currency", "rate", "fetch_ts")


@query
def rate_snapshot(spark, sf_dir):
    return audits.rate_snapshot(bronze.fx_parse(D.fx_stage(spark, sf_dir)))


@query
def pivot_channels(spark, sf_dir):
    """Total amount per customer, one column per channel."""
    wide = relational.pivot_wide(
        D.txn_source(spark, sf_dir), ["customer_id"], "channel", V.CHANNELS, F.sum("amount").cast("double")
    )
    return wide


@query
def top_customers(spark, sf_dir):
    totals = D.txn_source(spark, sf_dir).groupBy("customer_id").agg(fc.sum0("amount").cast("double").alias("total"))
    return relational.top_k(totals, [F.desc("total"), F.asc("customer_id")], 5)


@query
def key_violations(spark, sf_dir):
    """Account and counterparty is not a key: repeated and NULL parts."""
    return relational.check_key(D.txn_source(spark, sf_dir), ["account_id", "counterparty_id"])


@query
def upsert(spark, sf_dir):
    """All user features updated from the purchases' features."""
    raw = D.fraud_raw(spark, sf_dir)
    names = ["user_id", "txn_count_7d", "max_amount_7d", "unknown_merchant_count"]
    updates = fraud.user_features(raw.filter("merchant = 'purchase'")).select(*names)
    return relational.upsert(fraud.user_features(raw).select(*names), updates, ["user_id"])


@query
def customer_risk_points(spark, sf_dir):
    """Score terms and band per customer."""
    per = D.txn_source(spark, sf_dir).groupBy("customer_id").agg(
        F.lit(0).alias("sanctioned_count"),
        fc.count_where("merchant_mcc = '9999'").alias("high_risk_txn_count"),
        fc.count_where("country_code <> 'GB'").alias("cross_border_count"),
        fc.count_where(domain.in_night(F.hour("event_ts"))).alias("late_night_count"),
        fc.count_where("txn_type = 'REFUND'").alias("refund_count"),
        F.max("amount").alias("max_single_txn_gbp"),
        F.count("*").alias("total_txn_count"),
    )
    scored = per.withColumn("refund_rate_pct", fc.pct("refund_count", "total_txn_count"))
    scored = scored.withColumn("risk_score", domain.risk_score())
    return scored.select("customer_id", "refund_rate_pct", "risk_score", domain.band("risk_score").alias("risk_band"))


# -- windows ------------------------------------------------------------------
@query
def rate_change(spark, sf_dir):
    parsed = bronze.fx_parse(D.fx_stage(spark, sf_dir))
    return windows.rate_change(parsed, move_pct=5.0).select(
        "rate_id", "rate", "prev_rate", "rate_change_pct", "significant_move"
    )


@query
def daily_average(spark, sf_dir):
    return windows.daily_average(bronze.fx_parse(D.fx_stage(spark, sf_dir))).select("rate_id", "rate_date", "daily_avg_rate")


@query
def rolling_sum(spark, sf_dir):
    """Seven-day total per account: few accounts, many rows each."""
    txn = D.txn_source(spark, sf_dir)
    rolled = windows.rolling_sum(txn, "account_id", "event_ts", "amount", 7, "rolling_7d")
    return rolled.select("txn_id", "account_id", F.col("rolling_7d").cast("double").alias("rolling_7d"))


@query
def structuring(spark, sf_dir):
    txn = D.txn_silver(spark, sf_dir)
    rolled = windows.rolling_sum(txn, "customer_id", "event_ts", "gbp_amount", 3, "rolling_3d_gbp")
    return rolled.select("txn_id", domain.structuring().alias("structuring_flag"))


# -- streaming ----------------------------------------------------------------
@query
def txn_quarantine_stream(spark, sf_dir):
    stored = tables.fresh_path(spark, "transactions_quarantine")
    held = bronze.txn_quarantine(bronze.txn_raw(_events_stream(spark, sf_dir), AS_OF), AS_OF)
    runs.run_stream(held, stored, f"{stored}_checkpoint")
    return tables.read_table(spark, stored)


@query
def dedupe_stream(spark, sf_dir):
    """Every event arrives twice; one copy is kept."""
    source = _events_stream(spark, sf_dir).select("txn_id", "customer_id", "event_ts")
    stored = tables.fresh_path(spark, "deduplicated")
    runs.run_stream(runs.dedupe_stream(source.unionByName(source)), stored, f"{stored}_checkpoint")
    return tables.read_table(spark, stored)


@query
def late_rows(spark, sf_dir):
    """One micro-batch per day; a tenth of the rows arrive four days late."""
    k = F.get_json_object("props", "$.k").cast("int")
    arrived = D.table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("event_ts"),
        (F.datediff(F.to_date("ts"), F.lit("2024-01-01")) + F.when(k < 10, 4).otherwise(0)).alias("batch_id"),
    )
    return runs.late_rows(arrived, "batch_id")


# -- features and model -------------------------------------------------------
def _rounded(df: DataFrame) -> DataFrame:
    """Means and deviations of doubles to 6 digits: their last bits depend on the order of summation."""
    return df.withColumns({c: F.round(c, 6) for c in ("avg_amount_7d", "std_amount_7d")})


@query
def user_features(spark, sf_dir):
    return _rounded(fraud.user_features(D.fraud_raw(spark, sf_dir)))


@query
def user_features_windowed(spark, sf_dir):
    return _rounded(fraud.user_features(D.fraud_raw(spark, sf_dir), window_days=7, as_of=AS_OF))


def _training(spark, sf_dir):
    """The features are stored first: the join would measure them in one aggregate and join another."""
    raw = D.fraud_raw(spark, sf_dir)
    return fraud.training_set(raw, tables.hand_over(fraud.user_features(raw), "user_features"))


@query
def training_set(spark, sf_dir):
    return _rounded(_training(spark, sf_dir))


@query
def stratified_split(spark, sf_dir):
    train, test = fraud.stratified_split(D.fraud_raw(spark, sf_dir))
    return train.select("txn_id", F.lit("train").alias("side")).unionByName(test.select("txn_id", F.lit("test").alias("side")))


@query
def stratified_split_exact(spark, sf_dir):
    """A fifth of each label's rows, to the row."""
    train, test = fraud.exact_split(D.fraud_raw(spark, sf_dir))
    return train.select("txn_id", F.lit("train").alias("side")).unionByName(test.select("txn_id", F.lit("test").alias("side")))


def _hand_scored(spark, sf_dir):
    """A score that SQL can state too: amount / 512, unknown merchants half as much."""
    p = F.col("amount") / F.when(F.col("merchant") == "Unknown", 1024).otherwise(512)
    return D.fraud_raw(spark, sf_dir).select(
        "txn_id", "is_fraud", p.alias("fraud_probability"), (p > 0.25).cast("double").alias("prediction")
    )


@query
def confusion(spark, sf_dir):
    return fraud.confusion(_hand_scored(spark, sf_dir))


@query
def class_report(spark, sf_dir):
    return fraud.class_report(_hand_scored(spark, sf_dir))


@query
def report_averages(spark, sf_dir):
    return fraud.report_averages(_hand_scored(spark, sf_dir))


@query
def auc(spark, sf_dir):
    return spark.createDataFrame([(fraud.auc(_hand_scored(spark, sf_dir)),)], "auc double")


@query
def roc_points(spark, sf_dir):
    return fraud.roc_points(_hand_scored(spark, sf_dir), bins=64)


@query
def roc_curve(spark, sf_dir):
    """Every point of the curve; the rates to 9 digits."""
    return fraud.roc_curve(_hand_scored(spark, sf_dir)).withColumns({c: F.round(c, 9) for c in ("tpr", "fpr")})


@query
def fraud_scores(spark, sf_dir):
    """Model trained on the train side, both sides scored: what can be said of the scores whatever the trees."""
    train, test = fraud.exact_split(tables.hand_over(_training(spark, sf_dir), "training_set"))
    model = fraud.train(train)
    scored = tables.hand_over(fraud.score(model, train).withColumn("side", F.lit("train")).unionByName(fraud.score(model, test).withColumn("side", F.lit("test"))), "scores")
    good = {side: fraud.auc(scored.filter(F.col("side") == side)) > least for side, least in (("train", 0.99), ("test", 0.9))}
    p = F.col("fraud_probability")
    return scored.groupBy("side", "is_fraud").agg(
        F.count("*").alias("row_count"),
        fc.count_where(p.between(0, 1) & ((p > 0.5) == (F.col("prediction") == 1))).alias("sound"),
        F.first(F.when(F.col("side") == "train", good["train"]).otherwise(good["test"])).alias("separates"),
    )


@query
def fraud_scores_stream(spark, sf_dir):
    """The training rows scored as a stream of several batches, by a model swapped after the first run: rows, and those scored as in a batch."""
    data = tables.hand_over(_training(spark, sf_dir), "training_set")
    root = tables.fresh_path(spark, "scoring")
    path, out, models = f"{root}/rows", f"{root}/scores", []
    for run, trees in (("first", 1), ("second", 2)):
        model = fraud.train(data, params={"maxIter": trees})
        model.write().save(f"{root}/models/{run}")
        row = spark.range(1).select(F.lit(run).alias("run"), F.lit(f"{root}/models/{run}").alias("path"), F.current_timestamp().alias("created_ts"))
        tables.append(row, f"{root}/model_metrics")
        mine = data.filter((F.col("txn_id").cast("bigint") % 2 == 0) == (run == "first"))
        files_a_batch = tables.land(mine, path, batches=4)
        scored = fraud.score_stream(spark, root, tables.stream_table(spark, path, data.schema, files_a_batch), out, f"{root}/checkpoint")
        models.append(fraud.score(model, mine).select("txn_id", F.col("fraud_probability").alias("p"), F.lit(run).alias("m")))
    same = (F.col("fraud_probability") == F.col("p")) & (F.col("model") == F.col("m"))
    return scored.join(models[0].unionByName(models[1]), "txn_id").groupBy("model").agg(F.count("*").alias("row_count"), fc.count_where(same).alias("as_batch"))
