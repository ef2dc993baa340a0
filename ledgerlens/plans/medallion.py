"""The layers run in order, each reading what the one before stored.

``run_batch`` recomputes everything from source tables; ``run_incremental`` processes what has
arrived since the last run as triggered streams and replaces the days of gold that it touches.  Both store every dataset
under ``root`` so that no step computes its inputs a second time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens import values as V
from ledgerlens.functions.columns import query_time
from ledgerlens.operators.audit import distribution
from ledgerlens.operators.quality import Contract, violation_counts
from ledgerlens.operators.relational import dedupe
from ledgerlens.plans import audits, bronze, contracts, gold, silver
from ledgerlens.sources.files import mcc_ingest, sanctions_ingest
from ledgerlens.sources.tables import append, hand_over, overwrite, read_table, stream_table
from ledgerlens.streaming.runs import dedupe_stream, drain, run_counted, run_stream, use_rocksdb_state

AsOf = Column | datetime | None
#: One row per run, dataset and warn rule: how many rows met it and how many did not.
METRICS = "expectation_metrics"
#: Silver and gold are stored by day.
BY_DAY = ("event_date",)


@dataclass
class Store:
    """Stored datasets by name under one root folder.

    A dataset stored with its contract has the contract's warn rules counted while it is written, without a
    scan of its own; the counts are appended to ``expectation_metrics`` under the current run's id.
    """

    spark: SparkSession
    root: str
    schemas: dict = field(default_factory=dict)
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)

    def begin(self) -> None:
        self.run_id = uuid.uuid4().hex

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/_checkpoints/{name}"

    def put(
        self, name: str, df: DataFrame, partition_by: tuple[str, ...] = (), contract: Contract | None = None
    ) -> DataFrame:
        if contract is None:
            overwrite(df, self.path(name), partition_by)
            return self.get(name)
        seen = Observation(name)
        overwrite(df.observe(seen, *_counts(contract)), self.path(name), partition_by)
        self._record(name, contract, seen.get)
        return self.get(name)

    def replace(self, name: str, df: DataFrame, contract: Contract | None = None) -> None:
        """Replace the days that ``df`` has rows of and leave the others; rebalanced, so that a day is a few files."""
        seen = Observation(name)
        watched = df if contract is None else df.observe(seen, *_counts(contract))
        writer = watched.hint("rebalance", *BY_DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*BY_DAY).parquet(self.path(name))
        if contract is not None:
            self._record(name, contract, seen.get)

    def has(self, name: str) -> bool:
        try:
            self.get(name)
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        return True

    def add(self, name: str, df: DataFrame) -> DataFrame:
        append(df, self.path(name))
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name))

    def stream(self, name: str, schema=None) -> DataFrame:
        """Incremental read of a stored dataset (its layout is the stored one)."""
        return stream_table(self.spark, self.path(name), schema or self.get(name).schema)

    def run(self, name: str, df: DataFrame, contract: Contract | None = None, partition_by: tuple[str, ...] = ()):
        """Drain a stream into the dataset."""
        if contract is None:
            return run_stream(df, self.path(name), self.checkpoint(name), partition_by)
        observed = df.observe(name, *_counts(contract))
        query, counts = run_counted(self.spark, observed, self.path(name), self.checkpoint(name), name, partition_by)
        self._record(name, contract, counts)
        return query

    def _record(self, name: str, contract: Contract, counts: dict[str, int]) -> None:
        """Append the counts; a run that wrote no batch has none."""
        if "_rows" not in counts:
            return
        rows = [(self.run_id, name, r, counts["_rows"] - counts[r], counts[r]) for r in contract.warn]
        schema = "run string, dataset string, rule string, passed bigint, failed bigint"
        self.add(METRICS, self.spark.createDataFrame(rows, schema).coalesce(1))


def _counts(contract: Contract) -> list[Column]:
    return [F.count("*").alias("_rows"), *violation_counts(contract.warn)]


def run_fx(
    store: Store, stage: DataFrame, as_of: AsOf = None, required=("USD", "EUR"), rate_type: str = "double"
) -> DataFrame:
    """Bronze and silver FX with their audits; returns the day's rates."""
    raw = store.put("market_data_raw", bronze.fx_raw(stage), contract=contracts.FX_RAW)
    parsed = store.put("market_data_parsed", bronze.fx_parse(raw))
    held = store.put("market_data_quarantine", bronze.fx_quarantine(raw, as_of))
    store.add("market_data_audit", audits.fx_audit(raw, parsed, held, as_of))
    fx = store.put("fx_rates_silver", silver.fx_silver(parsed, as_of=as_of), contract=contracts.FX_SILVER)
    fx_held = store.put("fx_rates_silver_quarantine", silver.fx_silver_quarantine(parsed, as_of))
    store.add("fx_rates_silver_audit", audits.fx_silver_audit(fx, fx_held, as_of))
    pivoted = store.put("fx_rates_pivoted", silver.fx_pivot(fx, required=required, as_of=as_of))
    return store.put("fx_daily", silver.fx_daily(pivoted, rate_type=rate_type))


GOLD_BY_DAY = ("transactions_high_risk", "daily_risk_summary", "daily_anomaly_flags", "daily_fx_exposure", "basel3_exposure_report")
AML = "aml_transaction_report"


def gold_tables(txn: DataFrame, fx: DataFrame, as_of: AsOf = None) -> dict[str, tuple[DataFrame, Contract | None]]:
    """The gold tables whose rows depend on the transactions of their own day only, with their contracts."""
    return {
        "transactions_high_risk": (silver.high_risk(txn), None),
        "daily_risk_summary": (gold.daily_risk_summary(txn, as_of), contracts.DAILY_RISK),
        "daily_anomaly_flags": (gold.daily_anomaly_flags(txn, as_of=as_of), None),
        "daily_fx_exposure": (gold.daily_fx_exposure(txn, fx, as_of=as_of), contracts.FX_EXPOSURE),
        "basel3_exposure_report": (gold.capital_exposure(txn, as_of=as_of), contracts.CAPITAL_EXPOSURE),
    }


def run_gold(store: Store, as_of: AsOf = None) -> None:
    """Recompute the gold tables and their audits from stored silver."""
    txn, fx = store.get("transactions_cleansed"), store.get("fx_rates_silver")
    for name, (df, contract) in gold_tables(txn, fx, as_of).items():
        store.put(name, df, BY_DAY, contract)
    store.put(AML, gold.aml_report(txn, as_of=as_of), BY_DAY, contracts.AML_REPORT)
    gold_audits(store, as_of)


def gold_audits(store: Store, as_of: AsOf = None) -> None:
    store.put("transactions_channel_counts", distribution(store.get("transactions_cleansed"), "channel"))
    summary, flags, exposure = (store.get(n) for n in ("daily_risk_summary", "daily_anomaly_flags", "daily_fx_exposure"))
    store.add("daily_risk_audit", audits.daily_risk_audit(summary, flags, exposure, as_of))
    aml, capital = store.get(AML), store.get("basel3_exposure_report")
    log = store.add("regulatory_audit_log", audits.regulatory_log(aml, capital, as_of))
    store.add("regulatory_pipeline_audit", audits.regulatory_audit(aml, capital, log, as_of))


def around(days: set[date], before: int = 0, after: int = 0) -> list[date]:
    return sorted({d + timedelta(days=n) for d in days for n in range(-before, after + 1)})


def replace_gold(store: Store, days: set[date], as_of: AsOf = None, window: int = V.STRUCTURING_DAYS) -> None:
    """Recompute the gold tables for these days of stored silver, and replace just their partitions.

    Only the days' own transactions are read.  The AML report looks back ``window`` days, so a day also changes the reports of as
    many days after it, and these need as many days before them.
    """
    txn, fx = store.get("transactions_cleansed"), store.get("fx_rates_silver")
    mine = txn.filter(F.col("event_date").isin(sorted(days)))
    for name, (df, contract) in gold_tables(mine, fx, as_of).items():
        store.replace(name, df, contract)
    changed = around(days, after=window)
    seen = txn.filter(F.col("event_date").isin(around(set(changed), before=window)))
    report = gold.aml_report(seen, as_of=as_of).filter(F.col("event_date").isin(changed))
    store.replace(AML, report, contracts.AML_REPORT)


def changed_rate_days(store: Store) -> set[date]:
    """Days whose FX rates differ from those that the last call saw; their exposure is stale."""
    new = gold.fx_day_rates(store.get("fx_rates_silver"))
    days: set[date] = set()
    if store.has("fx_day_rates"):
        old = store.get("fx_day_rates").select(*new.columns)
        days = {r[0] for r in new.exceptAll(old).unionByName(old.exceptAll(new)).select("event_date").distinct().collect()}
    store.put("fx_day_rates", hand_over(new, "fx_day_rates"))
    return days - {None}


def run_gold_incremental(store: Store, as_of: AsOf = None) -> None:
    """Gold for the days of the silver rows that have arrived since the last call, and of changed FX rates.

    The arrived rows are followed as a stream of their own.  A batch is done once its days' partitions are replaced; one that fails is
    repeated and replaces the same partitions again.
    """

    def write(batch: DataFrame, number: int) -> None:
        days = {r[0] for r in batch.select("event_date").distinct().collect()} - {None}
        if days:
            replace_gold(store, days, as_of)

    stale = changed_rate_days(store)
    drain(store.stream("transactions_cleansed").writeStream.foreachBatch(write).option("checkpointLocation", store.checkpoint("gold")))
    if stale:
        txn = store.get("transactions_cleansed").filter(F.col("event_date").isin(sorted(stale)))
        store.replace("daily_fx_exposure", gold.daily_fx_exposure(txn, store.get("fx_rates_silver"), as_of=as_of))
    if store.has(AML):
        gold_audits(store, as_of)


def run_batch(
    store: Store,
    transactions: DataFrame,
    fx_stage: DataFrame,
    mcc: DataFrame,
    sanctions: DataFrame,
    as_of: AsOf = None,
    money: str = "double",
    rate_type: str = "double",
    required=("USD", "EUR"),
) -> None:
    """All layers from batch inputs (``mcc`` and ``sanctions`` with their lineage columns)."""
    store.begin()
    daily = run_fx(store, fx_stage, as_of, required, rate_type)
    mcc = store.put("mcc_codes_raw", mcc, contract=contracts.MCC_RAW)
    mcc_held = store.put("mcc_codes_quarantine", bronze.mcc_quarantine(mcc, as_of))
    store.add("mcc_files_audit", audits.mcc_audit(mcc, mcc_held, as_of))
    listed = store.put("sanctions_raw", sanctions, contract=contracts.SANCTIONS_RAW)
    listed_held = store.put("sanctions_quarantine", bronze.sanctions_quarantine(listed, as_of))
    store.add("sanction_files_audit", audits.sanctions_audit(listed, listed_held, as_of))

    # One scan labels every row; both sides then read their own partitions of it.
    raw = bronze.txn_raw(transactions, as_of)
    routed = store.put("transactions_raw", bronze.txn_routed(raw), ("row_fate",), contracts.TXN_RAW)
    held = routed.filter(F.col("row_fate").isin("quarantine", "both")).drop("row_fate")
    held = held.withColumns({"quarantine_ts": query_time(as_of), "quarantine_status": F.lit(V.PENDING)})
    clean = routed.filter(F.col("row_fate").isin("clean", "both")).drop("row_fate", "failure_reasons")
    # Stored: the time of quarantine is the run's from here on, and reviewers have a table to work on.
    held = store.put("transactions_quarantine", held)
    clean = store.put("transactions_cleansed_stage", contracts.TXN_STAGE.enforce(clean))
    store.add("transactions_data_audit", audits.txn_audit(routed, clean, held, as_of))
    store.put("transactions_currency_counts", distribution(routed, "currency"))

    levels = store.put("mcc_levels", silver.mcc_levels(mcc))
    active = store.put("active_sanctions", silver.active_sanctions(listed))
    unique = dedupe(clean, ["txn_id", "event_ts"])
    enriched = silver.txn_enrich(unique, daily, levels, active, as_of, money)
    txn = store.put("transactions_cleansed", enriched, BY_DAY, contracts.txn_silver_contract(as_of))
    txn_held = store.put("transactions_silver_quarantine", silver.txn_silver_quarantine(clean, as_of))
    store.add("transactions_silver_audit", audits.txn_silver_audit(txn, txn_held, as_of))
    run_gold(store, as_of)


def run_incremental(
    store: Store,
    transactions_path: str,
    fx_stage: DataFrame,
    mcc_path: str,
    sanctions_path: str,
    as_of: AsOf = None,
    required=("USD", "EUR"),
) -> None:
    """Drain newly landed files and rows through bronze and silver, then the days of gold they touch."""
    store.begin()
    spark = store.spark
    use_rocksdb_state(spark)
    daily = run_fx(store, fx_stage, as_of, required)
    store.run("mcc_codes_raw", mcc_ingest(spark, mcc_path, as_of, keep_broken=True), contracts.MCC_RAW)
    store.run("mcc_codes_quarantine", bronze.mcc_quarantine(store.stream("mcc_codes_raw"), as_of))
    store.run("sanctions_raw", sanctions_ingest(spark, sanctions_path, as_of, keep_broken=True), contracts.SANCTIONS_RAW)
    store.run("sanctions_quarantine", bronze.sanctions_quarantine(store.stream("sanctions_raw"), as_of))
    mcc, listed = store.get("mcc_codes_raw"), store.get("sanctions_raw")
    store.add("mcc_files_audit", audits.mcc_audit(mcc, store.get("mcc_codes_quarantine"), as_of))
    store.add("sanction_files_audit", audits.sanctions_audit(listed, store.get("sanctions_quarantine"), as_of))

    source = stream_table(spark, transactions_path, schemas.TXN_SOURCE, V.MAX_FILES_PER_TRIGGER)
    store.run("transactions_raw", bronze.txn_raw(source, as_of), contracts.TXN_RAW)
    store.run("transactions_quarantine", bronze.txn_quarantine(store.stream("transactions_raw"), as_of))
    store.run("transactions_cleansed_stage", bronze.txn_clean(store.stream("transactions_raw")))
    raw, clean = store.get("transactions_raw"), store.get("transactions_cleansed_stage")
    store.add("transactions_data_audit", audits.txn_audit(raw, clean, store.get("transactions_quarantine"), as_of))
    store.put("transactions_currency_counts", distribution(raw, "currency"))

    levels = store.put("mcc_levels", silver.mcc_levels(mcc))
    active = store.put("active_sanctions", silver.active_sanctions(listed))
    unique = dedupe_stream(store.stream("transactions_cleansed_stage"))
    enriched = silver.txn_enrich(unique, daily, levels, active, as_of)
    store.run("transactions_cleansed", enriched, contracts.txn_silver_contract(as_of), BY_DAY)
    staged = store.stream("transactions_cleansed_stage")
    store.run("transactions_silver_quarantine", silver.txn_silver_quarantine(staged, as_of))
    txn, held = store.get("transactions_cleansed"), store.get("transactions_silver_quarantine")
    store.add("transactions_silver_audit", audits.txn_silver_audit(txn, held, as_of))
    run_gold_incremental(store, as_of)
