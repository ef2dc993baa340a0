import json
import os
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import views
from checks.queries import REGISTRY
from ledgerlens import schemas
from ledgerlens.operators import quality, relational
from ledgerlens.plans import audits, bronze, contracts, medallion, silver
from ledgerlens.sources import files, fx_payload, tables
from ledgerlens.streaming import runs


def rows(df):
    return sorted(map(str, df.collect()))


def land(spark, folder, batch, name, modified):
    """Write one parquet file per micro-batch with a growing modification time."""
    part = str(folder / f"_{name}")
    batch.coalesce(1).write.parquet(part)
    source = next(f for f in os.listdir(part) if f.endswith(".parquet"))
    target = folder / "in" / f"{name}.parquet"
    target.parent.mkdir(exist_ok=True)
    os.link(f"{part}/{source}", target)
    os.utime(target, (modified, modified))


BATCHES = [
    [("a", "10:00")],
    [("b", "12:00")],
    [("c", "10:30"), ("b", "12:00"), ("b", "12:05")],  # still kept; duplicate; same id at another time
    [("d", "10:40"), ("e", "11:30"), ("a", "10:00")],  # late; in time; late duplicate
]


@pytest.fixture
def batches(spark, tmp_path):
    now = int(time.time()) - 1000
    for i, batch in enumerate(BATCHES):
        df = spark.createDataFrame([(k, f"2024-01-01 {t}:00") for k, t in batch], "txn_id string, event_ts string")
        df = df.withColumn("event_ts", F.col("event_ts").cast("timestamp"))
        land(spark, tmp_path, df, f"b{i}", now + i * 10)
    return tmp_path


def test_watermark_dedupe_over_four_batches(spark, batches):
    schema = spark.read.parquet(str(batches / "in")).schema
    source = tables.stream_table(spark, str(batches / "in"), schema, max_files=1)
    out, mark = str(batches / "out"), str(batches / "cp")
    query = runs.run_stream(runs.dedupe_stream(source), out, mark)
    got = {(r.txn_id, r.event_ts.strftime("%H:%M")) for r in tables.read_table(spark, out).collect()}
    assert got == {("a", "10:00"), ("b", "12:00"), ("c", "10:30"), ("b", "12:05"), ("e", "11:30")}
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    assert dropped == 2
    # Running again finds nothing new.
    runs.run_stream(runs.dedupe_stream(tables.stream_table(spark, str(batches / "in"), schema, 1)), out, mark)
    assert tables.read_table(spark, out).count() == 5


def test_late_rows_says_what_the_stream_drops(spark):
    data = [(i, k, datetime.fromisoformat(f"2024-01-01 {t}:00")) for i, b in enumerate(BATCHES) for k, t in b]
    late = runs.late_rows(spark.createDataFrame(data, "batch_id int, txn_id string, event_ts timestamp"), "batch_id")
    assert {(r.batch_id, r.txn_id) for r in late.collect()} == {(3, "d"), (3, "a")}


def test_dedupe_with_rocksdb_state(spark, batches):
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    runs.use_rocksdb_state(spark)
    schema = spark.read.parquet(str(batches / "in")).schema
    source = tables.stream_table(spark, str(batches / "in"), schema, max_files=1)
    runs.run_stream(runs.dedupe_stream(source), str(batches / "out2"), str(batches / "cp2"))
    spark.conf.set(provider, before)
    assert tables.read_table(spark, str(batches / "out2")).count() == 5


def test_stream_expectation_counts(spark, batches):
    schema = spark.read.parquet(str(batches / "in")).schema
    source = tables.stream_table(spark, str(batches / "in"), schema, max_files=2)
    watched, name = quality.expect(source, {"is_b": "txn_id = 'b'", "known": "txn_id IS NOT NULL"}, "seen")
    _, counts = runs.run_counted(spark, watched, str(batches / "out3"), str(batches / "cp3"), name)
    assert counts == {"is_b": 5, "known": 0}


def test_counts_of_more_batches_than_a_query_remembers(spark, tmp_path):
    spark.range(1040).repartition(104).write.parquet(str(tmp_path / "in"))
    source = tables.stream_table(spark, str(tmp_path / "in"), spark.range(0).schema, max_files=1)
    watched, name = quality.expect(source, {"even": "id % 2 = 0"}, "many")
    query, counts = runs.run_counted(spark, watched, str(tmp_path / "out"), str(tmp_path / "cp"), name)
    assert counts == {"even": 520} and len(query.recentProgress) <= 100 < query.lastProgress.batchId + 1
    _, again = runs.run_counted(spark, watched, str(tmp_path / "out"), str(tmp_path / "cp"), name)
    assert again == {}  # nothing new


def test_a_counted_batch_takes_as_many_files_as_its_rows_need(spark, tmp_path, monkeypatch):
    """The query's batches stay 24 however many rows there are, each of several files that tasks read side by side."""
    events = spark.range(2400).select(
        F.col("id").alias("event_id"), F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00'").alias("ts"), (F.col("id") % 50).alias("user_id"),
        F.lit("view").alias("event_type"), (F.col("id") % 10 * 1.0).alias("value"), F.lit('{"k": 7}').alias("props"),
    )
    events.write.parquet(str(tmp_path / "events.parquet"))
    drained, land, run = [], tables.land, runs.run_stream
    monkeypatch.setattr(tables, "land", lambda df, path, batches: land(df, path, batches, rows=20))
    monkeypatch.setattr(runs, "run_stream", lambda *args: drained.append((args[1], run(*args))) or drained[-1][1])
    counts = {r["rule"]: (r["passed"], r["failed"]) for r in REGISTRY["expectation_metrics"](spark, str(tmp_path)).collect()}
    ((path, query),) = drained
    assert counts["valid_txn_id"] == (2400, 0) and sum(counts["positive_amount"]) == 2400
    assert query.lastProgress.batchId == 23
    landed = spark.read.parquet(f"{os.path.dirname(path)}/landing")
    sizes = [r["count"] for r in landed.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 24 * 5 and max(sizes) <= 25


def test_fail_expectation_stops_a_stream(spark, batches):
    schema = spark.read.parquet(str(batches / "in")).schema
    source = tables.stream_table(spark, str(batches / "in"), schema)
    guarded = quality.expect_or_fail(source, {"no_c": "txn_id <> 'c'"}, "txn_id")
    with pytest.raises(Exception, match="no_c"):
        runs.run_stream(guarded, str(batches / "out4"), str(batches / "cp4"))


# -- files --------------------------------------------------------------------
CSV = 'mcc_code,description,category,risk_level,requires_enhanced_dd,effective_date,last_updated\n'


def test_csv_feed(spark, tmp_path):
    landing = tmp_path / "mcc"
    landing.mkdir()
    (landing / "a.csv").write_text(CSV + '1000,"Say ""hi"", all",Hotels,LOW,Y,2024-01-01,2024-01-02\n1001,,Hotels,BAD,N,,\n')
    out = str(tmp_path / "mcc_raw")
    runs.run_stream(files.mcc_ingest(spark, str(landing)), out, str(tmp_path / "cp"))
    got = {r.mcc_code: r for r in tables.read_table(spark, out).collect()}
    assert got["1000"].description == 'Say "hi", all'
    assert got["1001"].description is None and got["1001"].effective_date is None
    assert got["1000"].source_file.endswith("a.csv") and got["1000"].source_file_modified_ts is not None
    # A second file is picked up alone; the stream and the batch quarantine agree.
    (landing / "b.csv").write_text(CSV + "1002,x,Hotels,HIGH,?,2024-01-01,2024-01-02\n")
    runs.run_stream(files.mcc_ingest(spark, str(landing)), out, str(tmp_path / "cp"))
    raw = tables.read_table(spark, out)
    assert raw.count() == 3
    at = datetime(2024, 1, 1)
    held = str(tmp_path / "held")
    runs.run_stream(bronze.mcc_quarantine(tables.stream_table(spark, out, raw.schema), at), held, str(tmp_path / "cp2"))
    assert rows(tables.read_table(spark, held)) == rows(bronze.mcc_quarantine(raw, at))
    audit = audits.mcc_audit(raw, tables.read_table(spark, held)).first()
    assert (audit.mcc_total_rows, audit.mcc_files_processed, audit.audit_status) == (3, 2, "FAIL")


def test_sanctions_feed_with_bad_files(spark, tmp_path):
    landing = tmp_path / "san"
    landing.mkdir()
    record = {"entity_id": "E1", "entity_type": "VESSEL", "full_name": "X", "aliases": ["a", "b"], "is_active": True,
              "risk_score": 0.5, "sanctions_program": "OFAC_SDN", "surprise": 1}
    docs = {
        "good.json": json.dumps({"schema_version": "1", "record_count": 1, "records": [record]}, indent=2),
        "empty.json": json.dumps({"record_count": 0, "records": []}),
        "short.json": json.dumps({"record_count": 3, "records": [record]}),
        "broken.json": '{"record_count": 1, "records": [',
    }
    for name, text in docs.items():
        (landing / name).write_text(text)
    out = str(tmp_path / "raw")
    runs.run_stream(files.sanctions_ingest(spark, str(landing)), out, str(tmp_path / "cp"))
    got = tables.read_table(spark, out).collect()
    assert sorted(os.path.basename(r.source_file) for r in got) == ["good.json", "short.json"]
    assert got[0].aliases == ["a", "b"] and got[0].is_active is True
    kept = str(tmp_path / "kept")
    runs.run_stream(files.sanctions_ingest(spark, str(landing), keep_bad_files=True), kept, str(tmp_path / "cp2"))
    flags = {os.path.basename(r.source_file): r.bad_file for r in tables.read_table(spark, kept).collect()}
    assert flags == {"good.json": False, "empty.json": False, "short.json": True, "broken.json": True}


def test_broken_lines_and_files_end_in_quarantine(spark, tmp_path):
    """With their file, text and reason, in a stream and in a batch; what can be read is unchanged."""
    at = datetime(2024, 1, 1)
    (tmp_path / "mcc").mkdir()
    (tmp_path / "mcc" / "a.csv").write_text(CSV + "1000,Inns,Hotels,LOW,Y,2024-01-01,2024-01-02\n1001,cut off\n1002,a,b,LOW,N,c,d,too,many\n")
    source = files.mcc_ingest(spark, str(tmp_path / "mcc"), at, keep_broken=True)
    runs.run_stream(source, str(tmp_path / "raw"), str(tmp_path / "cp"))
    stored = tables.read_table(spark, str(tmp_path / "raw"))
    batch = files.with_ingestion(files.with_lineage(files.read_csv(spark, str(tmp_path / "mcc"), schemas.MCC_FILE, keep_broken=True)), as_of=at)
    for raw in (stored, batch):
        held = {r.broken_record: r for r in bronze.mcc_quarantine(raw.cache(), at).collect()}
        assert raw.count() == 3 and held.keys() == {"1001,cut off", "1002,a,b,LOW,N,c,d,too,many"}
        assert all(r.source_file.endswith("a.csv") and "malformed_record" in r.failure_reasons for r in held.values())
    assert [r.merchant_mcc for r in silver.mcc_levels(stored).collect()] == ["1000"]
    (tmp_path / "san").mkdir()
    record = {"entity_id": "E1", "entity_type": "VESSEL", "full_name": "X", "risk_score": 0.5, "sanctions_program": "OFAC_SDN"}
    docs = {"good.json": json.dumps({"record_count": 1, "records": [record]}), "empty.json": '{"record_count": 0, "records": []}', "broken.json": '{"record_count": 1, "records": ['}
    for name, text in docs.items():
        (tmp_path / "san" / name).write_text(text)
    source = files.sanctions_ingest(spark, str(tmp_path / "san"), at, keep_broken=True)
    runs.run_stream(source, str(tmp_path / "sraw"), str(tmp_path / "cp2"))
    texts = files.with_lineage(spark.read.text(str(tmp_path / "san"), wholetext=True))
    batch = files.sanctions_records(files.explode_envelopes(texts, schemas.SANCTION_ENVELOPE, keep_broken=True), at)
    for raw in (tables.read_table(spark, str(tmp_path / "sraw")), batch):
        (held,) = bronze.sanctions_quarantine(raw, at).collect()
        assert held.broken_record == docs["broken.json"] and held.source_file.endswith("broken.json") and "malformed_record" in held.failure_reasons
        assert raw.count() == 2


def test_fx_payload_rows(spark):
    ok = {"result": "success", "base_code": "GBP", "time_last_update_utc": "Fri, 27 Mar 2020 00:00:01 +0000",
          "conversion_rates": {"USD": 1.25, "EUR": 2, "ZZZ": 9.0}}
    docs = [(json.dumps(ok),), (json.dumps({**ok, "result": "error"}),), ("not json",)]
    df = spark.createDataFrame(docs, "value string").withColumn("fetch_ts", F.lit("2024-01-02 03:04:05").cast("timestamp"))
    got = {r.rate_id: r.rate for r in fx_payload.fx_from_payload(df).collect()}
    assert got == {"GBPUSD_202401020304": 1.25, "GBPEUR_202401020304": 2.0}


# -- transactions: stream equals batch ---------------------------------------
def test_transaction_streams_equal_batch(spark, sf_dir, tmp_path):
    source = tables.stream_table(spark, f"{sf_dir}/event[s].parquet", views.table(spark, sf_dir, "events").schema)
    raw_batch = bronze.txn_raw(views.txn_source(spark, sf_dir), views.AS_OF)
    steps = {
        "clean": lambda raw: bronze.txn_clean(raw),
        "held": lambda raw: bronze.txn_quarantine(raw, views.AS_OF),
    }
    for name, step in steps.items():
        out = str(tmp_path / name)
        runs.run_stream(step(bronze.txn_raw(views.txn_from_events(source), views.AS_OF)), out, str(tmp_path / f"cp_{name}"))
        assert rows(tables.read_table(spark, out)) == rows(step(raw_batch))


# -- all layers ---------------------------------------------------------------
GOLD = ("daily_risk_summary", "daily_anomaly_flags", "daily_fx_exposure", "aml_transaction_report", "basel3_exposure_report")


def test_incremental_run_equals_batch_run(spark, sf_dir, tmp_path):
    txn = views.txn_source(spark, sf_dir).withColumn("amount", F.col("amount").cast("double"))
    landed = str(tmp_path / "transactions_source")
    tables.append(txn.coalesce(1), landed)
    mcc_dir, san_dir = str(tmp_path / "mcc"), str(tmp_path / "sanctions")
    names = [f.name for f in schemas.MCC_FILE.fields]
    views.mcc(spark, sf_dir).select(*names).coalesce(1).write.options(header=True, escape='"').csv(mcc_dir)
    views.sanction_documents(spark, sf_dir).select("value").write.option("maxRecordsPerFile", 1).text(san_dir)
    stage = views.fx_stage(spark, sf_dir)
    stream = medallion.Store(spark, str(tmp_path / "stream"))
    medallion.run_incremental(stream, landed, stage, mcc_dir, san_dir, views.AS_OF, required=())
    batch = medallion.Store(spark, str(tmp_path / "batch"))
    medallion.run_batch(
        batch, txn, stage, stream.get("mcc_codes_raw"), stream.get("sanctions_raw"), views.AS_OF, required=()
    )
    for name in ("transactions_quarantine", "transactions_cleansed_stage", "transactions_high_risk"):
        assert stream.get(name).count() == batch.get(name).count() > 0, name
    for name in GOLD:
        a, b = stream.get(name), batch.get(name)
        # Sums of doubles depend on their order in the last bit, so a rounded cent may differ.
        doubles = [f.name for f in a.schema if f.dataType.simpleString() == "double"]
        exact = [c for c in a.columns if c not in doubles]
        assert a.count() > 0
        assert rows(a.select(*exact)) == rows(b.select(*exact)), name
        key = [c for c in ("txn_id", "customer_id", "currency", "event_date") if c in exact]
        for x, y in zip(a.orderBy(*key).collect(), b.orderBy(*key).collect(), strict=True):
            assert [x[c] for c in doubles] == pytest.approx([y[c] for c in doubles], abs=0.011), name
    for name in ("transactions_data_audit", "transactions_silver_audit", "market_data_audit", "regulatory_audit_log"):
        assert stream.get(name).first().asDict().keys() == batch.get(name).first().asDict().keys()
    mine, other = stream.get("transactions_data_audit").first(), batch.get("transactions_data_audit").first()
    assert mine == other and mine.good_rows + mine.quarantine_rows < mine.total_rows
    for store in (stream, batch):
        counted = store.get(medallion.METRICS)
        assert counted.select("run").distinct().count() == 1 and counted.select("dataset").distinct().count() == 10
        for name, contract in (("transactions_raw", contracts.TXN_RAW), ("transactions_cleansed", contracts.txn_silver_contract(views.AS_OF)),
                               ("sanctions_raw", contracts.SANCTIONS_RAW), ("daily_risk_summary", contracts.DAILY_RISK)):
            mine = counted.filter(F.col("dataset") == name).select("rule", "passed", "failed")
            assert rows(mine) == rows(quality.expectation_profile(store.get(name), contract.warn)), name
    # Nothing new has landed: draining the source again adds nothing.
    source = tables.stream_table(spark, landed, schemas.TXN_SOURCE)
    before = stream.get("transactions_raw").count()
    stream.run("transactions_raw", bronze.txn_raw(source, views.AS_OF))
    assert stream.get("transactions_raw").count() == before


def test_late_file_rewrites_only_the_days_it_touches(spark, tmp_path):
    """Gold after a second file equals gold computed anew, and days out of its reach keep their files."""
    ids = F.col("id").cast("int")
    silver_rows = spark.range(4000).select(
        F.col("id").cast("string").alias("txn_id"), (ids % 20).cast("string").alias("account_id"), (ids % 15).cast("string").alias("customer_id"),
        F.lit(None).cast("string").alias("counterparty_id"), F.lit("PURCHASE").alias("txn_type"), F.lit("atm").alias("channel"),
        (ids % 900 + 1000.0).alias("amount"), F.when(ids % 2 == 0, "USD").otherwise("GBP").alias("currency"), (ids % 900 + 1000.0).alias("gbp_amount"),
        F.timestamp_seconds(1_704_067_200 + ids * 400).alias("event_ts"),
    )
    full = silver_rows.withColumns({
        "merchant_name": F.lit("m"), "merchant_mcc": F.lit("6051"), "merchant_risk_level": F.lit("LOW"), "country_code": F.lit("US"),
        "is_international": F.lit(True), "is_cross_border": F.lit(True), "is_high_risk_merchant": F.lit(True), "counterparty_sanctioned": F.lit(False),
        "device_id": F.lit("d"), "ip_address": F.lit("i"), "event_date": F.to_date("event_ts"), "txn_hour": F.hour("event_ts"),
        "txn_day_of_week": F.dayofweek("event_ts"), "silver_processed_ts": F.lit(views.AS_OF), "pipeline_version": F.lit("1"),
    })
    full = relational.conform(full, schemas.TXN_SILVER)
    late = (F.col("event_date") == "2024-01-08") & (F.col("txn_id").cast("int") % 7 == 0)
    fx = spark.createDataFrame([("USD", datetime(2024, 1, d).date(), 1.0 + d, False) for d in range(1, 20)], "quote_currency string, rate_date date, rate double, significant_move boolean")

    store = medallion.Store(spark, str(tmp_path / "lake"))
    store.put("fx_rates_silver", fx)
    full.filter(~late).write.partitionBy("event_date").parquet(store.path("transactions_cleansed"))
    medallion.run_gold_incremental(store, views.AS_OF)

    def files_of(name):
        return {str(f.relative_to(tmp_path)): f.stat().st_mtime_ns for f in (tmp_path / "lake" / name).glob("event_date=*/*.parquet")}

    names = (*medallion.GOLD_BY_DAY, medallion.AML)
    before = {n: files_of(n) for n in names}
    full.filter(late).write.mode("append").partitionBy("event_date").parquet(store.path("transactions_cleansed"))
    medallion.run_gold_incremental(store, views.AS_OF)
    whole = medallion.Store(spark, str(tmp_path / "whole"))
    whole.put("fx_rates_silver", fx)
    whole.put("transactions_cleansed", full, ("event_date",))
    medallion.run_gold(whole, views.AS_OF)
    for name in names:
        touched = {f.split("event_date=")[1][:10] for f in files_of(name).items() - before[name].items() for f in [f[0]]}
        assert touched == ({f"2024-01-{d:02d}" for d in (8, 9, 10, 11)} if name == medallion.AML else {"2024-01-08"}), name
        got = store.get(name)
        assert rows(got) == rows(whole.get(name).select(*got.columns)) and got.count() > 0, name
    # A changed rate alone refreshes that day's exposure.
    store.put("fx_rates_silver", fx.withColumn("rate", F.when(F.dayofmonth("rate_date") == 3, 9.0).otherwise(F.col("rate"))))
    before = files_of("daily_fx_exposure")
    medallion.run_gold_incremental(store, views.AS_OF)
    assert {f.split("event_date=")[1][:10] for f, _ in files_of("daily_fx_exposure").items() - before.items()} == {"2024-01-03"}
    assert store.get("daily_fx_exposure").filter("event_date = '2024-01-03'").first().daily_avg_rate == 9.0


def test_pivot_stops_without_a_required_pair(spark):
    from ledgerlens.plans import silver

    df = spark.createDataFrame([("r", "GBP", "EUR", 1.0)], "rate_id string, base_currency string, quote_currency string, rate double")
    df = df.withColumns({"fetch_ts": F.lit("2024-01-01").cast("timestamp"), "rate_date": F.lit("2024-01-01").cast("date")})
    with pytest.raises(Exception, match="pivoted_has_usd"):
        silver.fx_pivot(df).collect()
    assert silver.fx_pivot(df, required=("EUR",)).first().GBP_EUR == 1.0


def test_contract_watch_counts_before_dropping(spark):
    df = spark.createDataFrame([("r", 1.0), (None, -1.0)], "rate_id string, rate double")
    watched, seen = contracts.FX_PARSED.watch(df, "fx")
    assert contracts.FX_PARSED.enforce(watched, fail=False).count() == 1
    assert seen.get == {"parsed_rate_positive": 1, "no_duplicate_rate_id": 1}
