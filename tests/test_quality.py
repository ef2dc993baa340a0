import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from ledgerlens import schemas
from ledgerlens.operators import audit as oa
from ledgerlens.operators import quality as q
from ledgerlens.plans import audits, bronze, contracts

RULES = {"positive": "x > 0", "small": "x < 10"}


@pytest.fixture
def xs(spark):
    return spark.createDataFrame([(1, 5), (2, -5), (3, None), (4, 50)], "id int, x int")


def test_warn_keeps_rows_and_counts_null_as_violation(xs):
    df, seen = q.expect(xs, RULES, "warn")
    assert isinstance(seen, Observation)
    assert df.count() == 4
    assert seen.get == {"positive": 2, "small": 2}


def test_drop_keeps_only_true(xs):
    assert [r.id for r in q.expect_or_drop(xs, RULES).collect()] == [1]


def test_fail_names_the_broken_rule(xs):
    with pytest.raises(Exception, match="expectation failed: positive"):
        q.expect_or_fail(xs.filter("id <> 4"), RULES, "x").collect()
    with pytest.raises(Exception, match="expectation failed: small"):
        q.expect_or_fail(xs.filter("id = 4"), RULES, "x").collect()
    assert q.expect_or_fail(xs.filter("id = 1"), RULES, "x").count() == 1


def test_fail_guard_is_not_reached_by_rows_an_earlier_filter_removes(spark, xs):
    guarded = q.expect_or_fail(xs.filter("x > 0 AND x < 10"), RULES, "id").filter("id IS NOT NULL AND id > 0")
    for limit in ("1", "65535"):
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", limit)
        assert [r.id for r in guarded.select("id").collect()] == [1]
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def test_profile(xs):
    got = {r.rule: (r.passed, r.failed) for r in q.expectation_profile(xs, RULES).collect()}
    assert got == {"positive": (2, 2), "small": (2, 2)}


def test_quarantine_joins_reasons_in_rule_order(spark):
    row = (None, "a", "c", None, "GIFT", "atm", -1.0, "XXX", None, None, "GB", False, None, None, None, 1, 1)
    held = bronze.txn_quarantine(spark.createDataFrame([row], schemas.TXN_SOURCE)).collect()
    assert held[0].failure_reasons == (
        "null_txn_id, non_positive_amount, null_event_ts, invalid_currency, invalid_txn_type"
    )
    assert held[0].quarantine_status == "PENDING_REVIEW"


@pytest.mark.parametrize(
    "row, reason",
    [
        ((None, "GBP", "USD", 1.0, "2024-01-01"), "null_rate_id"),
        (("r", "GBP", "USD", 0.0, "2024-01-01"), "non_positive_rate"),
        (("r", "GBP", "USD", 1.0, None), "null_fetch_ts"),
        (("r", "EUR", "USD", 1.0, "2024-01-01"), "unexpected_base_currency"),
        (("r", "GBP", "XXX", 1.0, "2024-01-01"), "unknown_quote_currency"),
        (("r", "GBP", "USD", 100001.0, "2024-01-01"), "rate_suspiciously_high"),
    ],
)
def test_each_fx_reason_alone(spark, row, reason):
    df = spark.createDataFrame(
        [row], "rate_id string, base_currency string, quote_currency string, rate double, fetch_ts string"
    )
    assert [r.failure_reasons for r in bronze.fx_quarantine(df).collect()] == [reason]


def test_nulls_fall_between_clean_and_quarantine_unless_strict(spark):
    row = ("t", "a", "c", None, None, "atm", None, None, None, None, "GB", False, None, None, None, 1, 1)
    df = spark.createDataFrame([row], schemas.TXN_SOURCE).withColumn("event_ts", F.lit("2024-01-01").cast("timestamp"))
    fate = lambda **kw: q.row_fate(df, contracts.txn_clean_rules(), contracts.txn_reasons(**kw)).first().row_fate
    assert fate() == "unaccounted"
    assert fate(strict_nulls=True) == "quarantine"


values = st.one_of(st.none(), st.integers(-3, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(values, values), max_size=12))
def test_every_row_has_exactly_one_fate(spark, rows):
    df = spark.createDataFrame(rows, "x int, y int")
    good, bad = {"a": "x > 0", "b": "y IN (1, 2)"}, {"r": "x <= 0", "s": "y NOT IN (1, 2)"}
    counts = {r.row_fate: r.row_count for r in q.row_fate(df, good, bad).collect()}
    assert sum(counts.values()) == len(rows)
    clean = sum(1 for x, y in rows if x is not None and x > 0 and y in (1, 2))
    held = sum(1 for x, y in rows if (x is not None and x <= 0) or (y is not None and y not in (1, 2)))
    assert counts.get("clean", 0) == clean == q.clean(df, good).count()
    assert counts.get("quarantine", 0) == held == q.quarantine(df, bad).count()
    assert "both" not in counts


def test_routed_rows_carry_both_sides(spark):
    rows = [("t1", "a", "c", None, "REFUND", "atm", 1.0, "GBP"), ("t2", "a", "c", None, "REFUND", "atm", -1.0, "GBP")]
    names = "txn_id string, account_id string, customer_id string, counterparty_id string, txn_type string, channel string, amount double, currency string"
    df = spark.createDataFrame(rows, names).withColumn("event_ts", F.lit("2024-01-01").cast("timestamp"))
    got = {r.txn_id: (r.row_fate, r.failure_reasons) for r in bronze.txn_routed(df).collect()}
    assert got == {"t1": ("clean", ""), "t2": ("quarantine", "non_positive_amount")}


# -- audits over nothing, gates ----------------------------------------------
def empty(spark, schema):
    return spark.createDataFrame([], schema)


def test_audits_of_empty_inputs_fail_with_zero_counts(spark):
    held = spark.createDataFrame([], "failure_reasons string")
    raw = empty(spark, schemas.TXN_SOURCE)
    txn = audits.txn_audit(raw, raw, held).first()
    assert (txn.total_rows, txn.quarantine_pct, txn.currency_dist, txn.top_failure_reasons) == (0, 0.0, "{}", "[]")
    assert txn.audit_status == "FAIL"
    silver = audits.txn_silver_audit(empty(spark, schemas.TXN_SILVER), held).first()
    assert (silver.total_rows, silver.sanctioned_count, silver.total_gbp_volume) == (0, 0, 0.0)
    assert silver.audit_status == "FAIL"
    fx = audits.fx_silver_audit(empty(spark, schemas.FX_SILVER), held).first()
    assert (fx.currency_pairs, fx.avg_rate_change_pct, fx.audit_status) == (0, 0.0, "FAIL")
    staged = empty(spark, schemas.FX_STAGE)
    bronze_fx = audits.fx_audit(staged, bronze.fx_parse(staged), held).first()
    assert (bronze_fx.stale_rate_count, bronze_fx.provider_stale, bronze_fx.audit_status) == (0, False, "FAIL")
    files = spark.createDataFrame([], "source_file string")
    assert audits.mcc_audit(files, held).first().audit_status == "FAIL"
    assert audits.sanctions_audit(files, held).first().sanctions_total_rows == 0
    daily = audits.daily_risk_audit(
        empty(spark, schemas.DAILY_RISK), empty(spark, schemas.ANOMALY_FLAGS), empty(spark, schemas.FX_EXPOSURE)
    ).first()
    assert (daily.summary_days, daily.risk_band_dist, daily.audit_status) == (0, "{}", "FAIL")
    aml, capital = empty(spark, schemas.AML_REPORT), empty(spark, schemas.CAPITAL_EXPOSURE)
    log = audits.regulatory_log(aml, capital).first()
    assert (log.aml_total_rows, log.status, len(log.run_id)) == (0, "CLEAR", 16)
    audit = audits.regulatory_audit(aml, capital, empty(spark, schemas.REGULATORY_LOG)).first()
    assert (audit.run_id, audit.log_status, audit.audit_status) == ("N/A", "N/A", "FAIL")


AUDIT = "run_ts timestamp, total_rows bigint, quarantine_pct double, sanctioned_count bigint, audit_status string"


@pytest.mark.parametrize(
    "row, failing",
    [
        ((0, 0.0, 0, "PASS"), "has_rows"),
        ((10, 5.1, 0, "PASS"), "quarantine_rate"),
        ((10, 5.0, 1, "PASS"), "no_sanctioned"),
        ((10, 5.0, 0, "FAIL"), "status_pass"),
        ((10, None, 0, "PASS"), "quarantine_rate"),
    ],
)
def test_gate_stops_on_each_condition(spark, row, failing):
    log = spark.createDataFrame([row], AUDIT.split(", ", 1)[1]).withColumn("run_ts", F.current_timestamp())
    with pytest.raises(oa.AuditGateError, match=failing):
        oa.check_audit(log, require_pass=True, require_no_sanctioned=True)


def test_gate_reads_the_latest_row_only(spark):
    rows = [("2024-01-01", 0, 99.0, 5, "FAIL"), ("2024-01-02", 10, 0.0, 0, "PASS")]
    log = spark.createDataFrame(rows, AUDIT.replace("timestamp", "string"))
    oa.check_audit(log, require_pass=True, require_no_sanctioned=True)
    with pytest.raises(oa.AuditGateError, match="no audit row"):
        oa.check_audit(log.filter("false"))


def test_null_category_is_kept_in_the_distribution(spark):
    df = spark.createDataFrame([("GBP",), (None,), ("GBP",)], "currency string")
    row = oa.distribution_json(df, "currency", "d", rows="n").first()
    assert (row.d, row.n) == ('{"GBP":2,"NULL":1}', 3)


def test_top_reasons_keeps_five_in_order(spark):
    df = spark.createDataFrame([(r,) for r in "aabbbcdeff"], "failure_reasons string")
    assert [(r.failure_reasons, r["count"]) for r in oa.top_reasons(df).collect()] == [
        ("b", 3), ("a", 2), ("f", 2), ("c", 1), ("d", 1)]
    cell = oa.held_summary(df).first().top_failure_reasons
    assert cell.startswith('[{"failure_reasons":"b","count":3},{"failure_reasons":"a","count":2}')
    assert cell.count("failure_reasons") == 5
