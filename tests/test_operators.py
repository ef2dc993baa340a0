import json
import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import columns as fc
from ledgerlens.functions import domain
from ledgerlens.operators import audit, lookups, relational, windows
from ledgerlens.plans import bronze, silver
from ledgerlens.sources import tables


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# -- lookups ------------------------------------------------------------------
@pytest.fixture
def facts(spark):
    """A third of the rows share one key, a third have none."""
    return spark.range(300).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id"))).alias("key")
    )


@pytest.fixture
def listed(spark):
    return spark.createDataFrame([("hot", 1), ("k4", 2), ("k7", 3), ("other", 4)], "key string, v int")


def test_lookup_broadcasts_a_small_side(facts, listed):
    assert "BroadcastHashJoin" in plan(lookups.lookup_join(facts, listed, ["key"]))


def test_lookup_beyond_the_limit_is_salted_and_gives_the_same(spark, facts, listed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    salted = lookups.lookup_join(facts, listed, ["key"], max_rows=3)
    assert "SortMergeJoin" in plan(salted) and "_salt" in plan(salted)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    small = lookups.lookup_join(facts, listed, ["key"])
    assert salted.columns == small.columns
    assert salted.orderBy("id").collect() == small.orderBy("id").collect()
    assert salted.count() == 300


def test_only_heavy_keys_are_split(spark, facts, listed):
    """By their number of rows: the reference rows of light keys go once."""
    heavy = {r["key"]: r["_splits"] for r in lookups.heavy_keys(facts, ["key"], 30).collect()}
    assert heavy == {"hot": 4}
    joined = lookups.split_left_join(facts, listed, ["key"], 30)
    small = lookups.lookup_join(facts, listed, ["key"])
    assert joined.columns == small.columns and joined.orderBy("id").collect() == small.orderBy("id").collect()
    copies = listed.join(lookups.heavy_keys(facts, ["key"], 30), "key", "left").selectExpr("sum(coalesce(_splits, 1)) AS n").first()["n"]
    assert copies == listed.count() + 3
    two = [facts.withColumn("day", F.col("id") % 2), listed.withColumn("day", F.lit(0))]
    assert lookups.split_left_join(*two, ["key", "day"], 30).filter("v IS NOT NULL").count() == 51


def test_bounded_cells_add_up(spark):
    """One entry per frequent value and one for all others, however many values there are and however long they are."""
    rows = [(None,)] * 7 + [("a",)] * 5 + [("x" * 5000 + str(i),) for i in range(50)] + [(f"v{i}",) for i in range(400)]
    df = spark.createDataFrame(rows, "c string")
    got = audit.distribution_json(df, "c", "cell", rows="n", entries=3).first()
    cell = json.loads(got["cell"])
    assert cell == {"NULL": 7, "x" * 100: 50, "a": 5, "(others)": 400} and got["n"] == sum(cell.values()) == len(rows)
    empty = audit.distribution_json(df.limit(0), "c", "cell", rows="n").first()
    assert (empty["cell"], empty["n"]) == ("{}", 0)


def test_sketches_merge(spark):
    days = spark.range(60_000).groupBy((F.col("id") % 7).alias("d")).agg(fc.distinct_sketch(F.col("id") % 20_000).alias("s"))
    about = days.agg(fc.distinct_of("s").alias("n")).first()["n"]
    once = spark.range(60_000).agg(fc.distinct_sketch(F.col("id") % 20_000).alias("s")).agg(fc.distinct_of("s").alias("n")).first()["n"]
    assert abs(about - 20_000) <= 0.03 * 20_000 and abs(about - once) <= 0.03 * once
    assert days.limit(0).agg(fc.distinct_of("s").alias("n")).first()["n"] == 0


def test_rows_without_a_key_spread_beyond_the_salts(facts):
    salted = lookups.spread_keys(facts, ["key"], 4)
    used = {r["key"]: r["n"] for r in salted.groupBy("key").agg(F.count_distinct("_salt").alias("n")).collect()}
    assert used[None] > 90 and used["hot"] == 4


def test_lookup_measures_bytes_too(listed):
    assert lookups.measure(listed, listed.limit(1)) == [(4, 16), (1, 4)]
    assert lookups.fits_broadcast(listed, listed.limit(1)) == [True, True]
    assert lookups.fits_broadcast(listed, listed.limit(1), max_bytes=5) == [False, True]


def test_salt_spreads_a_hot_key(facts):
    salts = lookups.spread(facts.filter("key = 'hot'"), 8).groupBy("_salt").count().collect()
    assert len(salts) == 8 and max(r["count"] for r in salts) < 40


# -- windows ------------------------------------------------------------------
def brute_rolling(rows, days):
    """(key, ts, x) rows -> rolling totals, by definition."""
    sec = lambda t: int(t.timestamp() // 1)
    out = []
    for k, t, _ in rows:
        inside = [x for k2, t2, x in rows if k2 == k and x is not None and 0 <= sec(t) - sec(t2) <= days * 86400]
        out.append(sum(inside) if inside else None)
    return out


def test_rolling_sum_edges(spark):
    base = datetime(2024, 1, 10, 12)
    rows = [
        ("a", base, 1),
        ("a", base + timedelta(seconds=259200), 10),
        ("a", base + timedelta(seconds=259201), 100),
        ("b", base, 1),
        ("b", base + timedelta(milliseconds=300), 2),
        ("c", base, None),
    ]
    df = spark.createDataFrame(rows, "k string, ts timestamp, x int")
    got = {(r.k, r.x): r.s for r in windows.rolling_sum(df, "k", "ts", "x", 3, "s").collect()}
    assert got == {("a", 1): 1, ("a", 10): 11, ("a", 100): 110, ("b", 1): 3, ("b", 2): 3, ("c", None): None}


def test_rolling_sum_equals_brute_force_with_a_hot_key(spark):
    rng = random.Random(3)
    start = datetime(2023, 12, 28)
    rows = [
        (rng.choice(["hot", "hot", "b", None]), start + timedelta(seconds=rng.randrange(20 * 86400)), rng.choice([None, 1, 2, 3]))
        for _ in range(400)
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, k string, ts timestamp, x int")
    got = [r.s for r in windows.rolling_sum(df, "k", "ts", "x", 3, "s").orderBy("i").collect()]
    assert got == brute_rolling(rows, 3)


def test_rolling_sum_of_doubles_cancels_exactly(spark):
    start = datetime(2024, 1, 1)
    rows = [("a", start + timedelta(hours=7 * i), 0.1 * (i % 7) + 8999.9 * (i == 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "k string, ts timestamp, x double")
    want = {t: round(sum(x for _, t2, x in rows if timedelta(0) <= t - t2 <= timedelta(days=3)), 6) for _, t, _ in rows}
    assert {r.ts: r.s for r in windows.rolling_sum(df, "k", "ts", "x", 3, "s").collect()} == want


def test_rolling_window_is_cut_by_time(spark):
    df = spark.range(20000).select(
        (F.col("id") % 1).cast("string").alias("k"), F.timestamp_seconds(F.col("id") * 700 + 1_700_000_000).alias("ts"), F.lit(1).alias("x")
    )
    totals = windows.rolling_totals(df, "k", "ts", "x", 1)
    assert totals.count() == 20000
    assert re.search(r"Exchange hashpartitioning\(k#\d+, chunk#\d+", plan(totals))


def rates(spark, rows):
    df = spark.createDataFrame(rows, "quote_currency string, fetch_ts string, rate double")
    return df.withColumn("fetch_ts", F.col("fetch_ts").cast("timestamp")).withColumns(
        {"rate_date": F.to_date("fetch_ts"), "rate_id": F.concat("quote_currency", F.col("fetch_ts").cast("string"))}
    )


def test_rate_change_across_days_and_gaps(spark):
    df = rates(spark, [
        ("USD", "2024-01-01 10:00:00", 100.0),
        ("USD", "2024-01-01 12:00:00", 101.0),
        ("USD", "2024-01-04 09:00:00", 101.0),
        ("USD", "2024-01-05 09:00:00", 103.0),
        ("EUR", "2024-01-05 09:00:00", 7.0),
    ])
    got = {
        (r.quote_currency, str(r.fetch_ts)): (r.prev_rate, r.rate_change_pct, r.significant_move)
        for r in windows.rate_change(df).collect()
    }
    assert got[("USD", "2024-01-01 10:00:00")] == (None, None, False)
    assert got[("USD", "2024-01-01 12:00:00")] == (100.0, 1.0, False)  # exactly 1 % is not a move
    assert got[("USD", "2024-01-04 09:00:00")] == (101.0, 0.0, False)
    assert got[("USD", "2024-01-05 09:00:00")] == (101.0, 1.980198, True)
    assert got[("EUR", "2024-01-05 09:00:00")] == (None, None, False)


def test_zero_previous_rate_gives_no_change(spark):
    df = rates(spark, [("USD", "2024-01-01 10:00:00", 0.0), ("USD", "2024-01-01 12:00:00", 5.0)])
    row = windows.rate_change(df).filter("rate = 5.0").first()
    assert (row.prev_rate, row.rate_change_pct, row.significant_move) == (0.0, None, False)


def test_rate_without_fetch_time_counts_as_previous_and_is_dropped(spark):
    df = rates(spark, [("USD", None, 90.0), ("USD", "2024-01-01 12:00:00", 99.0)])
    df = df.withColumns({
        "rate_id": F.coalesce("rate_id", F.lit("x")), "base_currency": F.lit("GBP"), "source_ts": F.col("fetch_ts"),
        "rate_age_minutes": F.lit(0.0), "provider": F.lit("p"), "is_stale": F.lit(False)})
    rows = silver.fx_silver(df).collect()
    assert [(r.prev_rate, r.rate_change_pct) for r in rows] == [(90.0, 10.0)]


# -- keys ---------------------------------------------------------------------
def test_upsert_replaces_and_adds(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    b = spark.createDataFrame([("c", 2), ("d", 3)], "v string, k int")
    assert sorted(map(tuple, relational.upsert(a, b, ["k"]).collect())) == [(1, "a"), (2, "c"), (3, "d")]


def test_merge_into_writes_a_new_version(spark, tmp_path):
    path = str(tmp_path / "features")
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    tables.merge_into(spark, path, a, ["k"])
    out = tables.merge_into(spark, path, spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"])
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, tables.merge_into(spark, path, a, ["k"]).collect())) == [(1, "a"), (2, "b"), (3, "d")]
    assert tables.latest_version(spark, path)[0] == 2


def test_key_check_finds_duplicates_and_nulls(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert {(r.k, r.row_count) for r in relational.check_key(df, ["k"]).collect()} == {(1, 2), (None, 1)}


def test_newest_mcc_row_wins(spark):
    rows = [("1000", "LOW", "old.csv", "2024-01-01"), ("1000", "HIGH", "new.csv", "2024-02-01"), (None, "LOW", "new.csv", "2024-02-01")]
    df = spark.createDataFrame(rows, "mcc_code string, risk_level string, source_file string, source_file_modified_ts string")
    assert [tuple(r) for r in silver.mcc_levels(df).collect()] == [("1000", "HIGH")]


def test_latest_of_an_empty_frame_is_empty(spark):
    df = spark.createDataFrame([], "a int, run_ts timestamp")
    assert relational.latest(df, "run_ts").collect() == []


# -- columns ------------------------------------------------------------------
def test_parse_rfc1123_and_staleness(spark):
    rows = [
        ("a", "Fri, 27 Mar 2020 00:00:01 +0000", "2020-03-27 00:30:01"),
        ("b", "Fri, 27 Mar 2020 00:00:01 +0000", "2020-03-27 00:30:02"),
        ("c", "yesterday", "2020-03-27 00:30:02"),
        ("d", None, "2020-03-27 00:30:02"),
    ]
    df = spark.createDataFrame(rows, "rate_id string, source_ts string, fetch_ts string")
    df = df.withColumns({"rate": F.lit(1.0), "fetch_ts": F.col("fetch_ts").cast("timestamp")})
    got = {r.rate_id: (r.rate_age_minutes, r.is_stale) for r in bronze.fx_parse(df).collect()}
    assert got["a"] == (30.0, False)
    assert got["b"][1] is True
    assert got["c"] == got["d"] == (None, None)


def test_conversion(spark):
    rows = [("GBP", 10.0, None), ("USD", 10.0, 1.25), ("USD", 10.0, None), ("XXX", 10.0, 1.25)]
    df = spark.createDataFrame(rows, "currency string, amount double, GBP_USD double")
    for c in ("EUR", "AED", "NGN", "CNY", "CHF", "JPY", "SGD"):
        df = df.withColumn(f"GBP_{c}", F.lit(2.0))
    assert [r[0] for r in df.select(domain.to_base("amount", "currency")).collect()] == [10.0, 12.5, None, None]
    assert [r[0] for r in df.select(domain.to_base("amount", "currency", invert=True)).collect()] == [10.0, 8.0, None, None]


def test_band_cuts_and_score_bounds(spark):
    df = spark.createDataFrame([(19,), (20,), (49,), (50,), (99,), (100,)], "s int")
    assert [r[0] for r in df.select(domain.band("s")).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]
    names = "sanctioned_count int, high_risk_txn_count int, cross_border_count int, late_night_count int, refund_rate_pct double, max_single_txn_gbp double, total_txn_count int"
    at = spark.createDataFrame([(0, 10, 30, 5, 5.0, 10000.0, 100), (1, 11, 31, 6, 5.1, 10000.1, 100)], names)
    assert [r[0] for r in at.select(domain.risk_score()).collect()] == [0, 185]


def test_due_diligence_arms(spark):
    rows = [
        (1, False, False, True, 6000.0, 12),   # large cross-border by day
        (2, False, False, True, 900.0, 3),     # small at night
        (3, False, False, False, 1500.0, 5),   # sizeable at night, domestic
        (4, False, False, False, 1500.0, 6),
        (5, True, False, False, None, 12),
        (6, False, True, False, 1.0, 12),
    ]
    df = spark.createDataFrame(rows, "id int, counterparty_sanctioned boolean, is_high_risk_merchant boolean, is_cross_border boolean, gbp_amount double, txn_hour int")
    assert [r.id for r in silver.high_risk(df).orderBy("id").collect()] == [1, 3, 5, 6]


def test_unknown_amount_leaves_the_sar_flag_open_and_the_status_clear(spark):
    df = spark.createDataFrame([(None, False, None), (None, True, None)], "t boolean, s boolean, g boolean")
    got = df.select(domain.sar_candidate("t", "s", "g").alias("sar"), domain.regulatory_status("t", "s", "g").alias("st")).collect()
    assert [tuple(r) for r in got] == [(None, "CLEAR"), (True, "REPORT")]


def test_capital_bands(spark):
    df = spark.createDataFrame([(7.4999, 0), (7.5, 0), (9.9999, 0), (10.0, 0), (0.0, 1)], "exposure_pct_of_capital double, sanctions_exposure_count int")
    assert [r[0] for r in df.select(domain.capital_band()).collect()] == ["ADEQUATE", "WATCH", "WATCH", "BREACH", "BREACH"]


def test_zero_defaults_on_empty_input(spark):
    df = spark.createDataFrame([], "x double, b boolean")
    row = df.agg(fc.sum0("x").alias("s"), fc.avg0("x").alias("a"), fc.max0("x").alias("m"), fc.count_where("b").alias("c")).first()
    assert tuple(row) == (0.0, 0.0, 0.0, 0)


def test_weight_of_an_unlisted_type_does_not_count(spark):
    df = spark.createDataFrame([("A", 10.0), ("B", 5.0)], "t string, x double")
    assert df.agg(fc.weighted_sum("x", "t", {"A": "0.75"})).first()[0] == 7.5


def test_lag_carries_a_null_key_over_days(spark):
    rows = [(None, "2024-01-01", 1, 1.0), (None, "2024-01-02", 2, 2.0), ("USD", "2024-01-02", 3, 5.0)]
    df = spark.createDataFrame(rows, "quote_currency string, rate_date string, fetch_ts int, rate double").withColumn("rate_id", F.lit("r"))
    got = {r["fetch_ts"]: (r["prev_rate"], r["rate_change_pct"]) for r in windows.rate_change(df).collect()}
    assert got == {1: (None, None), 2: (1.0, 100.0), 3: (None, None)}


def test_rolling_sum_keeps_small_amounts_and_nan(spark):
    rows = [("a", 0, 1e-7), ("a", 1, 4e-7), ("b", 0, float("nan")), ("b", 1, 1.0), ("b", 86_400 * 3 + 2, 2.0)]
    df = spark.createDataFrame(rows, "k string, s long, v double").withColumn("t", F.timestamp_seconds("s"))
    got = {(r["k"], r["s"]): r["rolling_sum"] for r in windows.rolling_sum(df, "k", "t", "v", 3, scale=9).collect()}
    assert got[("a", 1)] == 5e-7 and got[("b", 0)] != got[("b", 0)] and got[("b", 1)] != got[("b", 1)]
    assert got[("b", 86_400 * 3 + 2)] == 2.0


def test_merge_refuses_repeated_and_null_keys(spark, tmp_path):
    from ledgerlens.sources import tables

    path = str(tmp_path / "t")
    tables.merge_into(spark, path, spark.createDataFrame([(1, "a")], "k int, v string"), ["k"])
    for bad in ([(2, "b"), (2, "c")], [(None, "b")]):
        with pytest.raises(ValueError):
            tables.merge_into(spark, path, spark.createDataFrame(bad, "k int, v string"), ["k"])


def test_class_report_has_every_class(spark):
    from ledgerlens.plans import fraud

    rows = [(0, 0.0), (2, 2.0), (2, 0.0)]
    got = {r["class"]: (r["recall"], r["support"]) for r in fraud.class_report(spark.createDataFrame(rows, "is_fraud int, prediction double")).collect()}
    assert got == {"legit": (1.0, 1), "fraud": (0.0, 0), "2": (0.5, 2)}


def test_refused_writer_leaves_the_other_ones_rows(spark, tmp_path, monkeypatch):
    """A writer that is overtaken between reading the version and publishing its own raises, and readers see the other's rows."""
    path, schema = str(tmp_path / "raced"), "k int, v string"
    tables.merge_into(spark, path, spark.createDataFrame([(1, "a")], schema), ["k"])
    real = tables._publish

    def overtaken(spark_, folder, number, target):
        monkeypatch.setattr(tables, "_publish", real)
        tables.merge_into(spark, path, spark.createDataFrame([(2, "other")], schema), ["k"])
        return real(spark_, folder, number, target)

    monkeypatch.setattr(tables, "_publish", overtaken)
    with pytest.raises(RuntimeError, match="another writer"):
        tables.merge_into(spark, path, spark.createDataFrame([(3, "refused")], schema), ["k"])
    number, folder = tables.latest_version(spark, path)
    assert number == 1 and sorted(map(tuple, spark.read.parquet(folder).collect())) == [(1, "a"), (2, "other")]
    merged = tables.merge_into(spark, path, spark.createDataFrame([(3, "again")], schema), ["k"])
    assert sorted(map(tuple, merged.collect())) == [(1, "a"), (2, "other"), (3, "again")]


def test_prefix_sums_equal_a_loop(spark):
    rows = [(i * 7 % 501, (i % 5) if i % 11 else None) for i in range(501)]
    for descending in (False, True):
        got = windows.prefix_sums(spark.createDataFrame(rows, "k int, n bigint").repartition(9), "k", ["n"], descending)
        total, want = 0, []
        for k, n in sorted(rows, reverse=descending):
            total += n or 0
            want.append((k, total))
        assert sorted((r["k"], r["n_so_far"]) for r in got.collect()) == sorted(want) and {r["n_all"] for r in got.collect()} == {total}
    assert windows.prefix_sums(spark.createDataFrame([], "k int, n bigint"), "k", ["n"]).count() == 0
