import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import fraud
from ledgerlens.sources import tables
from ledgerlens.streaming import runs


@pytest.fixture(scope="module")
def raw(spark):
    """Separable: frauds are large."""
    i = F.col("id")
    return spark.range(2000).select(
        i.cast("string").alias("txn_id"),
        F.concat(F.lit("u"), i % 40).alias("user_id"),
        F.when(i % 20 == 0, 500.0 + i % 300).otherwise(i % 200 + 1.0).alias("amount"),
        F.when(i % 4 == 0, "Unknown").otherwise("Shell").alias("merchant"),
        (i % 24).cast("int").alias("hour"),
        (i % 20 == 0).cast("int").alias("is_fraud"),
    )


@pytest.fixture(scope="module")
def model(raw):
    data = fraud.training_set(raw, fraud.user_features(raw))
    train, _ = fraud.stratified_split(data)
    return fraud.train(train, params={"maxIter": 5})


def test_features_of_a_single_row(spark):
    one = spark.createDataFrame([("t", "u", 5.0, "Unknown")], "txn_id string, user_id string, amount double, merchant string")
    row = fraud.user_features(one).first()
    assert (row.txn_count_7d, row.std_amount_7d, row.unknown_merchant_count) == (1, None, 1)


def test_split_shares_and_stability(raw):
    train, test = fraud.stratified_split(raw)
    assert train.count() + test.count() == 2000
    for label, n in ((0, 1900), (1, 100)):
        assert abs(test.filter(F.col("is_fraud") == label).count() / n - 0.2) < 0.1
    again, _ = fraud.stratified_split(raw.repartition(7))
    assert sorted(r.txn_id for r in again.select("txn_id").collect()) == sorted(r.txn_id for r in train.select("txn_id").collect())


def test_model_separates_and_reports(raw, model):
    data = fraud.training_set(raw, fraud.user_features(raw))
    _, test = fraud.stratified_split(data)
    scored = fraud.score(model, test)
    assert fraud.auc(scored) > 0.9
    report = {r["class"]: r for r in fraud.class_report(scored).collect()}
    assert report["fraud"].recall > 0.9 and report["legit"].support + report["fraud"].support == test.count()
    assert sum(r.row_count for r in fraud.confusion(scored).collect()) == test.count()


def test_two_sample_records_rank_as_expected(spark, model):
    records = spark.createDataFrame(
        [(4800.0, 2, 15, 320.5, 4800.0, 210.3, 3), (12.5, 14, 3, 18.2, 25.0, 4.1, 0)], list(fraud.FEATURES)
    )
    high, low = (r.fraud_probability for r in fraud.score(model, records).orderBy(F.desc("amount")).collect())
    assert high > low


def test_roc_ends_at_one(raw):
    scored = raw.withColumn("fraud_probability", F.col("amount") / 1000)
    last = fraud.roc_points(scored, bins=10).orderBy("threshold").first()
    assert (last.fpr, last.tpr) == (1.0, 1.0)


def test_latest_model(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 2)], "path string, created_ts int")
    assert fraud.latest_model(df).first().path == "b"


def test_whole_flow(spark, raw, tmp_path):
    root = str(tmp_path / "fraud")
    for n in (1, 2):
        scored = fraud.run_fraud(spark, root, raw, {"maxIter": 3 * n})
        metrics = spark.read.parquet(f"{root}/model_metrics")
        assert metrics.count() == n and metrics.filter("train_auc > 0.9 and test_auc > 0.9").count() == n
    champion = fraud.latest_model(metrics).first()
    assert champion["created_ts"] == max(r["created_ts"] for r in metrics.collect())
    assert scored.filter("fraud_probability between 0 and 1").count() == scored.count() > 0


def test_report_averages(spark):
    df = spark.createDataFrame([(0, 0.0), (0, 0.0), (0, 1.0), (1, 1.0), (2, 1.0)], "is_fraud int, prediction double")
    got = {r["average"]: r for r in fraud.report_averages(df).collect()}
    assert got["macro"].accuracy == got["weighted"].accuracy == 0.6 and got["macro"].support == 5
    assert got["macro"].recall == round((2 / 3 + 1 + 0) / 3, 4) and got["weighted"].recall == 0.6
    assert got["macro"].precision == round((1 + 1 / 3) / 3, 4) and got["weighted"].precision == round((3 + 1 / 3) / 5, 4)


def test_exact_split(spark, monkeypatch):
    """Every label's test side has round(0.2 n) rows, the same in any order and however many rounds the selection takes."""
    rows = [(str(i), i % 7 == 0 if i % 13 else None) for i in range(3000)] + [("lone", False)]
    rows = [(i, None if b is None else int(b)) for i, b in rows]
    df = spark.createDataFrame(rows, "txn_id string, is_fraud int")
    sides = []
    for step in (12, 4):
        monkeypatch.setattr(fraud, "SPLIT_STEP", step)
        train, test = fraud.exact_split(df.repartition(step))
        got = {r["txn_id"] for r in test.collect()}
        assert got.isdisjoint(r["txn_id"] for r in train.collect()) and train.count() + test.count() == len(rows)
        sides.append(got)
    assert sides[0] == sides[1]
    for label in (0, 1, None):
        mine = {i for i, b in rows if b == label}
        assert len(mine & sides[0]) == int(0.2 * len(mine) + 0.5)
    train, test = fraud.exact_split(df.limit(0))
    assert train.count() == test.count() == 0
    train, test = fraud.exact_split(df.limit(2))
    assert train.count() == 2 and test.count() == 0


def test_roc_curve_joins_ties_and_leaves_out_missing_scores(spark):
    rows = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.1), (1, 0.1), (0, 0.0), (0, -0.0), (1, None), (None, 0.7)]
    got = [tuple(r) for r in fraud.roc_curve(spark.createDataFrame(rows, "is_fraud int, fraud_probability double")).orderBy(F.desc("threshold")).collect()]
    assert got == [(0.9, 1, 1, 1 / 3, 0.25), (0.5, 2, 1, 2 / 3, 0.25), (0.1, 3, 2, 1.0, 0.5), (0.0, 3, 4, 1.0, 1.0)]
    one = fraud.roc_curve(spark.createDataFrame([(1, 0.5)], "is_fraud int, fraud_probability double")).collect()
    assert [tuple(r) for r in one] == [(0.5, 1, 0, 1.0, None)]
    plan = fraud.roc_curve(spark.createDataFrame(rows, "is_fraud int, fraud_probability double"))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_scores_of_a_repeated_batch_replace_themselves(spark, tmp_path):
    """The two sample records come out in order, and a batch that is run again adds nothing."""
    names = ["amount", "hour", "txn_count_7d", "avg_amount_7d", "max_amount_7d", "std_amount_7d", "unknown_merchant_count"]
    schema = "txn_id string, " + ", ".join(f"{n} double" for n in names) + ", is_fraud int"
    usual = [(f"u{i}", 40.0 + i % 9, 12.0, 10.0, 45.0, 60.0, 5.0, 0.0, 0) for i in range(40)]
    odd = [(f"o{i}", 900.0 + i, 3.0, 2.0, 700.0, 950.0, 90.0, 4.0, 1) for i in range(20)]
    root = str(tmp_path)
    fraud.train(spark.createDataFrame(usual + odd, schema), params={"maxIter": 2}).write().save(f"{root}/m")
    tables.append(spark.sql(f"SELECT 'r' AS run, '{root}/m' AS path, current_timestamp() AS created_ts"), f"{root}/model_metrics")
    sample = spark.createDataFrame([("low", 45.0, 14.0, 8.0, 44.0, 58.0, 6.0, 0.0, 0), ("high", 950.0, 2.0, 1.0, 800.0, 950.0, 80.0, 5.0, 1)], schema)
    tables.append(sample, f"{root}/rows")
    for checkpoint in ("a", "b"):  # the second run has lost its checkpoint and repeats batch 0
        out = fraud.score_stream(spark, root, tables.stream_table(spark, f"{root}/rows", sample.schema), f"{root}/scores", f"{root}/{checkpoint}")
        p = {r["txn_id"]: r["fraud_probability"] for r in out.collect()}
        assert out.count() == 2 and p["low"] < 0.5 < p["high"]


def test_training_bounds_the_rows_of_a_task(raw, monkeypatch):
    """One large partition is spread before trees are grown from it; small ones stay as they are."""
    data, fitted = fraud.training_set(raw, fraud.user_features(raw)).coalesce(1), []
    monkeypatch.setattr(fraud.Pipeline, "fit", lambda self, df: fitted.append(df))
    fraud.train(data)
    monkeypatch.setattr(fraud, "TRAIN_ROWS", 150)
    fraud.train(data)
    fraud.train(data.limit(0))
    sizes = [[r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()] for df in fitted]
    assert sizes[0] == [2000] and sum(sizes[1]) == 2000 and max(sizes[1]) <= 150 and sizes[2] == []
    assert sorted(fitted[1].collect()) == sorted(data.collect())


def test_landed_files_fill_the_batches_evenly(spark, tmp_path):
    """More rows make more files a batch, not larger ones nor more batches."""
    for n, files, per_batch in ((0, 1, 1), (100, 4, 1), (1000, 20, 5)):
        path = f"{tmp_path}/{n}"
        assert tables.land(spark.range(n), path, batches=4, rows=50) == per_batch
        stored = tables.read_table(spark, path)
        assert len(stored.inputFiles()) == files and sorted(r.id for r in stored.collect()) == list(range(n))
        batches = []
        source = tables.stream_table(spark, path, stored.schema, per_batch)
        runs.drain(source.writeStream.foreachBatch(lambda df, i: batches.append(df.count())).option("checkpointLocation", f"{path}_checkpoint"))
        assert sum(batches) == n and len(batches) <= 4 and max(batches, default=0) <= 50 * per_batch + 50
