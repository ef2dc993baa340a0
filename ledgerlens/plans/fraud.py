"""User features, training set, gradient-boosted fraud model, evaluation and scoring, all on executors."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions.columns import count_where, query_time, stddev
from ledgerlens.operators.lookups import lookup_join
from ledgerlens.operators.relational import bound_partitions, latest
from ledgerlens.operators.windows import prefix_sums
from ledgerlens.sources.tables import append, hand_over, merge_into, read_table
from ledgerlens.streaming.runs import drain

AsOf = Column | datetime | None

# Feature order and training parameters (fixed values).
FEATURES = (
    "amount",
    "hour",
    "txn_count_7d",
    "avg_amount_7d",
    "max_amount_7d",
    "std_amount_7d",
    "unknown_merchant_count",
)
TRAINING = {"maxIter": 100, "maxDepth": 4, "stepSize": 0.1, "seed": 42}
TEST_SHARE = 0.2
#: Rows of a partition that trees are grown from; Spark ML caches some 250 bytes of each.
TRAIN_ROWS = 400_000


# -- features -----------------------------------------------------------------
def user_features(
    txns: DataFrame, window_days: int | None = None, ts: str = "ts", as_of: AsOf = None, unknown: str = "Unknown"
) -> DataFrame:
    """Per user: count, mean, maximum, sample deviation of the amount, and unknown-merchant count.

    Despite the ``_7d`` names the defined features cover all rows; ``window_days=7`` restricts
    them to the days before ``as_of``.
    """
    if window_days is not None:
        age = query_time(as_of) - F.col(ts).cast("timestamp")
        txns = txns.filter((age >= F.expr("INTERVAL 0 DAYS")) & (age <= F.make_dt_interval(F.lit(window_days))))
    return txns.groupBy("user_id").agg(
        F.count("txn_id").alias("txn_count_7d"),
        F.avg("amount").alias("avg_amount_7d"),
        F.max("amount").alias("max_amount_7d"),
        stddev("amount").alias("std_amount_7d"),
        count_where(F.col("merchant") == unknown).alias("unknown_merchant_count"),
    )


def training_set(raw: DataFrame, features: DataFrame, label: str = "is_fraud", **limits) -> DataFrame:
    """Each transaction with its user's features (a single-row deviation counts as 0) and its label."""
    joined = lookup_join(raw, features, ["user_id"], **limits)
    filled = joined.withColumn("std_amount_7d", F.coalesce("std_amount_7d", F.lit(0.0)))
    return filled.select("txn_id", *FEATURES, label)


def stratified_split(
    df: DataFrame, label: str = "is_fraud", test_share: float = TEST_SHARE, seed: int = 42, row_id: str = "txn_id"
) -> tuple[DataFrame, DataFrame]:
    """(train, test): each row's side follows from a hash of its label, id and the seed.

    No shuffle, the same split on every run and retry; the share holds within each label up to
    sampling error.
    """
    seen = F.concat_ws("|", F.col(label).cast("string"), F.col(row_id).cast("string"), F.lit(str(seed)))
    slot = F.conv(F.substring(F.md5(seen), 1, 8), 16, 10).cast("bigint") % 1000
    marked = df.withColumn("_slot", slot)
    cut = int(round((1 - test_share) * 1000))
    return marked.filter(F.col("_slot") < cut).drop("_slot"), marked.filter(F.col("_slot") >= cut).drop("_slot")


#: Hashes of the exact split have so many bits; a round of the selection decides ``SPLIT_STEP`` of them.
SPLIT_BITS, SPLIT_STEP = 60, 12


def exact_split(
    df: DataFrame, label: str = "is_fraud", test_share: float = TEST_SHARE, seed: int = 42, row_id: str = "txn_id"
) -> tuple[DataFrame, DataFrame]:
    """(train, test): of each label's ``n`` rows exactly ``round(test_share * n)`` (half up) are tested, those with the smallest hashes.

    The hash at that rank is found by refining histograms: each round counts, per label, the rows in the
    4,096 parts of the part that holds the rank, until that part is small enough to be sorted.  Rows stay where they are; the
    driver sees bounded counts and one boundary per label.  Equal hashes go by ``row_id``; repeated ids are on one side, so
    that the share is exact where ids are unique.  NULL labels are a class; NULL ids come first.
    """
    text = F.concat_ws("|", F.coalesce(F.col(label).cast("string"), F.lit("")), F.coalesce(F.col(row_id).cast("string"), F.lit("")), F.lit(str(seed)))
    marked = df.withColumns({"_class": F.col(label).cast("string"), "_h": F.conv(F.substring(F.md5(text), 1, SPLIT_BITS // 4), 16, 10).cast("bigint")})
    sizes = {r["_class"]: r["n"] for r in marked.groupBy("_class").agg(F.count("*").alias("n")).collect()}
    # Per label: the prefix that holds the rank, and how many rows of it belong to the test side.
    at = {c: (0, int(test_share * n + 0.5)) for c, n in sizes.items()}
    ends: dict[str | None, tuple[int, str | None]] = {c: (-1, None) for c, (_, k) in at.items() if k == 0}
    at = {c: v for c, v in at.items() if c not in ends}

    def inside(bits: int) -> Column:
        same = [F.col("_class").eqNullSafe(F.lit(c)) & (F.shiftright("_h", SPLIT_BITS - bits) == prefix) for c, (prefix, _) in at.items()]
        return reduce(Column.__or__, same, F.lit(False))

    bits = 0
    while at and bits < SPLIT_BITS:
        part = F.shiftright("_h", SPLIT_BITS - bits - SPLIT_STEP)
        counts = marked.filter(inside(bits)).groupBy("_class", part.alias("part")).agg(F.count("*").alias("n")).collect()
        bits, largest = bits + SPLIT_STEP, 0
        for c, (_, rank) in list(at.items()):
            for r in sorted((r for r in counts if r["_class"] == c), key=lambda r: r["part"]):
                if rank <= r["n"]:
                    at[c], largest = (r["part"], rank), max(largest, r["n"])
                    break
                rank -= r["n"]
        if largest <= 1 << SPLIT_STEP:
            break
    w = Window.partitionBy("_class").orderBy("_h", F.col(row_id).cast("string"))
    near = marked.filter(inside(bits)).select("_class", "_h", F.col(row_id).cast("string").alias("_id"), F.row_number().over(w).alias("_rank")) if at else None
    wanted = reduce(Column.__or__, [F.col("_class").eqNullSafe(F.lit(c)) & (F.col("_rank") == k) for c, (_, k) in at.items()], F.lit(False))
    ends |= {r["_class"]: (r["_h"], r["_id"]) for r in near.filter(wanted).collect()} if at else {}

    def up_to(h: int, last: str | None) -> Column:
        rid = F.col(row_id).cast("string")
        tie = rid.isNull() if last is None else rid.isNull() | (rid <= last)
        return (F.col("_h") < h) | ((F.col("_h") == h) & tie)

    test = reduce(Column.__or__, [F.col("_class").eqNullSafe(F.lit(c)) & up_to(h, last) for c, (h, last) in ends.items()], F.lit(False))
    return marked.filter(~test).drop("_class", "_h"), marked.filter(test).drop("_class", "_h")


# -- model --------------------------------------------------------------------
def train(
    df: DataFrame, label: str = "is_fraud", features: Sequence[str] = FEATURES, params: Mapping | None = None
) -> PipelineModel:
    """Gradient-boosted trees over the feature columns; trees are grown from distributed histograms.

    ``df`` should be stored.  A task reads the cached rows of its partition again for every level of a tree, so partitions of more
    than ``TRAIN_ROWS`` rows are spread.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(labelCol=label, featuresCol="features", **{**TRAINING, **(params or {})})
    return Pipeline(stages=[assembler, gbt]).fit(bound_partitions(df, TRAIN_ROWS))


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``fraud_probability`` and ``prediction`` to a batch or stream of feature rows."""
    scored = model.transform(df)
    return scored.withColumn("fraud_probability", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability"
    )


# -- evaluation ---------------------------------------------------------------
def auc(scored: DataFrame, label: str = "is_fraud", probability: str = "fraud_probability") -> float:
    """Area under the ROC curve, 4 digits."""
    evaluator = BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol=probability, metricName="areaUnderROC", numBins=0
    )
    return round(evaluator.evaluate(scored), 4)


def confusion(scored: DataFrame, label: str = "is_fraud", prediction: str = "prediction") -> DataFrame:
    """Row count per actual and predicted class."""
    pair = scored.select(F.col(label).cast("int").alias("actual"), F.col(prediction).cast("int").alias("predicted"))
    return pair.groupBy("actual", "predicted").agg(F.count("*").alias("row_count"))


def _class_rows(scored: DataFrame, label: str, prediction: str, names: Mapping[int, str] | None) -> DataFrame:
    """Per class: precision, recall and F1 in full, support and hits."""
    names = {0: "legit", 1: "fraud"} if names is None else names
    cells = confusion(scored, label, prediction)
    n, none = F.col("row_count"), F.lit(0).cast("bigint")
    hits = F.when(F.col("actual") == F.col("predicted"), n).otherwise(none)
    parts = cells.select(
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("c"), hits.alias("hit"), none.alias("claimed"), n.alias("support")),
                F.struct(F.col("predicted").alias("c"), none.alias("hit"), n.alias("claimed"), none.alias("support")),
            )
        )
    )
    # Classes come from the rows; those with a name are reported even without any.
    known = cells.sparkSession.createDataFrame([(c, name) for c, name in names.items()], "c int, class string")
    sums = parts.filter("c IS NOT NULL").groupBy("c").agg(*(F.sum(x).alias(x) for x in ("hit", "claimed", "support")))
    rows = sums.join(F.broadcast(known), "c", "full_outer").select(
        F.coalesce("class", F.col("c").cast("string")).alias("class"),
        *(F.coalesce(x, none).alias(x) for x in ("hit", "claimed", "support")),
    )
    hit, claimed, support = F.col("hit"), F.col("claimed"), F.col("support")
    return rows.select(
        "class",
        _ratio(hit, claimed).alias("precision"),
        _ratio(hit, support).alias("recall"),
        _ratio(2 * hit, claimed + support).alias("f1"),
        "support",
        "hit",
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(top / F.nullif(bottom, F.lit(0)), F.lit(0.0))


def class_report(
    scored: DataFrame,
    label: str = "is_fraud",
    prediction: str = "prediction",
    names: Mapping[int, str] | None = None,
) -> DataFrame:
    """Precision, recall, F1 and support per class.  Ratios without a denominator are 0."""
    rows = _class_rows(scored, label, prediction, names)
    return rows.select("class", *(F.round(x, 4).alias(x) for x in ("precision", "recall", "f1")), "support")


def report_averages(
    scored: DataFrame,
    label: str = "is_fraud",
    prediction: str = "prediction",
    names: Mapping[int, str] | None = None,
) -> DataFrame:
    """The report's ``macro`` row (every class alike) and ``weighted`` row (by support), each with the accuracy."""
    rows = _class_rows(scored, label, prediction, names)
    metrics, total = ("precision", "recall", "f1"), F.sum("support")
    macro = F.struct(F.lit("macro").alias("average"), *(F.round(F.avg(x), 4).alias(x) for x in metrics))
    weighted = F.struct(
        F.lit("weighted").alias("average"), *(F.round(_ratio(F.sum(F.col(x) * F.col("support")), total), 4).alias(x) for x in metrics)
    )
    both = F.array(macro, weighted)
    sums = rows.agg(both.alias("rows"), F.round(_ratio(F.sum("hit"), total), 4).alias("accuracy"), total.alias("support"))
    return sums.select(F.inline("rows"), "accuracy", "support")


def roc_points(
    scored: DataFrame, label: str = "is_fraud", probability: str = "fraud_probability", bins: int = 100
) -> DataFrame:
    """Points of the ROC curve, one per occupied score bin, from the highest score down.

    The rows are counted per bin first; the running totals go over the ``bins`` rows only.
    """
    slot = F.least(F.floor(F.col(probability) * bins), F.lit(bins - 1)).cast("int")
    counted = scored.groupBy(slot.alias("bin")).agg(
        count_where(F.col(label) == 1).alias("pos"), count_where(F.col(label) == 0).alias("neg")
    )
    down = Window.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counted.select(
        (F.col("bin") / F.lit(bins)).alias("threshold"),
        F.round(F.sum("neg").over(down) / F.nullif(F.sum("neg").over(every), F.lit(0)), 6).alias("fpr"),
        F.round(F.sum("pos").over(down) / F.nullif(F.sum("pos").over(every), F.lit(0)), 6).alias("tpr"),
    )


def roc_curve(scored: DataFrame, label: str = "is_fraud", probability: str = "fraud_probability") -> DataFrame:
    """The exact ROC curve: one row per different score, ``threshold``, ``tp``, ``fp``, ``tpr``, ``fpr`` of calling that score and all above it fraud.

    Equal scores are one point.  Rows without a score or label take no part, NaN is the highest score; without a row of a class its
    rate is NULL.  Counts are summed up per score, then over sorted ranges of scores; no task holds them all.
    """
    counted = scored.filter(F.col(probability).isNotNull() & F.col(label).isNotNull()).groupBy((F.col(probability).cast("double") + F.lit(0.0)).alias("threshold")).agg(
        count_where(F.col(label) == 1).alias("pos"), count_where(F.col(label) == 0).alias("neg")
    )
    summed = prefix_sums(counted, "threshold", ["pos", "neg"], descending=True)
    rate = lambda v: F.col(f"{v}_so_far") / F.nullif(F.col(f"{v}_all"), F.lit(0))
    return summed.select(
        "threshold", F.col("pos_so_far").alias("tp"), F.col("neg_so_far").alias("fp"), rate("pos").alias("tpr"), rate("neg").alias("fpr")
    )


def latest_model(models: DataFrame, created: str = "created_ts") -> DataFrame:
    """The newest row of a table of trained models (path, metrics, creation time)."""
    return latest(models, created)


# -- the whole flow -----------------------------------------------------------
def run_fraud(spark: SparkSession, root: str, txns: DataFrame, params: Mapping | None = None) -> DataFrame:
    """Features, training, evaluation, and the newest model's scores of the test rows.

    Features are merged under their key into ``user_features`` (rows without a user have none), the model goes
    to a folder of its own below ``models``, and a row with its path and AUCs is appended to ``model_metrics``;
    the newest row there is the champion that scores.
    """
    features = hand_over(user_features(txns.filter("user_id IS NOT NULL")), "user_features")
    features = merge_into(spark, f"{root}/user_features", features, ["user_id"])
    training, test = exact_split(hand_over(training_set(txns, features), "training_set"))
    model, run = train(training, params=params), uuid.uuid4().hex
    path = f"{root}/models/{run}"
    model.write().save(path)
    sides = {f"{name}_auc": F.lit(auc(score(model, side))) for name, side in (("train", training), ("test", test))}
    row = spark.range(1).select(F.lit(run).alias("run"), F.lit(path).alias("path"), *(v.alias(k) for k, v in sides.items()))
    append(row.withColumn("created_ts", F.current_timestamp()), f"{root}/model_metrics")
    champion = latest_model(read_table(spark, f"{root}/model_metrics")).first()
    return score(PipelineModel.load(champion["path"]), test)


def score_stream(spark: SparkSession, root: str, rows: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Score a stream of feature rows by the newest model of ``model_metrics`` below ``root``; returns the stored scores.

    Each micro-batch takes the model that is newest when it starts, and replaces the folder ``batch=<id>`` of ``path``: a batch that is
    repeated after a failure adds nothing.  ``model`` names the model's run.  Processes what has arrived and stops.
    """
    models: dict[str, PipelineModel] = {}

    def write(batch: DataFrame, number: int) -> None:
        newest = latest_model(read_table(spark, f"{root}/model_metrics")).first()
        if newest["path"] not in models:
            models.clear()
            models[newest["path"]] = PipelineModel.load(newest["path"])
        scored = score(models[newest["path"]], batch).withColumn("model", F.lit(newest["run"]))
        scored.write.mode("overwrite").parquet(f"{path}/batch={number}")

    drain(rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint))
    return spark.read.parquet(path)
