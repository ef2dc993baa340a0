"""Keys, ordering, pivots and schema shaping."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.functions.columns import ColumnLike, col


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns, in its order and with its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def count_rows(df: DataFrame, keys: Sequence[str] = (), alias: str = "row_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(alias))


def bound_partitions(df: DataFrame, rows: int) -> DataFrame:
    """``df`` as it is if no partition of it has more than ``rows`` rows, else spread evenly over as many as that takes.

    ``df`` should be stored, as its rows are counted first.
    """
    per_part = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    found = per_part.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    if (found["most"] or 0) <= rows:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * math.ceil(found["all"] / (cores * rows)))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows by ``order``; end the order in a unique column for a stable result."""
    return df.orderBy(*order).limit(k)


def latest(df: DataFrame, order: ColumnLike) -> DataFrame:
    """The newest row of the whole frame (none if it is empty), as a partial aggregate."""
    newest = df.agg(F.max_by(F.struct("*"), col(order)).alias("r"))
    return newest.filter(F.col("r").isNotNull()).select("r.*")


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key by ``order``.  Spark cuts each group to one row before the shuffle,
    so a hot key sends one row per task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedupe(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first by ``order``, or any row when no order is given."""
    return df.dropDuplicates(list(keys)) if order is None else latest_per(df, keys, order)


def pivot_wide(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], agg: Column) -> DataFrame:
    """One row per key, one column per listed value; listing them saves the job that finds them."""
    return df.groupBy(*keys).pivot(column, list(values)).agg(agg)


def check_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break a primary key: repeated or with a NULL part.  Empty means valid."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).filter((F.col("row_count") > 1) | has_null)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target with the updates' rows replacing or joining those of the same key."""
    kept = target.join(updates.select(*keys), list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(updates)
