"""Ordered computations split so that no key has to fit in one task.

A window over a customer or a currency puts all its rows into one task.  Here each is
cut along time first; what crosses a cut travels as pre-aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ledgerlens.functions.columns import ColumnLike, col, count_where
from ledgerlens.sources.tables import hand_over

DAY_SECONDS = 86_400


def lag_by_day(
    df: DataFrame, keys: Sequence[str], day: str, order: Sequence[str], value: str, alias: str
) -> DataFrame:
    """Previous ``value`` per key in ``order``; ``day`` must grow with the first order column.

    Inside a day it is a plain lag.  A day's first row takes the last value of the key's
    previous day, found on one row per key and day.
    """
    in_day = Window.partitionBy(*keys, day).orderBy(*order)
    days = df.groupBy(*keys, day).agg(F.max_by(value, F.struct(*order)).alias("_close"))
    carried = days.select(
        *keys, day, F.lag("_close").over(Window.partitionBy(*keys).orderBy(day)).alias("_carried")
    )
    ranked = df.withColumns({"_in_day": F.lag(value).over(in_day), "_pos": F.row_number().over(in_day)})
    parts = {c: f"_of_{c}" for c in [*keys, day]}
    carried = carried.withColumnsRenamed(parts)
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(p)) for c, p in parts.items()])
    joined = ranked.join(carried, same, "left").drop(*parts.values())
    previous = F.when(F.col("_pos") == 1, F.col("_carried")).otherwise(F.col("_in_day"))
    return joined.withColumn(alias, previous).drop("_in_day", "_pos", "_carried")


def change_pct(value: ColumnLike, previous: ColumnLike, scale: int = 6) -> Column:
    """Percentage change, NULL without a positive previous value."""
    p = col(previous)
    return F.when(p > 0, F.round((col(value) - p) / F.nullif(p, F.lit(0)) * 100, scale))


def rate_change(
    df: DataFrame,
    keys: Sequence[str] = ("quote_currency",),
    day: str = "rate_date",
    order: Sequence[str] = ("fetch_ts", "rate_id"),
    value: str = "rate",
    move_pct: float = 1.0,
) -> DataFrame:
    """Add prev_rate, rate_change_pct and significant_move."""
    return (
        lag_by_day(df, keys, day, order, value, "prev_rate")
        .withColumn("rate_change_pct", change_pct(value, "prev_rate"))
        .withColumn("significant_move", F.coalesce(F.abs("rate_change_pct") > move_pct, F.lit(False)))
    )


def daily_average(
    df: DataFrame,
    keys: Sequence[str] = ("quote_currency", "rate_date"),
    value: str = "rate",
    alias: str = "daily_avg_rate",
    scale: int = 6,
) -> DataFrame:
    """Add the group's mean to each row (shares the per-day partitioning of the lag)."""
    return df.withColumn(alias, F.round(F.avg(value).over(Window.partitionBy(*keys)), scale))


def rolling_totals(df: DataFrame, key: str, ts: str, value: str, days: int, scale: int = 6) -> DataFrame:
    """(key, second, rolling): sum of ``value`` over ``[second - days, second]``, both ends included.

    The result depends on key and second only, so rows are first summed per key and second.
    A sliding frame would add up its whole content again for every row; instead each amount enters
    at its second and leaves one second after the window has passed it, and a running sum over
    these changes is the rolling total.  Time is cut into chunks as long as the window: a chunk
    needs its own rows and, as context, what enters and leaves from the chunk before.  A window
    partition then holds at most three chunk lengths of changes whatever the key's row count.

    Floating input is summed as a decimal of ``scale`` digits, so that what leaves cancels exactly;
    a total that covers NaN or an infinity is NaN.
    """
    length = days * DAY_SECONDS
    floating = df.schema[value].dataType in (DoubleType(), FloatType())
    finite = ~F.isnan(value) & (F.abs(value) < float("inf")) if floating else F.lit(True)
    amount = F.when(finite, F.col(value).cast(f"decimal(28,{scale})")) if floating else F.col(value)
    per_second = df.groupBy(F.col(key), F.unix_seconds(F.col(ts).cast("timestamp")).alias("_second")).agg(
        F.sum(amount).alias("_total"), F.count(value).alias("_n"), count_where(~finite).alias("_odd")
    )
    per_second = per_second.withColumn("_total", F.coalesce("_total", F.lit(0).cast(per_second.schema["_total"].dataType)))
    chunk = F.floor(F.col("_second") / length)

    def change(into: Column, at: Column, sign: int, own: bool) -> Column:
        return F.struct(
            into.alias("chunk"),
            at.alias("at"),
            (F.col("_total") * sign).alias("moved"),
            (F.col("_n") * sign).alias("n"),
            (F.col("_odd") * sign).alias("odd"),
            F.lit(own).alias("own"),
        )

    at = F.col("_second")
    changes = F.array(
        change(chunk, at, 1, True), change(chunk + 1, at, 1, False), change(chunk + 1, at + length + 1, -1, False)
    )
    placed = per_second.select(key, F.inline(changes)).filter("own OR chunk IS NOT NULL")
    so_far = Window.partitionBy(key, "chunk").orderBy("at").rangeBetween(Window.unboundedPreceding, 0)
    rolling = F.when(F.sum("n").over(so_far) > 0, F.sum("moved").over(so_far))
    if floating:
        rolling = F.when(F.sum("odd").over(so_far) > 0, float("nan")).otherwise(rolling.cast("double"))
    summed = placed.select(key, F.col("at").alias("_second"), rolling.alias("_rolling"), "own")
    return summed.filter("own").drop("own")


def rolling_sum(
    df: DataFrame, key: str, ts: str, value: str, days: int, alias: str = "rolling_sum", scale: int = 6
) -> DataFrame:
    """Add to each row the sum of ``value`` over the key's last ``days`` days up to its second.

    Rows of the same second see each other.  Rows with NULL key or time form groups of their own.
    """
    totals = rolling_totals(df, key, ts, value, days, scale).withColumnRenamed(key, "_key")
    rows = df.withColumn("_at", F.unix_seconds(F.col(ts).cast("timestamp")))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_at").eqNullSafe(F.col("_second"))
    return rows.join(totals, same, "left").drop("_key", "_second", "_at").withColumnRenamed("_rolling", alias)


def prefix_sums(df: DataFrame, by: str, values: Sequence[str], descending: bool = False) -> DataFrame:
    """Add ``<value>_so_far`` and ``<value>_all``: the sum up to and including the row in the order of ``by``, and over all rows.

    ``by`` must be unique.  A window without a partition would move everything into one task: the rows are sorted into
    ranges instead and stored with the number of their range, the ranges' totals (one row each) become
    offsets, and a running sum goes on inside each range from its offset.
    """
    order = F.col(by).desc() if descending else F.col(by).asc()
    ranged = hand_over(df.repartitionByRange(order).withColumn("_range", F.spark_partition_id()), "ranges")
    totals = ranged.groupBy("_range").agg(*(F.sum(v).alias(v) for v in values)).orderBy("_range").collect()
    so_far, offsets = dict.fromkeys(values, 0), []
    for r in totals:
        offsets.append((r["_range"], *(so_far[v] for v in values)))
        so_far = {v: so_far[v] + (r[v] or 0) for v in values}
    kinds = ", ".join(f"`_before_{v}` {ranged.schema[v].dataType.simpleString()}" for v in values)
    before = ranged.sparkSession.createDataFrame(offsets, f"_range int, {kinds}")
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.join(F.broadcast(before), "_range")  # a row per range
    added = {f"{v}_so_far": F.col(f"_before_{v}") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}
    summed = summed.withColumns(added).withColumns({f"{v}_all": F.lit(so_far[v]) for v in values})
    return summed.drop("_range", *(f"_before_{v}" for v in values))
