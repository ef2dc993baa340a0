"""Generic column builders used by all layers.

All of them work on DOUBLE and DECIMAL input alike: zero defaults are integer
literals, so a decimal sum stays a decimal and remains independent of the order
in which partitions are merged.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def predicate(p: ColumnLike) -> Column:
    """A predicate given as SQL text or as a Column."""
    return F.expr(p) if isinstance(p, str) else p


def holds(p: ColumnLike) -> Column:
    """TRUE only where the predicate is TRUE: NULL counts as a violation."""
    return F.coalesce(predicate(p), F.lit(False))


def all_hold(preds: Iterable[ColumnLike]) -> Column:
    """TRUE where every predicate is TRUE, else FALSE."""
    return holds(reduce(lambda a, b: a & b, map(predicate, preds), F.lit(True)))


def any_holds(preds: Iterable[ColumnLike]) -> Column:
    """TRUE where at least one predicate is TRUE, else FALSE."""
    return holds(reduce(lambda a, b: a | b, map(predicate, preds), F.lit(False)))


def query_time(as_of: Column | datetime | None = None) -> Column:
    """The run's reference time; the clock is read only if none is given."""
    if as_of is None:
        return F.current_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")


# -- aggregates ---------------------------------------------------------------
def count_where(cond: ColumnLike) -> Column:
    """Rows where ``cond`` is TRUE; 0 (never NULL) over no rows."""
    return F.count_if(predicate(cond))


def zero_if_null(value: Column, scale: int | None = None) -> Column:
    return F.coalesce(value if scale is None else F.round(value, scale), F.lit(0))


def sum0(x: ColumnLike, scale: int = 2) -> Column:
    return zero_if_null(F.sum(col(x)), scale)


def sum_where(cond: ColumnLike, x: ColumnLike, scale: int = 2) -> Column:
    return sum0(F.when(predicate(cond), col(x)), scale)


def ratio0(total: Column, n: Column, scale: int = 2) -> Column:
    """``total / n`` from already aggregated parts, 0 where nothing was counted."""
    return zero_if_null(total / F.nullif(n, F.lit(0)), scale)


def avg0(x: ColumnLike, scale: int = 2) -> Column:
    """Mean of the non-NULL values.  Written as sum / count so that a decimal mean keeps
    enough digits for its one rounding."""
    return ratio0(F.sum(col(x)), F.count(col(x)), scale)


def max0(x: ColumnLike, scale: int | None = None) -> Column:
    return zero_if_null(F.max(col(x)), scale)


def any_true(flag: ColumnLike) -> Column:
    return F.bool_or(col(flag))


def distinct(x: ColumnLike, approx: bool = False) -> Column:
    """Distinct non-NULL values, exact by default."""
    return F.approx_count_distinct(col(x)) if approx else F.count_distinct(col(x))


def stddev(x: ColumnLike) -> Column:
    """Sample deviation: NULL for a single row."""
    return F.stddev_samp(col(x))


def weight_of(key: ColumnLike, weights: Mapping[str, str | Decimal]) -> Column:
    """Literal lookup table; an unlisted key gives NULL."""
    entries = [e for k, w in weights.items() for e in (F.lit(k), F.lit(Decimal(w)).cast("decimal(6,4)"))]
    return F.create_map(*entries)[col(key)]


def weighted_sum(x: ColumnLike, key: ColumnLike, weights: Mapping[str, str | Decimal], scale: int = 2) -> Column:
    """Sum of ``x`` times its key's weight; rows with an unlisted key do not count."""
    return sum0(col(x) * weight_of(key, weights), scale)


# -- scalars ------------------------------------------------------------------
def pct(n: ColumnLike, d: ColumnLike, scale: int = 4) -> Column:
    """``n`` as a percentage of ``d``; NULL where ``d`` is 0."""
    return F.round(col(n) / F.nullif(col(d), F.lit(0)) * 100, scale)


def parse_rfc1123(s: ColumnLike) -> Column:
    """``Fri, 27 Mar 2020 00:00:01 +0000`` -> timestamp, NULL when malformed.

    The weekday is cut off first: Spark's parser does not accept one.
    """
    return F.try_to_timestamp(F.regexp_replace(col(s), r"^\w+,\s*", ""), F.lit("dd MMM yyyy HH:mm:ss xx"))


def age_minutes(later: ColumnLike, earlier: ColumnLike) -> Column:
    return (F.unix_timestamp(col(later)) - F.unix_timestamp(col(earlier))) / 60


def content_hash(parts: Mapping[str, ColumnLike], sep: str = "|") -> Column:
    """SHA-256 over ``name=value`` pairs; a missing value is written ``None``."""
    rendered = [F.concat(F.lit(f"{k}="), F.coalesce(col(v).cast("string"), F.lit("None"))) for k, v in parts.items()]
    return F.sha2(F.concat_ws(sep, *rendered), 256)


# -- mergeable distinct counts -------------------------------------------------
def distinct_sketch(value: ColumnLike, lg_k: int = 14) -> Column:
    """Aggregate: a sketch of the distinct values, a few KB whatever their number; sketches of parts can be merged."""
    return F.hll_sketch_agg(col(value), lg_k)


def distinct_of(sketch: ColumnLike) -> Column:
    """Aggregate: about how many distinct values the sketches have seen together (relative standard error about 0.8 % at ``lg_k`` 14)."""
    return F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(col(sketch))), F.lit(0).cast("bigint"))


# -- JSON cells ---------------------------------------------------------------
def json_list(order: ColumnLike, *fields: Column, limit: int | None = None) -> Column:
    """Aggregate: the group's (first ``limit``) rows as a JSON array, sorted by ``order`` whatever
    order they arrive in."""
    rows = F.sort_array(F.collect_list(F.struct(col(order).alias("_order"), F.struct(*fields).alias("row"))))
    if limit is not None:
        rows = F.slice(rows, 1, limit)
    return F.to_json(F.transform(rows, lambda r: r["row"]))


def json_map(key: ColumnLike, value: ColumnLike) -> Column:
    """Aggregate: the group's rows as a JSON object sorted by key.  A NULL key is written ``NULL``."""
    pair = F.struct(F.coalesce(col(key).cast("string"), F.lit("NULL")).alias("k"), col(value).alias("v"))
    return F.to_json(F.map_from_entries(F.sort_array(F.collect_list(pair))))
