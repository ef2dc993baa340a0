"""Left joins from a large table to a reference table, safe for any size of either.

The reference side is broadcast only if its measured size is under a limit.  Beyond it the join shuffles: keys
that have more rows than a task should hold are counted first, and only they are split, each by its
number of rows; their reference rows are repeated once per split, all others go once.  Rows with a NULL key match nothing
and spread over all tasks.  A stream cannot be counted ahead: there every key is split by a fixed salt.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from ledgerlens.sources.tables import hand_over

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 16
#: Rows of one key that stay together in a join; a key with more is split.
HEAVY_ROWS = 1_000_000
#: Values of the salt of rows without a key.
NULL_SALTS = 1 << 30


def measure(*frames: DataFrame) -> list[tuple[int, int]]:
    """Rows and text bytes of each reference table, all in one job of distributed aggregates."""
    sized = []
    for i, df in enumerate(frames):
        width = F.octet_length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns]))
        size = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes"))
        sized.append(size.select(F.lit(i).alias("i"), "n", "bytes"))
    rows = reduce(DataFrame.union, sized).collect()
    return [(r["n"], r["bytes"]) for r in sorted(rows, key=lambda r: r["i"])]


def fits_broadcast(
    *frames: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> list[bool]:
    """For each reference table, whether its measured size allows a broadcast."""
    return [rows <= max_rows and size <= max_bytes for rows, size in measure(*frames)]


def spread(df: DataFrame, salts: int, salt: str = "_salt") -> DataFrame:
    """Add a salt derived from the row itself: a retried task gives the same one."""
    plain = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    return df.withColumn(salt, F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int"))


def spread_keys(left: DataFrame, on: Sequence[str], salts: int, salt: str = "_salt") -> DataFrame:
    """Add a salt for a join: one of ``salts`` for rows with a key, any for rows with a NULL in it, which match nothing."""
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    wide = spread(left, NULL_SALTS, salt)
    return wide.withColumn(salt, F.when(missing, F.col(salt)).otherwise(F.pmod(salt, F.lit(salts))))


def salted_left_join(left: DataFrame, right: DataFrame, on: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Left join whose keys are split ``salts`` ways; the reference rows are repeated once per salt."""
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread_keys(left, on, salts).join(copies, [*on, "_salt"], "left").drop("_salt")


def heavy_keys(left: DataFrame, on: Sequence[str], rows: int = HEAVY_ROWS) -> DataFrame:
    """The keys with more than ``rows`` rows, stored, with ``_splits``: how many tasks their rows should go to."""
    keyed = left.select(*on).dropna("any", subset=list(on))
    counts = keyed.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))  # counted before the shuffle
    return hand_over(counts.filter(F.col("_n") > rows).select(*on, F.ceil(F.col("_n") / rows).cast("int").alias("_splits")), "heavy_keys")


def split_left_join(left: DataFrame, right: DataFrame, on: Sequence[str], rows: int = HEAVY_ROWS) -> DataFrame:
    """Left join that splits the keys of more than ``rows`` left rows, and no others."""
    heavy = heavy_keys(left, on, rows)
    if fits_broadcast(heavy)[0]:
        heavy = F.broadcast(heavy)
    missing = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    splits = F.coalesce("_splits", F.lit(1))
    dealt = spread(left, NULL_SALTS).join(heavy, list(on), "left")
    dealt = dealt.withColumn("_salt", F.when(missing, F.col("_salt")).otherwise(F.pmod("_salt", splits))).drop("_splits")
    copies = right.join(heavy, list(on), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), splits - 1))).drop("_splits")
    return dealt.join(copies, [*on, "_salt"], "left").drop("_salt")


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    salts: int = SALTS,
    fits: bool | None = None,
    heavy_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """Left join on same-named keys, unique on the right: broadcast if measured small, else shuffled with heavy keys split.

    ``fits`` is the outcome of ``fits_broadcast`` where the caller measured several tables at once.
    """
    if fits is None:
        (fits,) = fits_broadcast(right, max_rows=max_rows, max_bytes=max_bytes)
    if fits:
        return left.join(F.broadcast(right), list(on), "left")
    if left.isStreaming:
        return salted_left_join(left, right, on, salts)
    return split_left_join(left, right, on, heavy_rows)
