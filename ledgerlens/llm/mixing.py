"""Mixing sources to target weights by entropy balancing.

Of all document rates that give every source its target of words, the one nearest to taking each
document once (in relative entropy) is an exponential tilt by the document's size, bounded by the
most copies allowed.  The tilts solve a convex dual with one unknown per source; each
Newton step is one aggregation over the counts of (source, size).  Rates are rounded to copies with the
rounding error carried from the large documents to the small ones.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.sources.tables import hand_over

WEIGHTS = (1, 2, 3)
MOST = 3
#: Documents that are rounded together; a source has one bucket for every so many.
BUCKET_ROWS = 1_000
NEWTON_STEPS, TOLERANCE = 80, 1e-11


def size_of(text: Column) -> Column:
    """Number of words; NULL and empty texts have none."""
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit("[^ \\x09-\\x0D]+")), F.lit(0)).cast("bigint")


def positions(names: DataFrame, column: str) -> DataFrame:
    """Adds ``position`` (from 0) by code point, NULL last: a distributed sort, then offsets of its partitions."""
    numbered = hand_over(names.orderBy(F.col(column).asc_nulls_last()).withColumn("_id", F.monotonically_increasing_id()), "sorted")
    part = F.shiftright("_id", 33)
    sizes = numbered.groupBy(part.alias("_part")).agg(F.count("*").alias("_n")).collect()  # a row per partition
    offsets, total = [], 0
    for r in sorted(sizes):
        offsets.append((r["_part"], total))
        total += r["_n"]
    starts = names.sparkSession.createDataFrame(offsets, "_part bigint, _start bigint")
    within = F.col("_id") - F.shiftleft(part, 33)
    return numbered.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn("position", F.col("_start") + within).drop("_id", "_part", "_start")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to ``source``, ``source_size``: all words by weight, at most ``most`` times the source's.

    What a bounded source leaves is shared anew among the rest, until none is above its bound.
    """
    cycle = F.array(*map(F.lit, weights))
    weighted = positions(sources, "source").withColumn("weight", cycle[(F.col("position") % len(weights)).cast("int")].cast("double"))
    weighted = hand_over(weighted.drop("position").withColumn("bound", (most * F.col("source_size")).cast("double")), "weights")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    share, full = 0.0, None
    while True:
        above = F.col("weight") * share > F.col("bound")
        row = weighted.agg(
            F.sum(F.when(above, F.col("bound"))).alias("full"), F.sum(F.when(~above, F.col("weight"))).alias("weight"), F.count(F.when(above, 1)).alias("n")
        ).first()
        if row["n"] == full or not row["weight"]:
            break
        full, share = row["n"], (total - (row["full"] or 0.0)) / row["weight"]
    return weighted.withColumn("target", F.least(F.col("weight") * share, "bound"))


def rate(tilt: Column, size: Column, mean: Column, most: int) -> Column:
    """exp(tilt * size / mean), at most ``most``."""
    x = tilt * size / F.when(mean > 0, mean).otherwise(1.0)
    return F.when(x >= math.log(most), float(most)).otherwise(F.exp(x))


def tilts(cells: DataFrame, sources: DataFrame, most: int = MOST) -> DataFrame:
    """Adds ``tilt`` to the sources: Newton steps on the dual, kept inside the interval known to hold the solution.

    ``cells``: ``source``, ``size``, ``n``.  A source whose target is its bound has no finite solution:
    every document is taken ``most`` times.  Ends when every source is within TOLERANCE of its
    target; the tilts are rounded so that the order of sums cannot show.
    """
    state = sources.withColumn("full", (F.col("target") >= F.col("bound")) & (F.col("bound") > 0)).withColumn("mean", F.col("source_size") / F.col("n_docs"))
    start = F.when((F.col("source_size") == 0) | F.col("full"), 0.0).otherwise(F.log(F.col("target") / F.col("source_size")))
    state = hand_over(state.select("*", start.alias("tilt"), F.lit(-1e6).alias("low"), F.lit(1e6).alias("high"), F.lit(False).alias("done")), "tilts")
    for _ in range(NEWTON_STEPS):
        open_ = state.filter("not done and not full and source_size > 0")
        if open_.isEmpty():
            break
        known = open_.select(F.col("source").alias("_s"), "tilt", "mean")
        taken = F.col("n") * F.col("size") * rate(F.col("tilt"), F.col("size"), F.col("mean"), most)
        moves = F.when(F.col("tilt") * F.col("size") / F.col("mean") < math.log(most), taken * F.col("size") / F.col("mean")).otherwise(0.0)
        sums = cells.filter("size > 0").join(known, F.col("source").eqNullSafe(F.col("_s"))).groupBy("_s").agg(F.sum(taken).alias("taken"), F.sum(moves).alias("slope"))
        both = state.join(sums, F.col("source").eqNullSafe(F.col("_s")), "left")
        over = F.col("taken") - F.col("target")
        done = F.col("done") | F.col("taken").isNull() | (F.abs(over) <= TOLERANCE * F.col("target"))
        low, high = F.when(over < 0, F.col("tilt")).otherwise(F.col("low")), F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - over / F.when(F.col("slope") > 0, F.col("slope"))
        middle = F.when(low < -9e5, F.col("tilt") - 1 - F.abs("tilt")).when(high > 9e5, F.col("tilt") + 1 + F.abs("tilt")).otherwise((low + high) / 2)
        moved = F.when((newton > low) & (newton < high), newton).otherwise(middle)
        kept = [c for c in state.columns if c not in ("tilt", "low", "high", "done")]
        state = hand_over(
            both.select(*kept, F.when(done, F.col("tilt")).otherwise(moved).alias("tilt"), F.when(done, F.col("low")).otherwise(low).alias("low"), F.when(done, F.col("high")).otherwise(high).alias("high"), done.alias("done")),
            "tilts",
        )
    return state.withColumn("tilt", F.when(F.col("full"), F.lit(1e9)).otherwise(F.round("tilt", 10))).drop("low", "high", "done", "full")


def rounded(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``copies`` to rows with ``_group``, ``_bucket``, ``_size``, ``_rate``: floor or ceiling, the error carried on.

    Each (group, bucket) goes from its largest document to its smallest, so what remains
    at the end is about half a small document.  Rows stream through; no group is held.
    """
    spread = rows.repartition("_group", "_bucket").sortWithinPartitions("_group", "_bucket", F.desc("_size"), *order)

    def run(batches):
        at, carried = None, 0.0
        for batch in batches:
            groups, buckets, sizes, rates = (batch.column(c).to_pylist() for c in ("_group", "_bucket", "_size", "_rate"))
            copies = []
            for g, b, size, r in zip(groups, buckets, sizes, rates):
                if (g, b) != at:
                    at, carried = (g, b), 0.0
                wanted, low = r * size + carried, math.floor(r)
                high = math.ceil(r)
                n = low if abs(wanted - low * size) <= abs(wanted - high * size) else high
                carried = wanted - n * size
                copies.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(copies, pa.int32())], names=[*batch.schema.names, "_copies"])

    return spread.mapInArrow(run, _typed(spread) + ", _copies int")


def _typed(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def mix(
    df: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id", carry: tuple[str, ...] = (), weights=WEIGHTS, most: int = MOST
) -> DataFrame:
    """One row per input row: ``key``, the columns of ``carry``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``.

    NULL and empty texts have size 0 and take nothing (one copy, no words); a NULL source is a
    source, the last; a source without words has target 0.  Repeated rows are rounded one after the
    other.  An empty table gives an empty result; other columns are not read.  The same rows
    give the same copies, whatever their order: buckets and order depend on key, size and text alone.
    """
    carried = {f"_c{i}": c for i, c in enumerate(carry)}
    rows = df.select(
        F.col(key).alias("_key"), F.col(source).cast("string").alias("_group"), size_of(F.col(text)).alias("_size"), F.xxhash64(F.col(key), F.col(text)).alias("_hash"),
        *(F.col(c).alias(a) for a, c in carried.items()),
    )
    if not carry:  # else the size is counted again rather than the texts stored
        rows = hand_over(rows, "sizes")
    cells = hand_over(rows.groupBy(F.col("_group").alias("source"), F.col("_size").alias("size")).agg(F.count("*").alias("n")), "cells")
    sources = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n_docs"))
    solved = hand_over(tilts(cells, targets(sources, weights, most), most), "solved")
    joined = rows.join(solved, F.col("_group").eqNullSafe(F.col("source")))
    buckets = F.ceil(F.col("n_docs") / BUCKET_ROWS).cast("bigint")
    joined = joined.select(
        *rows.columns, "source_size", "target", F.pmod("_hash", buckets).alias("_bucket"), rate(F.col("tilt"), F.col("_size"), F.col("mean"), most).alias("_rate")
    )
    done = rounded(joined, ["_key", "_hash"])
    return done.select(
        F.col("_key").alias(key), *(F.col(a).alias(c) for a, c in carried.items()), F.col("_size").alias("size"), "source_size", "target",
        F.col("_copies").alias("copies"), (F.col("_copies") * F.col("_size")).cast("bigint").alias("taken"),
    )
