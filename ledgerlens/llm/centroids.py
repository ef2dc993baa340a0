"""Centroid clustering by an equal-average equal-variance search in integers.

Centroids are sorted by their component sum (their mean, without a division).  A vector's search starts at its own
mean and goes outward.  With d components, sums S and deviations V (the root of the squared distance to
one's own mean) the squared distance of a vector and a centroid is at least ``(S - S')**2 / d + (V - V')**2``: the
first term grows with every step outward and ends the search on a side, both together reject a single centroid.
What is left is measured exactly; the rejections only leave out what cannot be nearer or equally near.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Shared
from ledgerlens.llm.vectors import matrix
from ledgerlens.sources.tables import hand_over

#: Vectors searched at once in a task.
BLOCK = 4096
#: Largest integer component: squared distances of up to 1,024 components then fit a bigint.
LARGEST = 1 << 25
#: Slack of the floating bounds, far above their rounding.
SLACK = 1e-6


@dataclass(frozen=True)
class Settings:
    clusters: int = 8
    rounds: int = 10
    components: int = 64
    scale: int = 1024
    seed: int = 3


def order_key(seed: int, key: Column) -> Column:
    """Lowercase-hex SHA-256 of ``seed:key``; NULL for a NULL key."""
    return F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256)


def integer_vectors(df: DataFrame, key: str, vector: str, components: int, scale: int) -> DataFrame:
    """``id``, ``x`` (array<bigint>, floor of ``scale`` times each component) of the rows that take part."""
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform("v", lambda c: F.floor(c * F.lit(float(scale))))
    fits = F.forall("v", lambda c: F.abs(c * F.lit(float(scale))) < LARGEST)
    refused = F.raise_error(F.lit(f"a component of {vector} times {scale} is {LARGEST} or more"))
    return rows.filter(F.col("v").isNotNull() & (F.size("v") == components) & finite).select("id", F.when(fits, scaled).otherwise(refused).alias("x"))


class Codebook:
    """Centroids in the order of their component sums."""

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.number = np.lexsort((np.arange(len(centroids)), sums))
        self.c, self.sums = centroids[self.number], sums[self.number]
        self.deviations = _deviations(self.c, self.sums)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of each row's nearest centroid (of equally near ones the smallest number), and
        how many distances were measured."""
        n, d = x.shape
        k, measured = len(self.c), 0
        sums = x.sum(axis=1)
        dev = _deviations(x, sums)
        up = np.searchsorted(self.sums, sums)
        down = up - 1
        best = np.full(n, np.iinfo(np.int64).max)
        who = np.full(n, k, dtype=np.int64)
        active = np.arange(n)
        for _ in range(k):
            # The nearer mean of the two sides; a side that has run out is infinitely far.
            low, high, s = down[active], up[active], sums[active]
            gap_low = np.where(low >= 0, np.abs(s - self.sums[np.maximum(low, 0)]).astype(float), np.inf)
            gap_high = np.where(high < k, np.abs(self.sums[np.minimum(high, k - 1)] - s).astype(float), np.inf)
            left = gap_low <= gap_high
            gap = np.where(left, gap_low, gap_high)
            # Every centroid still unseen is at least this far by its mean.
            within = gap * gap * (1 - SLACK) <= d * best[active].astype(float)
            active, left, gap, low, high = active[within], left[within], gap[within], low[within], high[within]
            if not len(active):
                break
            at = np.where(left, low, high)
            down[active[left]] -= 1
            up[active[~left]] += 1
            apart = dev[active] - self.deviations[at]
            near = (gap * gap / d + apart * apart) * (1 - SLACK) - SLACK * (dev[active] + self.deviations[at] + 1) ** 2 <= best[active]
            rows, at = active[near], at[near]
            measured += len(rows)
            apart = x[rows] - self.c[at]
            distance = (apart * apart).sum(axis=1)
            number = self.number[at]
            better = (distance < best[rows]) | ((distance == best[rows]) & (number < who[rows]))
            best[rows[better]], who[rows[better]] = distance[better], number[better]
        return who, best, measured


def _deviations(x: np.ndarray, sums: np.ndarray) -> np.ndarray:
    return np.sqrt(((x - (sums / x.shape[1])[:, None]) ** 2).sum(axis=1))


def _blocks(batches):
    for batch in batches:
        for i in range(0, batch.num_rows, BLOCK):
            part = batch.slice(i, BLOCK)
            yield part, matrix(part.column("x"))


def _totals(rows: DataFrame, centroids: np.ndarray) -> list[tuple[int, list[int]]]:
    """For each centroid: how many vectors are nearest to it, and their componentwise sums.

    A task sends one row per centroid and component, which are added up before and after the shuffle; the driver
    gets as many numbers as the centroids have.
    """
    k, d = centroids.shape
    shared = Shared(rows.sparkSession, centroids)

    def run(batches):
        book = shared.built(Codebook)
        sums = np.zeros((k, d + 1), dtype=np.int64)
        for _, x in _blocks(batches):
            who, _, _ = book.nearest(x)
            for c in np.unique(who):
                mine = x[who == c]
                sums[c, 0] += len(mine)
                sums[c, 1:] += mine.sum(axis=0)
        c, at = np.indices(sums.shape)
        yield pa.RecordBatch.from_arrays([pa.array(v.ravel()) for v in (c.astype(np.int32), at.astype(np.int32), sums)], names=["c", "at", "total"])

    parts = rows.select("x").mapInArrow(run, "c int, at int, total bigint")
    out = np.zeros((k, d + 1), dtype=np.int64)
    for r in parts.groupBy("c", "at").agg(F.sum("total").alias("total")).collect():
        out[r["c"], r["at"]] = r["total"]
    return [(int(row[0]), row[1:].tolist()) for row in out]


def cluster(df: DataFrame, key: str = "vec_id", vector: str = "embedding", settings: Settings = Settings()) -> DataFrame:
    """``key``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid`` (array<bigint>) of every vector that takes part.

    Centroids start as the vectors with the smallest hash of ``seed:key``; each round assigns every vector and
    replaces a centroid with vectors by the exact floor of their mean, one without stays.  Ties go to the smaller
    number.  Vectors that are NULL, have another number of components or a NULL or non-finite one are left out.
    A component whose scaled value is ``LARGEST`` or more is refused, as distances would not fit a bigint.
    Repeated rows are vectors of their own; a NULL key takes part and starts a centroid only after all others (of equal
    hashes the smaller vector is first).  With fewer vectors than clusters there are as many clusters as vectors; an empty
    table gives an empty result; other columns, whatever their names, are not read.
    """
    s, spark = settings, df.sparkSession
    rows = hand_over(integer_vectors(df, key, vector, s.components, s.scale), "integer_vectors")
    start = rows.orderBy(order_key(s.seed, F.col("id")).asc_nulls_last(), "x").limit(s.clusters).select("x").collect()
    if not start:
        empty = "cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid array<bigint>"
        return spark.createDataFrame([], f"{key} bigint, {empty}")
    centroids = np.array([r["x"] for r in start], dtype=np.int64)
    for _ in range(s.rounds):
        sums = _totals(rows, centroids)
        centroids = np.array([[v // n for v in total] if n else old for (n, total), old in zip(sums, centroids.tolist())], dtype=np.int64)

    shared = Shared(spark, centroids)

    def run(batches):
        book = shared.built(Codebook)
        for part, x in _blocks(batches):
            who, distance, _ = book.nearest(x)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(who.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    said = hand_over(rows.mapInArrow(run, "id bigint, cluster int, distance bigint"), "assigned")
    # One row per cluster, a bounded number: broadcast.
    per = said.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = {r["cluster"]: r["cluster_inertia"] for r in per.collect()}
    known = [(c, inertia[c], sum(inertia.values()), centroids[c].tolist()) for c in sorted(inertia)]
    sums = spark.createDataFrame(known, "cluster int, cluster_inertia bigint, inertia bigint, centroid array<bigint>")
    return said.join(F.broadcast(sums), "cluster").select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(centroid: Column) -> Column:
    """Lowercase-hex SHA-256 of the components as decimals joined by commas."""
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)

