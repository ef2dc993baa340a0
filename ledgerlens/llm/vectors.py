"""Vectors as both vector operators see them: valid ones, one row for identical ones, cells packed into bounded groups."""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``id`` (bigint), ``v`` (array<double>) of the rows that can be compared, without repeated rows.

    Left out are rows without a key, and vectors that are NULL, empty, zero, or have a NULL or
    non-finite component, or not the number of components that most have (of equally many, the larger).
    """
    rows = df.select(F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    # -0.0 and 0.0 are the same component.
    return rows.filter(F.size("v") == (sizes["d"] if sizes else 0)).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0))).dropDuplicates(["id", "v"])


def matrix(column) -> np.ndarray:
    """Rows of an Arrow column of lists of one length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 12) -> np.ndarray:
    """At most ``k`` centres by Lloyd's steps from distinct starting rows; a centre without rows stays where it is."""
    centres = np.unique(x, axis=0)
    centres = centres[rng.permutation(len(centres))[:k]]
    for _ in range(steps):
        at = nearest(x, centres)
        n = np.bincount(at, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, at, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, row by row the same however many rows are asked for at once."""
    return (x * x).sum(1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1)[None]


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([distances(x[i : i + 8192], centres).argmin(1) for i in range(0, len(x), 8192)] or [np.zeros(0, int)])


def packed(counts: Mapping[int, int], most: int) -> dict[int, list[int]]:
    """Cells to the groups that hold them: small cells share a group, a cell beyond ``most`` rows has several."""
    out: dict[int, list[int]] = {}
    group, room = -1, 0
    for cell in sorted(counts):
        n = counts[cell]
        if n > most:
            blocks = -(-n // most)
            out[cell] = list(range(group + 1, group + 1 + blocks))
            group, room = group + blocks, 0
            continue
        if n > room:
            group, room = group + 1, most
        out[cell] = [group]
        room -= n
    return out


def block_of(parts: Column, key: Column) -> Column:
    """One of the groups in ``parts`` by the hash of the key."""
    return F.get(parts, F.pmod(F.xxhash64(key), F.size(parts)).cast("int"))
