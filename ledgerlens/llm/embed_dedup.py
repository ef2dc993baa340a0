"""Near-duplicate vectors by an inverted multi-index.

The halves of the normalised vectors have a codebook each; their product is a grid of cells.  A vector
visits the cells nearest to it in the order of the multi-sequence algorithm, as many as calibration
needs for the recall asked for, and is verified against the vectors there.  A pair counts
if either vector visits the other's cell.  Links are counted and thinned out to a forest where
they are found, so a large group of near copies sends no pairs on.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import Shared
from ledgerlens.llm.components import components
from ledgerlens.llm.vectors import block_of, distances, kmeans, matrix, packed, valid
from ledgerlens.sources.tables import hand_over


@dataclass(frozen=True)
class Settings:
    """``sample`` and ``calibration`` bound what is fitted on the driver; ``rows`` and ``queries`` what a task holds."""

    sample: int = 20_000
    cell: int = 50
    words: tuple[int, int] = (4, 256)
    calibration: int = 1024
    recall: float = 0.99
    least_visits: int = 4
    rows: int = 2048
    queries: int = 8192


class Grid:
    def __init__(self, sample: np.ndarray, words: int):
        rng = np.random.default_rng(13)
        self.half = (sample.shape[1] + 1) // 2
        parts = [sample[:, : self.half], sample[:, self.half :]]
        self.books = [kmeans(np.ascontiguousarray(p), words, rng) if p.shape[1] else np.zeros((1, 0)) for p in parts]
        self.width = len(self.books[1])

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of each row to the words of both codebooks."""
        return distances(x[:, : self.half], self.books[0]), distances(x[:, self.half :], self.books[1])

    def visits(self, first: np.ndarray, second: np.ndarray, most: int) -> list[int]:
        """The ``most`` nearest cells, nearest first: pairs of both orders are opened once both their predecessors were."""
        a, b = first.argsort(kind="stable"), second.argsort(kind="stable")
        da, db = first[a].tolist(), second[b].tolist()
        queue, out, done = [(da[0] + db[0], 0, 0)], [], set()
        n, m = len(da), len(db)
        while queue and len(out) < most:
            _, i, j = heapq.heappop(queue)
            done.add((i, j))
            out.append(int(a[i]) * self.width + int(b[j]))
            if i + 1 < n and (j == 0 or (i + 1, j - 1) in done):
                heapq.heappush(queue, (da[i + 1] + db[j], i + 1, j))
            if j + 1 < m and (i == 0 or (i - 1, j + 1) in done):
                heapq.heappush(queue, (da[i] + db[j + 1], i, j + 1))
        return out


def enough_visits(groups: DataFrame, grid: Shared, trial: pa.Table, least: float, settings: Settings) -> int:
    """Cells to visit for the recall asked for: the average share of a calibration vector's links that is found.

    What is collected is a count for each place in the order of the cells.
    """
    asked = Shared(groups.sparkSession, (matrix(trial["x"]), np.array(trial["rep"])))

    def run(batches):
        g = grid.built(lambda x: x)
        q, reps = asked.built(lambda x: x)
        first, second = g.halves(q)
        for batch in batches:
            x, own = matrix(batch.column("x")), np.array(batch.column("rep"))
            cells = [d.argmin(1) for d in g.halves(x)]
            i, j = np.nonzero(q @ x.T >= least)
            keep = reps[i] != own[j]
            pairs, n = np.unique(np.stack([i[keep], cells[0][j[keep]], cells[1][j[keep]]]), axis=1, return_counts=True)
            places = [int(((first[a][:, None] + second[a][None]) < first[a][u] + second[a][v]).sum()) for a, u, v in pairs.T]
            yield pa.RecordBatch.from_pydict({"q": pa.array(pairs[0], pa.int32()), "place": pa.array(places, pa.int32()), "n": pa.array(n, pa.int64())})

    # Every calibration vector with links counts alike, however many it has: a large group of near copies is one voice per vector.
    near = groups.select("x", "rep").mapInArrow(run, "q int, place int, n bigint").groupBy("q", "place").agg(F.sum("n").alias("n"))
    shares = near.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("q")))
    found = sorted((r["place"], r["share"]) for r in shares.groupBy("place").agg(F.sum("share").alias("share")).collect())
    wanted, so_far = settings.recall * sum(n for _, n in found) - 1e-9, 0.0
    for place, n in found:
        so_far += n
        if so_far >= wanted:
            return max(settings.least_visits, place + 1)
    return settings.least_visits


def link(q: np.ndarray, x: np.ndarray, q_reps, x_reps, least: float):
    """For blocks of queries: matrix of links between different vectors."""
    for i in range(0, len(q), 1024):
        yield i, (q[i : i + 1024] @ x.T >= least) & (q_reps[i : i + 1024, None] != x_reps[None])


class Forest:
    """Classes of the rows of one cell as links to them come in; gives edges that connect the same nodes."""

    def __init__(self, reps: np.ndarray):
        self.reps, self.label, self.edges = reps, np.arange(len(reps)), []

    def add(self, rep: int, rows: np.ndarray) -> None:
        labels = np.unique(self.label[rows])
        self.edges.append((rep, int(self.reps[labels[0]])))
        if len(labels) > 1:
            self.edges += [(rep, int(self.reps[x])) for x in labels[1:]]
            self.label[np.isin(self.label, labels)] = labels[0]


def near_duplicates(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = 0.9, settings: Settings = Settings()
) -> DataFrame:
    """One row per input row: ``key``, ``n_links`` (other vectors linked directly), ``component_id``, ``kept``.

    Vectors with cosine >= ``least`` link.  Identical vectors are one node with a number of copies; repeated
    rows (same key and vector) are one vector and get the same result.  Vectors that cannot be
    compared (see ``vectors.valid``) have no links and are their own component; without a key
    that is NULL, and kept.  An empty table gives an empty result; other columns are not read.
    """
    spark = df.sparkSession
    base = hand_over(valid(df, key, vector), "vectors")
    groups = base.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    groups = hand_over(groups.withColumn("norm", norm).withColumn("x", F.transform("v", lambda c: c / F.col("norm"))).drop("norm"), "distinct_vectors")
    total = groups.count()
    words = min(settings.words[1], max(settings.words[0], round(math.sqrt(total / settings.cell))))
    sampled = groups.orderBy(F.xxhash64("rep"), "rep").limit(settings.sample).select("x", "rep").toArrow()
    everything = df.select(F.col(key), F.col(key).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    if not total:
        return everything.select(key, F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    grid = Shared(spark, Grid(matrix(sampled["x"]), words))
    most = enough_visits(groups, grid, sampled.slice(0, settings.calibration), least, settings)

    def place(batches):
        g = grid.built(lambda x: x)
        for batch in batches:
            first, second = g.halves(matrix(batch.column("x")))
            visits = [g.visits(a, b, most) for a, b in zip(first, second)]
            cells = [v[0] for v in visits]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.int32()), pa.array(visits, pa.list_(pa.int32()))], names=["rep", "copies", "x", "cell", "visits"])

    schema = "rep bigint, copies bigint, x array<double>, cell int, visits array<int>"
    placed = hand_over(groups.select("rep", "copies", "x").mapInArrow(place, schema), "cells")
    parts = packed({r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}, settings.rows)  # a row per cell
    asked = {r["c"]: r["n"] for r in placed.select(F.explode("visits").alias("c")).groupBy("c").agg(F.count("*").alias("n")).collect()}
    load: dict[int, int] = {}
    for cell, held in parts.items():
        for part in held:
            load[part] = load.get(part, 0) + asked.get(cell, 0)
    slices = {part: max(1, -(-n // settings.queries)) for part, n in load.items()}
    plan = Shared(spark, (parts, slices))

    def ask(batches):
        parts_, slices_ = plan.built(lambda x: x)
        for batch in batches:
            out: list[tuple[int, int, int, list[int]]] = []
            for i, (rep, visits) in enumerate(zip(batch.column("rep").to_pylist(), batch.column("visits").to_pylist())):
                by: dict[int, list[int]] = {}
                for cell in visits:
                    for part in parts_.get(cell, ()):
                        by.setdefault(part, []).append(cell)
                out += [(i, part, rep * 2654435761 % (1 << 32) % slices_[part], cells) for part, cells in by.items()]
            for k in range(0, len(out), 20_000):
                at, part, slice_, cells = (list(c) for c in zip(*out[k : k + 20_000]))
                rows = [batch.column(c).take(pa.array(at, pa.int32())) for c in ("rep", "copies", "x", "cell")]
                arrays = [*rows, pa.array(part, pa.int32()), pa.array(slice_, pa.int32()), pa.array(cells, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(arrays, names=["rep", "copies", "x", "cell", "part", "slice", "cells"])

    sent = placed.mapInArrow(ask, "rep bigint, copies bigint, x array<double>, cell int, part int, slice int, cells array<int>")
    where = spark.createDataFrame([(c, p) for c, p in sorted(parts.items())], "cell int, parts array<int>")
    dealt = spark.createDataFrame(sorted(slices.items()), "part int, n int")
    held = placed.join(F.broadcast(where), "cell").withColumn("part", block_of(F.col("parts"), F.col("rep"))).drop("parts")
    held = held.join(F.broadcast(dealt), "part").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).drop("n")

    def compare(key, asking, holding):
        q, x = matrix(asking["x"]), matrix(holding["x"])
        q_rep, x_rep = np.array(asking["rep"]), np.array(holding["rep"])
        q_copies, x_copies = np.array(asking["copies"]), np.array(holding["copies"])
        q_links, x_links, edges = np.zeros(len(q_rep), np.int64), np.zeros(len(x_rep), np.int64), []
        if len(q_rep) and len(x_rep):
            q_cell, x_cell = np.array(asking["cell"]), np.array(holding["cell"])
            by: dict[int, list[int]] = {}
            for i, cells in enumerate(asking["cells"].to_pylist()):
                for c in cells:
                    by.setdefault(c, []).append(i)
            seen = [frozenset(v) for v in holding["visits"].to_pylist()]
            for cell, who in by.items():
                mine, who = np.flatnonzero(x_cell == cell), np.array(who)
                forest = Forest(x_rep[mine])
                for start, found in link(q[who], x[mine], q_rep[who], x_rep[mine], least) if len(mine) else ():
                    rows = np.flatnonzero(found.any(1))
                    for r in rows:
                        i, js = who[start + r], np.flatnonzero(found[r])
                        q_links[i] += x_copies[mine[js]].sum()
                        forest.add(int(q_rep[i]), js)
                        # Those that do not visit this vector's cell will not count it themselves.
                        if q_cell[i] != cell:
                            unaware = [j for j in mine[js] if q_cell[i] not in seen[j]]
                            x_links[unaware] += q_copies[i]
                edges += forest.edges
        some = [(q_rep, q_links), (x_rep, x_links)]
        a = np.concatenate([*(rep[n > 0] for rep, n in some), np.array([e[0] for e in edges], np.int64)])
        n = np.concatenate([*(n[n > 0] for _, n in some), np.zeros(len(edges), np.int64)])
        b = [None] * (len(a) - len(edges)) + [e[1] for e in edges]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    found = sent.groupBy("part", "slice").cogroup(held.groupBy("part", "slice")).applyInArrow(compare, "a bigint, b bigint, n bigint")
    found = hand_over(found, "links_found")
    counts = found.filter("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    classes = components(found.filter("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    named = groups.select("v", "rep", "copies").join(counts, "rep", "left").join(classes, "rep", "left")
    links = (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    named = hand_over(named.select(F.col("v").alias("_v"), links, F.coalesce("component", "rep").alias("_top")), "vector_classes")
    same = F.transform("v", lambda c: c + F.lit(0.0)).eqNullSafe(F.col("_v")) & F.col("id").isNotNull()
    out = everything.join(named, same, "left").select(key, "id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("_top", "id").alias("component_id"))
    return out.select(key, "n_links", "component_id", F.col("component_id").eqNullSafe(F.col("id")).alias("kept"))
