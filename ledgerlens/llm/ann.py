"""Nearest neighbours by largest inner product: a hierarchical k-means tree, searched best bin first.

The tree is fitted on a bounded sample and every vector is put into a leaf.  A query goes down the tree
through a priority queue, always opening the nearest bin seen so far.  How many leaves it visits is
widened on calibration queries, against brute force over all vectors, until the recall asked for
is reached.  Inner products become distances by one more component (the gap to the largest norm).
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import Shared
from ledgerlens.llm.vectors import block_of, distances, kmeans, matrix, nearest, packed, valid
from ledgerlens.sources.tables import hand_over


@dataclass(frozen=True)
class Settings:
    """``sample`` and ``calibration`` bound what is fitted on the driver; ``rows`` and ``queries`` what a task holds."""

    sample: int = 20_000
    branches: int = 8
    leaf: int = 40
    calibration: int = 256
    recall: float = 0.97
    rows: int = 8192
    queries: int = 1024


class Tree:
    def __init__(self, sample: np.ndarray, largest: float, settings: Settings):
        self.largest = largest
        self.centres: list[np.ndarray] = []  # of the children of each inner node
        self.children: list[list[int]] = []  # >= 0: inner node; below: leaf -1 - i
        self.leaves = 0
        rng = np.random.default_rng(11)
        if len(sample):
            self._grow(self.lifted(sample), rng, settings)

    def _grow(self, x: np.ndarray, rng, settings: Settings) -> int:
        centres = kmeans(x, settings.branches, rng) if len(x) > settings.leaf else x[:1]
        at = nearest(x, centres)
        used = np.unique(at)
        if len(used) < 2 and self.centres:
            self.leaves += 1
            return -self.leaves
        node = len(self.centres)
        self.centres.append(centres[used])
        self.children.append([])
        self.children[node] = [self._grow(x[at == u], rng, settings) for u in used]
        return node

    def lifted(self, x: np.ndarray) -> np.ndarray:
        gap = np.sqrt(np.maximum(self.largest**2 - (x * x).sum(1), 0))
        return np.hstack([x, gap[:, None]])

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=np.int32)
        todo = [(0, np.arange(len(x)))] if len(x) else []
        lifted = self.lifted(x)
        while todo:
            node, rows = todo.pop()
            at = nearest(lifted[rows], self.centres[node])
            for i, child in enumerate(self.children[node]):
                if len(mine := rows[at == i]):
                    if child < 0:
                        out[mine] = -1 - child
                    else:
                        todo.append((child, mine))
        return out

    def visits(self, query: np.ndarray, most: int, held: Mapping[int, int] = {}, least: int = 0) -> list[int]:  # noqa: B006
        """The first ``most`` leaves, best bin first, and as many more as it takes to see ``least`` vectors, of which leaf i holds ``held[i]``."""
        q = np.append(query, 0.0)[None]
        queue, out, seen = [(0.0, 0)], [], 0
        while queue and (len(out) < most or seen < least):
            _, node = heapq.heappop(queue)
            if node < 0:
                out.append(-1 - node)
                seen += held.get(-1 - node, 0)
                continue
            for d, child in zip(distances(q, self.centres[node])[0], self.children[node]):
                heapq.heappush(queue, (float(d), child))
        return out


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, the components added from first to last whatever the block."""
    out = np.zeros((len(queries), len(rows)))
    for i in range(0, len(queries), 128):
        block, part = queries[i : i + 128], out[i : i + 128]
        for d in range(rows.shape[1]):
            part += block[:, d, None] * rows[None, :, d]
    return out


def best(values: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest finite values, and of all that equal the last of them."""
    found = np.flatnonzero(values > -np.inf)
    if len(found) <= k:
        return found
    v = values[found]
    return found[v >= np.partition(v, len(v) - k)[len(v) - k]]


def calibrated(groups: DataFrame, tree: Shared, queries: np.ndarray, k: int, settings: Settings) -> int:
    """Leaves to visit: doubled until the recall of the calibration queries is reached, then the least that reaches it."""
    asked = Shared(groups.sparkSession, queries)

    def run(batches):
        t, q = tree.built(lambda x: x), asked.built(lambda x: x)
        for batch in batches:
            x, leaf = matrix(batch.column("v")), np.array(batch.column("leaf"))
            s = scores(q, x)
            s[_same(q, x)] = -np.inf
            for i in range(len(q)):
                at = best(s[i], k)
                yield pa.RecordBatch.from_pydict({"q": np.full(len(at), i, np.int32), "score": s[i][at], "leaf": leaf[at].astype(np.int32)})

    near = groups.select("v", "leaf").mapInArrow(run, "q int, score double, leaf int")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "leaf")
    truth = near.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k).select("q", "leaf").collect()
    whole = tree.broadcast.value
    place = [{leaf: r for r, leaf in enumerate(whole.visits(q, whole.leaves))} for q in queries]
    ranks = np.sort([place[r["q"]][r["leaf"]] for r in truth])
    visits = 1
    while visits < whole.leaves and (ranks < visits).sum() < settings.recall * len(ranks):
        visits *= 2
    return int(min(max(1, whole.leaves), max(visits // 2, ranks[int(np.ceil(settings.recall * len(ranks))) - 1] + 1 if len(ranks) else 1)))


def _same(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Which rows are identical."""
    places: dict[bytes, list[int]] = {}
    for j, row in enumerate(x):
        places.setdefault(row.tobytes(), []).append(j)
    out = np.zeros((len(q), len(x)), dtype=bool)
    for i, row in enumerate(q):
        out[i, places.get(row.tobytes(), [])] = True
    return out


def search(df: DataFrame, queries: Callable[[Column], Column], key: str = "vec_id", vector: str = "embedding", k: int = 20, settings: Settings = Settings()) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found for every row whose key ``queries`` takes.

    Candidates are all rows but the query's own; ties go to the smaller key.  Identical vectors are
    searched once and hold their ``k`` + 1 smallest keys, which are all that a result can contain; a leaf
    of many vectors and the queries of a leaf are dealt to several tasks.  Vectors that cannot be
    compared (see ``vectors.valid``) and rows without a key take no part; repeated rows count
    once; an empty table gives an empty result; other columns are not read.
    """
    spark = df.sparkSession
    base = hand_over(valid(df, key, vector), "vectors")
    w = Window.partitionBy("v").orderBy("id")
    first = base.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1)
    groups = hand_over(first.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("rep", F.get("ids", F.lit(0))), "distinct_vectors")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    largest = groups.agg(F.max(F.sqrt(squares))).first()[0]
    if largest is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    sampled = groups.orderBy(F.xxhash64("rep"), "rep").limit(settings.sample).select("v").toArrow()
    tree = Shared(spark, Tree(matrix(sampled["v"]), largest, settings))

    def leaves(batches):
        t = tree.built(lambda x: x)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(t.leaf_of(matrix(batch.column("v"))))], names=["rep", "v", "ids", "leaf"])

    placed = hand_over(groups.select("rep", "v", "ids").mapInArrow(leaves, "rep bigint, v array<double>, ids array<bigint>, leaf int"), "leaves")
    asked = base.filter(queries(F.col("id"))).join(groups.select("v", "rep"), "v").select(F.col("id").alias("query_id"), "rep", "v")
    asked = hand_over(asked, "queries")
    distinct = asked.dropDuplicates(["rep"]).select("rep", "v")
    trial = distinct.orderBy(F.xxhash64("rep", F.lit(1)), "rep").limit(settings.calibration).toArrow()
    most = calibrated(placed, tree, matrix(trial["v"]), k, settings) if trial.num_rows else 1

    counts = placed.groupBy("leaf").agg(F.count("*").alias("n"), F.sum(F.size("ids")).alias("ids")).collect()  # a row per leaf
    parts, ids_in = packed({r["leaf"]: r["n"] for r in counts}, settings.rows), {r["leaf"]: r["ids"] for r in counts}
    holds = spark.createDataFrame(sorted(parts.items()), "leaf int, parts array<int>")  # a row per leaf
    asked_for = distinct.count()
    slices = max(1, -(-asked_for // settings.queries))
    groups_of = Shared(spark, (parts, ids_in))

    def ask(batches):
        t, (p, held_in) = tree.built(lambda x: x), groups_of.built(lambda x: x)
        for batch in batches:
            x, reps, out = matrix(batch.column("v")), batch.column("rep").to_pylist(), []
            for i, q in enumerate(x):
                by: dict[int, list[int]] = {}
                for leaf in t.visits(q, most, held_in, k + 1):  # so that k others are seen where there are as many
                    for part in p.get(leaf, ()):
                        by.setdefault(part, []).append(leaf)
                out += [(reps[i], i, part, found) for part, found in by.items()]
            rep, place, part, found = (list(c) for c in zip(*out)) if out else ([], [], [], [])
            vs = batch.column("v").take(pa.array(place, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), vs, pa.array(part, pa.int32()), pa.array(found, pa.list_(pa.int32()))], names=["rep", "v", "part", "leaves"])

    slice_ = F.pmod(F.xxhash64("rep"), F.lit(slices)).cast("int")
    # A traversal is much work for few bytes: the number of tasks follows the queries, not their size.
    tasks = max(spark.sparkContext.defaultParallelism, -(-asked_for // 500))
    sent = distinct.repartition(tasks, "rep").mapInArrow(ask, "rep bigint, v array<double>, part int, leaves array<int>").withColumn("slice", slice_)
    held = placed.join(F.broadcast(holds), "leaf").select("v", "ids", "leaf", block_of(F.col("parts"), F.col("rep")).alias("part"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))

    def compare(key, asking, holding):
        q, x = matrix(asking["v"]), matrix(holding["v"])
        names = ["rep", "score", "vec_id"]
        kinds = [pa.int64(), pa.float64(), pa.int64()]
        rows: list[tuple] = []
        if len(q) and len(x):
            s = np.full((len(q), len(x)), -np.inf)
            leaf, by = np.array(holding["leaf"]), {}
            for i, found in enumerate(asking["leaves"].to_pylist()):
                for f in found:
                    by.setdefault(f, []).append(i)
            for f, who in by.items():
                if len(mine := np.flatnonzero(leaf == f)):
                    s[np.ix_(who, mine)] = scores(q[who], x[mine])
            ids = holding["ids"].to_pylist()
            for i, rep in enumerate(asking["rep"].to_pylist()):
                near = sorted((-s[i, j], n) for j in best(s[i], k + 1) for n in ids[j])
                rows += [(rep, -score, n) for score, n in near[: k + 1]]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((), (), ()), kinds)], names=names)

    found = sent.groupBy("part", "slice").cogroup(held.groupBy("part", "slice")).applyInArrow(compare, "rep bigint, score double, vec_id bigint")
    w = Window.partitionBy("rep").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k + 1)
    near = found.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("near"))
    others = F.slice(F.filter("near", lambda n: n["vec_id"] != F.col("query_id")), 1, k)
    listed = asked.select("query_id", "rep").join(hand_over(near, "near"), "rep").select("query_id", F.posexplode(others).alias("p", "n"))
    return listed.select("query_id", (F.col("p") + 1).alias("rank"), "n.vec_id", "n.score")

