"""Hard negatives by best-first search of packed R-trees.

Rows are cut into tiles by label and, sort-tile-recursive, by quantiles of the widest coordinates.  In a task
a tile's rows are packed the same way into leaves, and leaves into nodes, each with its minimum bounding box.  A
box bounds the inner product with an anchor coordinate by coordinate: between the sums of the smaller and the larger of
``q * low`` and ``q * high``.  A queue opens the box with the largest bound first and drops boxes that lie outside
every score window or strictly below the k-th score found in it; equal scores are kept, as ties go by key.

Tiles' own boxes leave out, before anything is sent, the tiles that no window of an anchor touches.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import Shared
from ledgerlens.llm.vectors import matrix
from ledgerlens.sources.tables import hand_over

#: Sums of products stay exact in double precision below this.
EXACT = 1 << 53
OPEN = float(1 << 62)


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds what the tiles' cuts are fitted on, ``tiles`` how many there are, ``rows`` and ``anchors`` what a task holds."""

    scale: int = 256
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    sample: int = 20_000
    tiles: int = 1024
    rows: int = 16_384
    anchors: int = 2048
    leaf: int = 128
    fan: int = 16


# -- packing ------------------------------------------------------------------
def tiled(x: np.ndarray, most: int) -> list[np.ndarray]:
    """Row numbers of groups of at most ``most`` rows, sort-tile-recursive: slabs of equally many rows along the widest
    coordinate, each cut again along its own, until a slab is a group."""
    out: list[np.ndarray] = []

    def cut(rows: np.ndarray) -> None:
        groups = -(-len(rows) // most)
        if groups <= 1:
            out.append(rows)
            return
        part = x[rows]
        widest = int((part.max(axis=0) - part.min(axis=0)).argmax())
        ordered = rows[np.argsort(part[:, widest], kind="stable")]
        slabs = max(2, int(np.ceil(np.sqrt(groups))))
        for slab in np.array_split(ordered, min(slabs, groups)):
            cut(slab)

    if len(x):
        cut(np.arange(len(x)))
    return out


class Tree:
    """An R-tree over rows: leaves packed by ``tiled``, every ``fan`` of them, in that order, below a node."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaf: int, fan: int):
        groups = tiled(x, leaf)
        order = np.concatenate(groups)
        self.x, self.ids, self.labels = x[order], ids[order], labels[order]
        self.ends = np.concatenate([[0], np.cumsum([len(g) for g in groups])]).astype(np.int64)
        # Boxes by level, from the leaves up.
        low = np.array([x[g].min(axis=0) for g in groups])
        high = np.array([x[g].max(axis=0) for g in groups])
        self.levels, self.fan = [(low, high)], fan
        while len(low) > 1:
            at = np.arange(0, len(low), fan)
            low, high = np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)
            self.levels.append((low, high))

    def search(self, q: np.ndarray, own: int, label: int, same: bool, windows: list[tuple[float, float]], k: int, seen: list[int] | None = None) -> list[list[tuple[float, int]]]:
        """For each window (lowest and highest score): its ``k`` best (-score, id) in order, among rows of the same or of
        other labels without the id ``own``.  ``seen`` gets the leaves that were read."""
        found: list[list[tuple[float, int]]] = [[] for _ in windows]
        least = [lo for lo, _ in windows]  # what a score must reach: the window's end, then the k-th score
        top = len(self.levels) - 1
        queue: list[tuple[float, int, int, float]] = []

        def push(level: int, first: int, last: int) -> None:
            low, high = self.levels[level]
            upper, lower = bounds(q, low[first:last], high[first:last])
            for i in np.flatnonzero(upper >= min(least)).tolist():
                heapq.heappush(queue, (-upper[i], level, first + i, lower[i]))

        push(top, 0, len(self.levels[top][0]))
        while queue:
            upper, level, node, lower = heapq.heappop(queue)
            upper = -upper
            if upper < min(least):
                break
            asked = [w for w, (_, hi) in enumerate(windows) if upper >= least[w] and lower <= hi]
            if not asked:
                continue
            if level:
                push(level - 1, node * self.fan, (node + 1) * self.fan)
                continue
            if seen is not None:
                seen.append(node)
            a, b = self.ends[node], self.ends[node + 1]
            scores, ids = self.x[a:b] @ q, self.ids[a:b]
            candidate = (ids != own) & ((self.labels[a:b] == label) == same)
            for w in asked:
                good = np.flatnonzero(candidate & (scores >= least[w]) & (scores <= windows[w][1]))
                if len(good) > k:
                    good = good[scores[good] >= np.partition(scores[good], len(good) - k)[len(good) - k]]
                if len(good):
                    found[w] = heapq.nsmallest(k, found[w] + list(zip((-scores[good]).tolist(), ids[good].tolist())))
                    if len(found[w]) == k:
                        least[w] = -found[w][-1][0]
        return found


def bounds(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest and smallest inner product of ``q`` with anything in each box."""
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    return high @ up + low @ down, low @ up + high @ down


# -- rows ---------------------------------------------------------------------
def integer_rows(df: DataFrame, key: str, vector: str, label: Column, scale: int) -> DataFrame:
    """``id``, ``label``, ``x`` (array<bigint>) of the rows that take part, without repeated rows."""
    rows = df.select(F.col(key).cast("bigint").alias("id"), label.cast("bigint").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & finite)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    d = sizes["d"] if sizes else 0
    largest = int((EXACT / max(d, 1)) ** 0.5)
    scaled = F.transform("v", lambda c: F.floor(c * F.lit(float(scale))))
    fits = F.forall("v", lambda c: F.abs(c * F.lit(float(scale))) < largest)
    refused = F.raise_error(F.lit(f"a component of {vector} times {scale} is {largest} or more"))
    return rows.filter(F.size("v") == d).select("id", "label", F.when(fits, scaled).otherwise(refused).alias("x")).dropDuplicates()


class Tiles:
    """Cuts of the space of each label, fitted on a sample: along the widest coordinate at its median, and so on."""

    def __init__(self):
        self.roots: dict[int, int] = {}
        self.cuts: list[tuple[int, float, int, int]] = []  # coordinate, cut, numbers below and above; coordinate -1: a tile
        self.count = 0

    def fit(self, label: int, x: np.ndarray, tiles: int) -> None:
        self.roots[label] = self._grow(x, tiles)

    def _grow(self, x: np.ndarray, tiles: int) -> int:
        at = len(self.cuts)
        self.cuts.append((-1, 0.0, self.count, 0))
        spread = x.max(axis=0) - x.min(axis=0) if len(x) else np.zeros(1)
        if tiles <= 1 or spread.max() == 0:
            self.count += 1
            return at
        c = int(spread.argmax())
        cut = float(np.median(x[:, c]))
        below = x[:, c] < cut
        if not below.any():  # the median is the smallest value
            cut = float(x[:, c][x[:, c] > cut].min())
            below = x[:, c] < cut
        half = tiles // 2
        self.cuts[at] = (c, cut, self._grow(x[below], half), self._grow(x[~below], tiles - half))
        return at

    def tile_of(self, label: int, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), dtype=np.int32)
        todo = [(self.roots[label], np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            c, cut, first, second = self.cuts[node]
            if c < 0:
                out[rows] = first
                continue
            below = x[rows, c] < cut
            todo += [(first, rows[below]), (second, rows[~below])]
        return out


def placed(rows: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``tile``: rows of one label, alike in the coordinates the tiles are cut along; stored.

    Tiles are as many as the rows need, about ``settings.tiles`` at most; what a tile holds beyond a task is
    split into blocks later.  Labels beyond that number share tiles by their hash.
    """
    s, spark = settings, rows.sparkSession
    if rows.select("label").distinct().limit(s.tiles + 1).count() > s.tiles:
        return hand_over(rows.withColumn("tile", F.pmod(F.xxhash64("label"), F.lit(s.tiles)).cast("int")), "tiles")
    counts = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total, made = sum(counts.values()), Tiles()
    sampled = rows.orderBy(F.xxhash64("id", "x"), "id").limit(s.sample).select("label", "x").toArrow()
    labels, x = np.array(sampled["label"]), matrix(sampled["x"])
    for label, n in sorted(counts.items()):
        made.fit(label, x[labels == label], max(1, min(-(-n // s.rows), s.tiles * n // total)))
    shared = Shared(spark, made)

    def run(batches):
        t = shared.built(lambda v: v)
        for batch in batches:
            label, x = np.array(batch.column("label")), matrix(batch.column("x"))
            tile = np.zeros(len(label), dtype=np.int32)
            for one in np.unique(label):
                tile[label == one] = t.tile_of(one, x[label == one])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tile)], names=["id", "label", "x", "tile"])

    return hand_over(rows.mapInArrow(run, "id bigint, label bigint, x array<bigint>, tile int"), "tiles")


@dataclass
class Boxes:
    """Per tile, by place: its number, rows, smallest and largest label, and box.  Bounded by the number of tiles."""

    tile: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray


def boxes(rows: DataFrame) -> Boxes:
    def run(batches):
        for batch in batches:
            tile, x, label = np.array(batch.column("tile")), matrix(batch.column("x")), np.array(batch.column("label"))
            for t in np.unique(tile):
                # The label is one more coordinate, at the end.
                mine = np.column_stack([x[tile == t], label[tile == t]])
                n = mine.shape[1]
                columns = [np.full(n, t, np.int32), np.arange(n, dtype=np.int32), mine.min(axis=0), mine.max(axis=0), np.full(n, len(mine))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["tile", "at", "low", "high", "n"])

    parts = rows.select("tile", "x", "label").mapInArrow(run, "tile int, at int, low bigint, high bigint, n bigint")
    whole = parts.groupBy("tile", "at").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).orderBy("tile", "at").toArrow()
    tile = np.unique(np.array(whole["tile"]))
    low, high, n = (np.array(whole[c]).reshape(len(tile), -1) for c in ("low", "high", "n"))
    return Boxes(tile, n[:, 0], np.stack([low[:, -1], high[:, -1]], axis=1), low[:, :-1].astype(float), high[:, :-1].astype(float))


WINDOW = "array<struct<id: bigint, score: bigint, low: double, high: double>>"


def _windows(column) -> list[list[tuple[float, float]]]:
    return [[(w["low"], w["high"]) for w in ws] for ws in column.to_pylist()]


def answers(rows: DataFrame, around: Boxes, asked: DataFrame, same: bool, k: int, settings: Settings) -> DataFrame:
    """For each window of each row of ``asked`` (``id``, ``row``, ``label``, ``x``, ``windows``) the ``k`` best rows of the same label, or of others.

    ``anchor``, ``row``, ``w`` (place of the window), ``rank`` (from 1), ``id``, ``score``.  A tile's rows are copied once for every
    ``settings.anchors`` anchors that have something to look for in it.
    """
    s, spark = settings, rows.sparkSession
    shared = Shared(spark, around)

    def route(batches):
        b = shared.built(lambda v: v)
        for batch in batches:
            out = []
            for q, label, windows in zip(matrix(batch.column("x")).astype(float), batch.column("label").to_pylist(), _windows(batch.column("windows"))):
                upper, lower = bounds(q, b.low, b.high)
                alike = (b.labels[:, 0] <= label) & (label <= b.labels[:, 1]) if same else (b.labels != label).any(axis=1)
                touched = np.zeros(len(b.tile), dtype=bool)
                for low, high in windows:
                    touched |= (upper >= low) & (lower <= high)
                out.append(b.tile[alike & touched].tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=[*batch.schema.names, "tiles"])

    asked = asked.select("id", "row", "label", "x", "windows")
    sent = hand_over(asked.mapInArrow(route, f"id bigint, row bigint, label bigint, x array<bigint>, windows {WINDOW}, tiles array<int>"), "asked")
    load = {r["tile"]: r["n"] for r in sent.select(F.explode("tiles").alias("tile")).groupBy("tile").agg(F.count("*").alias("n")).collect()}
    split = [(int(t), int(-(-n // s.rows)), int(-(-load.get(t, 0) // s.anchors))) for t, n in zip(around.tile.tolist(), around.rows.tolist())]
    split = F.broadcast(spark.createDataFrame(split, "tile int, blocks int, slices int"))  # a row per tile
    slice_of, block = F.pmod(F.xxhash64("row"), F.col("slices")), F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asking = sent.withColumn("tile", F.explode("tiles")).drop("tiles").join(split, "tile").withColumn("slice", slice_of.cast("int")).withColumn("block", each("blocks"))
    holding = rows.join(split, "tile").filter("slices > 0").withColumn("block", block.cast("int")).withColumn("slice", each("slices"))
    names, kinds = ["anchor", "row", "w", "id", "score"], [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def search(key, asking, holding):
        out = []
        if asking.num_rows and holding.num_rows:
            tree = Tree(matrix(holding["x"]).astype(float), np.array(holding["id"]), np.array(holding["label"]), s.leaf, s.fan)
            told = zip(asking["id"].to_pylist(), asking["row"].to_pylist(), asking["label"].to_pylist(), matrix(asking["x"]).astype(float), _windows(asking["windows"]))
            for anchor, row, label, q, windows in told:
                for w, found in enumerate(tree.search(q, anchor, label, same, windows, k)):
                    out += [(anchor, row, w, i, int(-score)) for score, i in found]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 5, kinds)], names=names)

    group = ["tile", "block", "slice"]
    near = asking.groupBy(*group).cogroup(holding.select(*group, "id", "label", "x").groupBy(*group)).applyInArrow(search, "anchor bigint, row bigint, w int, id bigint, score bigint")
    best = Window.partitionBy("anchor", "row", "w").orderBy(F.desc("score"), "id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def mine(df: DataFrame, anchors: Callable[[Column], Column], key: str = "vec_id", vector: str = "embedding", label: Column | str = "label", settings: Settings = Settings()) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.

    Anchors are the rows whose key ``anchors`` takes; an anchor's positives are its ``positives`` best rows of the same label, and
    for each of them come the best ``negatives`` rows of other labels whose score is from ``low`` to ``high`` percent of the
    positive's.  Scores are inner products of the components' integer floors after scaling; ties go to the smaller key.

    Rows with a NULL key, label, vector or component, a non-finite component, an empty vector, or not the number of components that
    most have (of equally many, the larger) take no part; zero vectors do.  Repeated rows count once; different rows with one key are
    rows of their own but no candidates for each other.  A window without rows, or an anchor without positives, gives no
    rows; an empty table gives an empty result; other columns, whatever their names, are not read.
    A scaled component so large that scores would not be exact is refused.
    """
    s, spark = settings, df.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    rows = hand_over(integer_rows(df, key, vector, label, s.scale), "integer_rows")
    if rows.isEmpty():
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    rows = placed(rows, s)
    around = boxes(rows)
    row = F.xxhash64("id", "label", "x")
    everything = F.array(F.struct(F.lit(0).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("score"), F.lit(-OPEN).alias("low"), F.lit(OPEN).alias("high")))
    asked = rows.filter(anchors(F.col("id"))).select("id", row.alias("row"), "label", "x", everything.alias("windows"))
    positives = answers(rows, around, asked, True, s.positives, s)
    percent = lambda p: F.col("score") * p
    low = (percent(s.low) + 99 - F.pmod(percent(s.low) + 99, F.lit(100))) / 100
    high = (percent(s.high) - F.pmod(percent(s.high), F.lit(100))) / 100
    windows = F.sort_array(F.collect_list(F.struct("rank", "id", "score", low.alias("low"), high.alias("high"))))
    windows = F.transform(F.filter(windows, lambda w: w["low"] <= w["high"]), lambda w: w.dropFields("rank"))
    told = positives.groupBy("anchor", "row").agg(windows.alias("windows")).filter(F.size("windows") > 0)
    again = hand_over(asked.drop("windows").join(told.withColumnRenamed("anchor", "id"), ["id", "row"]), "anchors")
    found = answers(rows, around, again, False, s.negatives, s).withColumnRenamed("id", "negative_id")
    named = again.select(F.col("id").alias("anchor"), "row", F.posexplode("windows").alias("w", "p"))
    return found.join(named, ["anchor", "row", "w"]).select(
        F.col("anchor").alias("anchor_id"), F.col("p.id").alias("positive_id"), "rank", "negative_id", F.col("p.score").alias("positive_score"), F.col("score").alias("negative_score")
    )
