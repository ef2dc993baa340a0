"""Clustering, hard negatives and packing against brute force, and their defined results on unusual rows."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import centroids, hard_negatives, packing
from ledgerlens.llm.common import ship
from ledgerlens.llm.queries import REGISTRY, WORDS

VECTORS = "vec_id bigint, embedding array<float>, label int, x string, id int, cluster int, row int"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def odd_vectors(d: int) -> list[tuple]:
    """Rows with NULLs, ties, repeats, non-finite components and clashing columns."""
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(d)], i % 3) for i in range(0, 1200, 4)]
    copy = [0.25] * d
    rows += [(2000 + i, copy, i % 2) for i in range(60)]  # ties
    rows += [rows[0], rows[0], (4, rows[3][1], 1), (None, rows[5][1], 1), (7, None, 1), (8, [], 1), (9, [None] + [0.1] * (d - 1), 1), (14, [0.0] * d, 2)]
    rows += [(10, [float("nan")] * d, 1), (11, [float("inf")] + [0.0] * (d - 1), 1), (12, [0.5] * (d - 1), 1), (13, [0.1] * d, None)]
    return [(*r, "x", 1, 2, 3) for r in rows]


def usable(v, d):
    return v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)


def floors(v, scale):
    return [math.floor(scale * float(np.float32(c))) for c in v]


# -- 11 -----------------------------------------------------------------------
def plain_nearest(x, c):
    distance = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    who = distance.argmin(axis=1)
    return who, distance[np.arange(len(x)), who]


def plain_clusters(kept, k, rounds, seed=3):
    """``kept``: (id, integers).  Number and distance of each, final centroids."""
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    c = [list(r[1]) for r in sorted(kept, key=key)[:k]]
    x = np.array([r[1] for r in kept])
    for _ in range(rounds):
        who, _ = plain_nearest(x, np.array(c))
        c = [[int(s) // int((who == i).sum()) for s in x[who == i].sum(axis=0)] if (who == i).any() else old for i, old in enumerate(c)]
    return *plain_nearest(x, np.array(c)), c


@pytest.mark.parametrize("spread", [1, 40, 30_000_000])
def test_search_by_mean_and_deviation_is_exact(spread):
    rng = np.random.default_rng(spread)
    c = rng.integers(-spread, spread + 1, (300, 24))
    c[7] = c[3]  # a tie goes to the smaller number
    x = np.concatenate([rng.integers(-spread, spread + 1, (500, 24)), c])
    who, distance, measured = centroids.Codebook(c).nearest(x)
    want, least = plain_nearest(x, c)
    assert (who == want).all() and (distance == least).all()
    assert measured <= len(x) * len(c)


def test_search_leaves_centroids_out():
    rng = np.random.default_rng(2)
    c = rng.integers(-900, 900, (256, 1)) + rng.integers(-40, 40, (256, 32))
    x = c[rng.integers(0, 256, 2000)] + rng.integers(-10, 10, (2000, 32))
    who, _, measured = centroids.Codebook(c).nearest(x)
    assert (who == plain_nearest(x, c)[0]).all() and measured < 0.1 * len(x) * len(c)


def test_clusters_equal_plain_loops(spark):
    rows = odd_vectors(64)
    df = spark.createDataFrame(rows, VECTORS)
    kept = [(r[0], floors(r[1], 1024)) for r in rows if usable(r[1], 64)]
    who, distance, c = plain_clusters(kept, 8, 10)
    got = centroids.cluster(df).withColumn("sha", centroids.digest(F.col("centroid"))).collect()
    assert sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in got), key=str) == sorted(((k[0], int(w), int(d)) for k, w, d in zip(kept, who, distance)), key=str)
    for r in got:
        assert r["centroid"] == c[r["cluster"]] and r["inertia"] == distance.sum() and r["cluster_inertia"] == distance[who == r["cluster"]].sum()
        assert r["sha"] == hashlib.sha256(",".join(map(str, c[r["cluster"]])).encode()).hexdigest()
    assert centroids.cluster(df.limit(0)).count() == 0
    few = centroids.cluster(df.filter("vec_id IN (4, 8, 12)")).collect()
    assert {r["distance"] for r in few} == {0} and len({r["cluster"] for r in few}) == 3
    with pytest.raises(Exception, match="or more"):
        centroids.cluster(spark.createDataFrame([(1, [1e30] * 64)], "vec_id int, embedding array<double>"))


# -- 12 -----------------------------------------------------------------------
def plain_negatives(rows, step):
    """``rows``: distinct (id, label, integers)."""
    out = []
    for a, label, q in rows:
        if a % step:
            continue
        others = sorted((-sum(x * y for x, y in zip(q, v)), i, other) for i, other, v in rows if i != a)
        for p, positive, _ in [o for o in others if o[2] == label][:5]:
            good = [(n, i) for n, i, other in others if other != label and 30 * -p <= 100 * -n <= 90 * -p][:10]
            out += [(a, positive, r + 1, i, -p, -n) for r, (n, i) in enumerate(good)]
    return sorted(out)


def mined(df, step, **changes):
    got = hard_negatives.mine(df, lambda k: k % step == 0, settings=hard_negatives.Settings(**changes))
    return sorted(tuple(r) for r in got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.mark.parametrize("changes", [{}, {"rows": 40, "anchors": 7, "leaf": 8, "fan": 3}, {"rows": 40, "tiles": 2, "leaf": 8}])
def test_hard_negatives_equal_plain_loops(spark, changes):
    """Whole tiles, many tiles and blocks, and more labels than tiles give the same rows."""
    rows = odd_vectors(16)
    df = spark.createDataFrame(rows, VECTORS)
    taking = {(r[0], r[2], tuple(floors(r[1], 256))) for r in rows if r[0] is not None and r[2] is not None and usable(r[1], 16)}
    want = plain_negatives(sorted(taking), 20)
    assert len(want) > 100 and mined(df, 20, **changes) == want


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame(odd_vectors(16), VECTORS)
    assert mined(df.limit(0), 20) == [] and mined(df.filter("vec_id IS NULL"), 20) == [] and mined(df.filter("vec_id > 0"), 5003) == []
    assert mined(df.filter("label = 1"), 20) == []  # no other label


def test_boxes_bound_and_prune():
    rng = np.random.default_rng(3)
    centre = rng.normal(0, 100, (40, 12))
    x = np.floor(centre[rng.integers(0, 40, 4000)] + rng.normal(0, 3, (4000, 12)))
    ids, labels = np.arange(4000), np.arange(4000) % 2
    tree = hard_negatives.Tree(x, ids, labels, 32, 4)
    assert sorted(tree.ids.tolist()) == ids.tolist() and max(np.diff(tree.ends)) <= 32
    reads = 0
    for a in range(0, 4000, 200):
        q, seen = x[a], []
        low, high = hard_negatives.bounds(q, *tree.levels[0])[::-1]
        for n in range(len(low)):
            s = tree.x[tree.ends[n] : tree.ends[n + 1]] @ q
            assert low[n] <= s.min() and s.max() <= high[n]
        best = float(q @ q)
        windows = [(-hard_negatives.OPEN, hard_negatives.OPEN), (0.3 * best, 0.9 * best), (2 * best, 3 * best)]
        found = tree.search(q, a, int(labels[a]), False, windows, 10, seen)
        scores = x @ q
        for w, (lo, hi) in enumerate(windows):
            assert found[w] == sorted((-s, i) for s, i in zip(scores.tolist(), ids.tolist()) if labels[i] != labels[a] and lo <= s <= hi)[:10]
        reads += len(seen)
    assert reads < 0.5 * 20 * (len(tree.ends) - 1)


# -- 13 -----------------------------------------------------------------------
TEXTS = ["the cat sat on the mat", None, "", " \t\n", "lorem ipsum dolor " * 9000, "É é é ΑΣ σᾳ Ⅻ ﬁ x y z", "<|endoftext|> a<|startoftext|>b", "x" * 30_000, "1 2 333 !?! it's we'll", "the cat sat on the mat", "\x1c\x1f\x85 \x00"]


def checked(made, places, capacity):
    """Rows of both by ``row``; every place is inside its sequence, gapless and without overlap."""
    rows = {r["row"]: r for r in made.collect()}
    at = {r["row"]: r for r in places.collect()}
    assert rows.keys() == at.keys()
    by = collections.defaultdict(list)
    for k, r in rows.items():
        by[at[k]["sequence_id"]].append((at[k]["offset"], r["length"]))
    for parts in by.values():
        end = 0
        for offset, n in sorted(parts):
            assert offset == end and n >= 1
            end += n
        assert end <= capacity
    return rows, at, len(by)


def test_packing_of_texts(spark):
    library = Tokenizer.from_file(WORDS)
    df = spark.createDataFrame([(i if i != 3 else None, t, 1, 2, "x") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, row int, length int, ids string")
    made, places = packing.pack(df, WORDS)
    rows, at, _ = checked(made, places, 4096)
    texts = collections.defaultdict(list)
    for r in rows.values():
        texts[r["doc_id"]].append(r)
    for i, t in enumerate(TEXTS):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        got = sorted(texts[i if i != 3 else None], key=lambda r: r["piece"])
        assert [x for r in got for x in r["ids"]] == ids and [r["start"] for r in got] == list(range(0, len(ids), 4096))
        assert all(r["length"] == 4096 for r in got[:-1])
    crc = {r["row"]: r["ids_crc32"] for r in packing.ids_crc32(made, "row").collect()}
    assert crc == {k: zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for k, r in rows.items()}
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(made, places).collect()}
    for k, r in rows.items():
        offset = at[k]["offset"]
        assert whole[at[k]["sequence_id"]][offset : offset + r["length"]] == r["ids"]
    made, places = packing.pack(df.limit(0), WORDS)
    assert made.count() == places.count() == 0


def test_words_alone_equal_the_library():
    library, encoder, rng = Tokenizer.from_file(WORDS), packing.WordEncoder(WORDS, keep=50, longest=5, window=9), random.Random(4)
    everything = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    narrow = [chr(i) for i in range(256)]
    assert encoder.split_known
    encode = lambda text: encoder.encode([text.encode()])[0].tolist()
    for a in narrow:  # every pair of characters that is split here
        text = " ".join(a + b for b in narrow) + " " + "".join(a + b for b in narrow)
        assert encode(text) == library.encode(text, add_special_tokens=False).ids, repr(a)
    parts = ["'s", "'LL", " ", "  ", "The", "É", "é", "\n", "́", "\x1c", "\x85", "　", "<|endoftext|>", "Σ", "İ", "½", "1", "_-", "가"]
    made = []
    for _ in range(3000):
        text = "".join(rng.choice(everything if rng.random() < 0.05 else narrow if rng.random() < 0.3 else parts) for _ in range(rng.choice([0, 1, 3, 20])))
        assert encode(text) == library.encode(text, add_special_tokens=False).ids, repr(text)
        made.append(text)
    for some in (made, made[:7], [], [""], ["", "a", "", "b\u3000c"]):  # many at once, in windows of any size
        for window in (9, 1 << 20):
            encoder.window = window
            got = encoder.encode([t.encode() for t in some])
            assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in some]
    assert encoder.encode([b"a\xff b"])[0].tolist() == library.encode("a\ufffd b", add_special_tokens=False).ids


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_best_fit_equals_plain_loops():
    rng = random.Random(9)
    for capacity in (1, 7, 100):
        for _ in range(30):
            lengths = np.array([rng.randint(1, capacity) for _ in range(rng.randrange(1, 80))])
            bins, offsets, fill = packing.best_fit(lengths, capacity)
            assert sorted((capacity - fill).tolist()) == plain_best_fit(lengths.tolist(), capacity)
            for b in range(len(fill)):
                mine = sorted(zip(offsets[bins == b].tolist(), lengths[bins == b].tolist()))
                assert [o for o, _ in mine] == np.cumsum([0] + [n for _, n in mine])[:-1].tolist() and sum(n for _, n in mine) == fill[b]


@pytest.mark.parametrize("kind", ["mixed", "large", "small", "whole", "one"])
def test_rounds_pack_as_few_as_one_round(spark, kind):
    """Many small partitions through the tree need hardly more sequences than one best-fit over everything."""
    rng = random.Random(kind)
    draw = {"mixed": lambda: min(4096, int(rng.expovariate(1 / 700)) + 1), "large": lambda: rng.randint(2049, 4095), "small": lambda: rng.randint(1, 400), "whole": lambda: 4096, "one": lambda: 5}[kind]
    lengths = [draw() for _ in range(1 if kind == "one" else 3000)]
    made = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "row bigint, length bigint")
    s = packing.Settings(rows=600, fan=4)
    _, _, n = checked(made, packing.placed(made, s), 4096)
    alone = len(plain_best_fit(lengths, 4096))
    assert n <= alone + max(1, 0.02 * alone)
    assert n >= -(-sum(lengths) // 4096)


def test_packing_query_gives_every_token(spark, sf_dir):
    """The registered query over its table, against the library."""
    library = Tokenizer.from_file(WORDS)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = REGISTRY["op13_packing"](spark, sf_dir).collect()
    want = set()
    for i, t in texts.items():
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want |= {(i, k, s, len(ids[s : s + 4096]), zlib.crc32(np.array(ids[s : s + 4096], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 4096))}
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got} == want and len(got) == len(want)
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert all(o + n == p for (o, n), (p, _) in zip(parts, parts[1:])) and parts[0][0] == 0 and sum(parts[-1]) <= 4096
    assert len(by) <= 1 + 1.01 * sum(r["length"] for r in got) / 4096
