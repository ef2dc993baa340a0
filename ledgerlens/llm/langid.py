"""Language identification by error-correcting output codes.

Every language has a codeword; for each bit a binary classifier over byte n-grams separates the
languages whose codeword has a 1 from those that have a 0.  The classifiers are log-odds of hashed
n-gram shares, learned from counts over all labelled texts; their size is fixed by the number of bits.
Decoding sums the loss of each bit's margin against every codeword, weighted by how well
the bit separates, and takes the codeword of least loss; a small lead over the next is ambiguous.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Shared, pieces, text_bytes
from ledgerlens.sources.tables import hand_over

GRAM, SLOTS_LOG2 = 3, 16
SLOTS = 1 << SLOTS_LOG2
BLOCK = 1 << 20
UNKNOWN = "und"
#: Least lead of the best language over the next, as a share of the lead that typical texts have.
LEAST_LEAD = 0.05
#: A-Z in lower case, other signs of ASCII as spaces, bytes of other characters as they are.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LETTER = regex.compile(r"\p{L}")
PREDICTION = "lang string, score double, ambiguous boolean"


def gram_slots(data: bytes):
    """Slots of the n-grams of folded text, block by block; grams of spaces only are in slot 0 and count nothing."""
    folded = np.frombuffer(b" " + data.translate(FOLD) + b" ", dtype=np.uint8)
    for i in range(0, len(folded) - GRAM + 1, BLOCK):
        b = folded[i : i + BLOCK + GRAM - 1].astype(np.uint32)
        code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        code -= np.uint32(0x202020)
        code *= np.uint32(0x9E3779B1)
        yield code >> np.uint32(32 - SLOTS_LOG2)


def codewords(languages: int) -> np.ndarray:
    """Rows of +1 and -1.  Up to seven languages: every way to part them; more: 10 log2 columns, chosen by a greedy search."""
    if languages < 2:
        return np.ones((languages, 0), dtype=np.int8)
    if languages <= 7:
        columns = [(1, *c) for c in product((1, -1), repeat=languages - 1) if -1 in c]
        return np.array(columns, dtype=np.int8).T
    rng, best, least = np.random.default_rng(7), None, -1
    bits = int(np.ceil(10 * np.log2(languages)))
    for _ in range(64):
        code = rng.choice(np.array([1, -1], dtype=np.int8), size=(languages, bits))
        agree = code.astype(np.int32) @ code.T
        np.fill_diagonal(agree, -bits)
        near = int((bits - agree.max()) // 2)
        if near > least and (np.abs(code.sum(axis=0)) < languages).all():
            best, least = code, near
    return best


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``lang``, ``slot``, ``n`` over all rows of ``lang``, ``v`` (bytes)."""

    def run(batches):
        held: dict[str, np.ndarray] = {}

        def rows():
            for lang, counts in held.items():
                at = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(at), "slot": at.astype(np.int32), "n": counts[at]})
            held.clear()

        for batch in pieces(batches, "v"):
            for lang, v in zip(batch.column("lang").to_pylist(), batch.column("v").to_pylist()):
                if lang not in held and len(held) == 64:
                    yield from rows()
                counts = held.setdefault(lang, np.zeros(SLOTS, dtype=np.int64))
                for slots in gram_slots(v):
                    counts += np.bincount(slots, minlength=SLOTS)
        yield from rows()

    made = labelled.mapInArrow(run, "lang string, slot int, n bigint").filter("slot > 0")
    return made.groupBy("lang", "slot").agg(F.sum("n").alias("n"))


def fit(df: DataFrame, text: str = "text", lang: str = "lang") -> dict:
    """Learn from all rows with a language; one pass over the texts.

    Every language counts alike, however many texts it has.  What reaches the driver is a row per
    slot with one number per bit, and the names of the languages.
    """
    labelled = df.select(F.col(lang).alias("lang"), text_bytes(F.col(text)).alias("v")).filter("lang is not null")
    counts = hand_over(gram_counts(labelled), "gram_counts")
    totals = hand_over(counts.groupBy("lang").agg(F.sum("n").alias("total")), "gram_totals")
    languages = sorted(r["lang"] for r in totals.select("lang").collect())
    code = codewords(len(languages))
    if not code.shape[1]:
        return {"languages": languages, "code": code}
    spark = df.sparkSession
    ones = spark.createDataFrame([(x, [bool(b > 0) for b in row]) for x, row in zip(languages, code)], "lang string, bits array<boolean>")
    shares = counts.join(totals.join(ones, "lang"), "lang").withColumn("share", F.col("n") / F.col("total"))
    sums = [F.sum(F.when(F.col("bits")[b], F.col("share")).otherwise(0.0)).alias(f"b{b}") for b in range(code.shape[1])]
    found = shares.groupBy("slot").agg(F.sum("share").alias("all"), *sums).toPandas()
    shared = np.zeros((SLOTS, code.shape[1] + 1))
    shared[found["slot"]] = found[["all", *(f"b{b}" for b in range(code.shape[1]))]]
    positive, all_ = shared[:, 1:], shared[:, :1]
    sizes = (code > 0).sum(axis=0)
    floor = 1e-7
    p = positive / sizes + floor
    q = (all_ - positive) / (len(languages) - sizes) + floor
    weights = np.log(p / q)
    weights[0] = 0
    high, low = (p * weights).sum(axis=0), (q * weights).sum(axis=0)
    # A typical text of a side has margin +1 or -1.
    scale, middle = 2 / np.maximum(high - low, 1e-9), (high + low) / 2
    trust = (high - low) / (high - low).sum()
    return {"languages": languages, "code": code, "weights": weights.astype(np.float32), "scale": scale, "middle": middle, "trust": trust}


class Decoder:
    def __init__(self, model: dict):
        self.model = model

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, its share of confidence, ambiguous; UNKNOWN, 0 for NULL, without a letter, or with nothing learned."""
        m = self.model
        if not text or not m["languages"] or not LETTER.search(text):
            return UNKNOWN, 0.0, True
        if len(m["languages"]) == 1:
            return m["languages"][0], 1.0, False
        sums, n = np.zeros(m["code"].shape[1]), 0
        for slots in gram_slots(text.encode()):
            for i in range(0, len(slots), 1 << 16):
                part = slots[i : i + (1 << 16)]
                sums += m["weights"][part].sum(axis=0, dtype=np.float64)
                n += np.count_nonzero(part)
        margin = (sums / max(n, 1) - m["middle"]) * m["scale"]
        losses = np.log1p(np.exp(-np.clip(4 * m["code"] * margin, -50, 50))) @ m["trust"]
        first, second = np.argsort(losses, kind="stable")[:2]
        odds = np.exp(-8 * (losses - losses[first]))
        lead = float(losses[second] - losses[first])
        return m["languages"][first], float(1 / odds.sum()), lead < LEAST_LEAD


def predictor(df: DataFrame, model: dict):
    """A column function ``text -> struct(lang, score, ambiguous)``."""
    shared = Shared(df.sparkSession, model)

    @F.pandas_udf(PREDICTION)
    def run(texts: pd.Series) -> pd.DataFrame:
        decoder = shared.built(Decoder)
        return pd.DataFrame([decoder.predict(t) for t in texts], columns=["lang", "score", "ambiguous"])

    return run


def identify(df: DataFrame, learn: Column, text: str = "text", lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """One row per input row: ``key``, ``lang_pred``, ``score``, ``ambiguous``.

    Learned from the rows where ``learn`` holds and the language is not NULL; the prediction sees the text
    only.  NULL, empty and letterless texts are UNKNOWN with score 0, all texts if no row has a
    language; ties go to the first language in code point order; repeated rows are predicted alike;
    an empty table gives an empty result; other columns are not read.
    """
    model = fit(df.filter(learn), text, lang)
    said = predictor(df, model)(F.col(text).cast("string"))
    rows = df.select(F.col(key), said.alias("_said"))
    return rows.select(key, F.col("_said.lang").alias("lang_pred"), F.col("_said.score").alias("score"), F.col("_said.ambiguous").alias("ambiguous"))
