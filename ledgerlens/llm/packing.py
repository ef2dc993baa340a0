"""Best-fit packing by hierarchical residual rounds.

Pieces are dealt to partitions by their number, so every partition sees the same mix of lengths, and best-fit
there, longest first.  Bins that are nearly full are done.  What is underfull goes up a tree: the bins of
``fan`` partitions meet as items of another best-fit round, and so on to the root.

A partition keeps at most one bin that is half full or less, as two of them would have been merged.  Two bins beyond
a half never fit together, so in a round of ``fan`` children at most ``fan`` items can find a host, and among the
others only the ``fan`` roomiest of a child can matter: what fits into any bin fits into one of those.  A child
therefore sends at most ``fan`` + 1 bins up, whatever its size, and no merge is lost by that.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.bpe import byte_symbols
from ledgerlens.llm.common import built_once, pieces, text_bytes
from ledgerlens.operators.lookups import fits_broadcast
from ledgerlens.sources.tables import hand_over


@dataclass(frozen=True)
class Settings:
    """``rows``: pieces best-fit in one task; ``full``: a bin with less room than this is done."""

    capacity: int = 4096
    end: int = 1
    rows: int = 32_768
    fan: int = 16
    full: int = 8


# -- tokens -------------------------------------------------------------------
#: The split of the vocabulary's file.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: The same for lower-cased texts of code points below 256: white space, letters, numbers (each alone), others.
WHITE, LETTERS, NUMBERS = b" \t\n\x0b\x0c\r\x85\xa0", b"abcdefghijklmnopqrstuvwxyz\xaa\xb5\xba", b"0123456789\xb2\xb3\xb9\xbc\xbd\xbe"
CLASS = np.full(256, 3, dtype=np.uint8)
CLASS[list(WHITE)], CLASS[list(LETTERS)], CLASS[list(NUMBERS)] = 0, 1, 2
CLASS[0xDF:0xF7] = CLASS[0xF8:] = 1
BLANK = re.compile(rb"[ \x09-\x0d]")


class Kept:
    """Values by key, at most twice ``most``: the last ``most`` new ones and those asked for again since."""

    def __init__(self, most: int, make: Callable[[bytes], bytes], longest: int = 64):
        self.most, self.make, self.longest = most, make, longest
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _add(self, key: bytes) -> bytes:
        if len(key) > self.longest:
            return self.make(key)
        if (value := self.old.get(key)) is None:
            value = self.make(key)
        if len(self.young) >= self.most:
            self.young, self.old = {}, self.young
        self.young[key] = value
        return value

    def all(self, keys: list[bytes]) -> list[bytes]:
        found = list(map(self.young.get, keys))
        if None in found:
            return [self._add(k) if x is None else x for k, x in zip(keys, found)]
        return found


class WordEncoder:
    """Ids of texts by a tokenizer that never joins what ASCII white space separates: those of its words, one after the other.

    A text of code points below 256 without special tokens is lower-cased and split here, in arrays over many
    texts, and each different part is given to the tokenizer's model once; that saves most of the library's time.  The words of
    every other text are the library's.  Ids of parts and words are kept, a bounded number of each, without long ones.
    """

    def __init__(self, path: str, keep: int = 200_000, longest: int = 64, window: int = 4 << 20):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.window, self.model = window, self.tokenizer.model
        self.parts, self.words = Kept(keep, self._part, longest), Kept(keep, self._word, longest)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split_known = SPLIT in json.loads(self.tokenizer.pre_tokenizer.__getstate__())["pretokenizers"][0]["pattern"].values()
        symbols = {b: c for c, b in byte_symbols().items()}
        self.symbols = {i: "".join(symbols[b] for b in chr(i).encode()) for i in range(256)}
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def _part(self, part: bytes) -> bytes:
        packed = self.packed
        return b"".join([packed[t.id] for t in self.model.tokenize(part.decode("latin-1").translate(self.symbols))])

    def _word(self, word: bytes) -> bytes:
        return np.array(self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _narrow(self, text: bytes) -> bytes | None:
        """The text in lower case, a byte per character; None if it has wider ones, is no UTF-8, or holds a special token."""
        if not self.split_known or any(t in text for t in self.special):
            return None
        if text.isascii():
            return text.lower()
        try:
            return text.decode().lower().encode("latin-1")
        except UnicodeError:
            return None

    def _together(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each of the texts that ``_narrow`` gives."""
        ends = np.cumsum([len(t) + 1 for t in texts])
        data = np.frombuffer(b"\n".join(texts) + b"\n\n\n\n", dtype=np.uint8)
        kind = CLASS[data]
        first = kind != 0
        first[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        # An apostrophe that begins a part takes the letters of a contraction with it; the rest is a part of its own.
        at = np.flatnonzero((data == ord("'")) & first)
        a, b = data[at + 1], data[at + 2]
        two = np.isin(a, list(b"stmd"))
        three = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        at, size = at[two | three], np.where(two, 2, 3)[two | three]
        first[at + 1] = False
        first[at + size] = first[at + size] | (kind[at + size] == 1)
        solid = kind != 0
        starts = np.flatnonzero(first)
        offsets = np.append((np.cumsum(solid) - 1)[starts], solid.sum()).astype(np.int32)
        parts = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[solid])]).dictionary_encode()
        known = self.parts.all(parts.dictionary.to_pylist())
        sizes = np.array([len(x) // 4 for x in known], dtype=np.int64)
        table, where = np.frombuffer(b"".join(known), dtype="<u4"), np.cumsum(sizes) - sizes
        which = parts.indices.to_numpy()
        n = sizes[which]
        last = np.cumsum(n)
        ids = table[np.repeat(where[which] - (last - n), n) + np.arange(last[-1] if len(last) else 0)]
        return np.split(ids, np.append(0, last)[np.searchsorted(starts, ends)][:-1])

    def _windows(self, text: bytes) -> Iterator[bytes]:
        """The text cut at white space, so that a long text needs no more memory than its ids."""
        start = 0
        while len(text) - start > self.window:
            space = BLANK.search(text, start + self.window)
            end = space.end() if space else len(text)
            yield text[start:end]
            start = end
        yield text[start:] if start else text

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        waiting: list[tuple[int, int, bytes]] = []

        def flush() -> None:
            for (i, place, _), ids in zip(waiting, self._together([t for *_, t in waiting]) if waiting else ()):
                out[i][place] = ids
            waiting.clear()

        size = 0
        for i, text in enumerate(texts):
            for part in self._windows(text):
                if (low := self._narrow(part)) is None:
                    out[i].append(np.frombuffer(b"".join(self.words.all(part.split())), dtype="<u4"))
                    continue
                waiting.append((i, len(out[i]), low))
                out[i].append(np.zeros(0, dtype="<u4"))
                if (size := size + len(low)) >= self.window:
                    flush()
                    size = 0
        flush()
        return [parts[0] if len(parts) == 1 else np.concatenate(parts) for parts in out]


def encoded(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """``row`` (unique), ``key``, ``piece``, ``start``, ``length``, ``ids`` (array<int>) of each text's pieces; stored.

    A text is its ids and the end id, cut into pieces of the capacity; the last may be shorter.  NULL as an
    empty text, which is the end id alone.
    """
    s = settings
    rows = df.select(F.col(key).alias("k"), text_bytes(F.col(text)).alias("v"))
    kind = rows.schema["k"].dataType.simpleString()
    end = np.array([s.end], dtype="<u4")

    def run(batches):
        encoder = built_once(("words", vocabulary), lambda: WordEncoder(vocabulary))
        row = TaskContext.get().partitionId() << 40
        for batch in pieces(batches, "v"):
            keys, piece, ids = [], [], []
            for at, found in enumerate(encoder.encode(batch.column("v").to_pylist())):
                found = np.concatenate([found, end])
                cut = [found[i : i + s.capacity] for i in range(0, len(found), s.capacity)]
                keys += [at] * len(cut)
                piece += range(len(cut))
                ids += cut
            lengths = np.array([len(x) for x in ids], dtype=np.int64)
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            flat = np.concatenate(ids).view("<i4")
            piece = np.array(piece, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row + np.arange(len(ids))),
                    batch.column("k").take(pa.array(keys, pa.int32())),
                    pa.array(piece),
                    pa.array(piece.astype(np.int64) * s.capacity),
                    pa.array(lengths),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=["row", "k", "piece", "start", "length", "ids"],
            )
            row += len(ids)

    made = rows.mapInArrow(run, f"row bigint, k {kind}, piece int, start bigint, length bigint, ids array<int>")
    # Row numbers are fixed by storing them: later reads see the same ones.
    return hand_over(made, "pieces").withColumnRenamed("k", key)


def ids_crc32(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` and ``ids_crc32`` of the little-endian unsigned 32-bit ids."""
    rows = df.select(*columns, "ids")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    def run(batches):
        for batch in batches:
            ids = batch.column(len(columns))
            flat, at = ids.values.to_numpy(zero_copy_only=False).astype("<u4", copy=False), ids.offsets.to_numpy()
            crc = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(crc, pa.int64())], names=[*columns, "ids_crc32"])

    return rows.mapInArrow(run, f"{kinds}, ids_crc32 bigint")


# -- bins ---------------------------------------------------------------------
def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, fill of each bin: longest first, each into the open bin with the least room that is enough."""
    order = np.lexsort((np.arange(len(lengths)), -lengths))
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    fill: list[int] = []
    # Bit r of ``rooms`` is set if some bin has room r; the lowest set bit from a length on is the best fit.
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for at, n in zip(order.tolist(), lengths[order].tolist()):
        if enough := rooms >> n:
            room = n + (enough & -enough).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            b, room = len(fill), capacity
            fill.append(0)
        bins[at], offsets[at] = b, fill[b]
        fill[b] += n
        if rest := room - n:
            by_room[rest].append(b)
            rooms |= 1 << rest
    return bins, offsets, np.array(fill, dtype=np.int64)


def going_up(fill: np.ndarray, settings: Settings) -> np.ndarray:
    """Bins that meet those of other groups: the one up to half full, and the roomiest of the others."""
    room = settings.capacity - fill
    small = np.flatnonzero(2 * fill <= settings.capacity)
    large = np.flatnonzero((2 * fill > settings.capacity) & (room >= settings.full))
    large = large[np.lexsort((large, fill[large]))][: settings.fan]
    return np.concatenate([small, large])


def _round(items: DataFrame, settings: Settings, level: int) -> DataFrame:
    """``item``, ``bin``, ``at`` (place in the bin), ``fill`` (on the first item of a bin that goes up, else 0), one best-fit per ``part``."""

    def fit(key, table):
        part = key[0].as_py()
        table = table.sort_by("item")
        lengths = table["length"].to_numpy()
        bins, offsets, fill = best_fit(lengths, settings.capacity)
        up = np.zeros(len(fill), dtype=np.int64)
        chosen = going_up(fill, settings)
        up[chosen] = fill[chosen]
        # Numbers of bins: level and group above, place in the group below.
        names = (level << 56) + (part << 28) + bins
        return pa.table({"item": table["item"], "bin": names, "at": offsets, "fill": np.where(offsets == 0, up[bins], 0)})

    return items.groupBy("part").applyInArrow(fit, "item bigint, bin bigint, at bigint, fill bigint")


def placed(items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``row``, ``sequence_id``, ``offset`` of each ``row`` (unique), ``length`` (1 to the capacity).

    Items as long as the capacity are sequences of their own and meet no other.
    """
    s = settings
    whole = items.filter(F.col("length") >= s.capacity).select("row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    rest = items.filter(F.col("length") < s.capacity)
    parts = max(1, -(-rest.count() // s.rows))
    dealt = rest.select(F.col("row").alias("item"), "length", F.pmod(F.xxhash64("row"), F.lit(parts)).alias("part"))
    first = hand_over(_round(dealt, s, 0), "bins")
    # From each round the bins that go up, as items of the next; a tree of ``fan`` children down to one root.
    moves, level, up = [], 0, first
    while parts > 1:
        level, parts = level + 1, -(-parts // s.fan)
        part = F.floor(F.shiftright("bin", 28).bitwiseAND((1 << 28) - 1) / s.fan)
        up = hand_over(_round(up.filter("fill > 0").select(F.col("bin").alias("item"), F.col("fill").alias("length"), part.alias("part")), s, level), "bins")
        moves.append(up)
    place = first.select(F.col("item").alias("row"), F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    if moves:
        # Where each bin that went up has ended, from the root down: a bin's place is that of its bin plus its own in it.
        final = moves[-1].select("item", "bin", "at")
        for move in reversed(moves[:-1]):
            later = final.select(F.col("item").alias("bin"), F.col("bin").alias("top"), F.col("at").alias("more"))
            final = move.join(later, "bin", "left").select("item", F.coalesce("top", "bin").alias("bin"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at"))
        final = hand_over(final.select(F.col("item").alias("sequence_id"), F.col("bin").alias("top"), F.col("at").alias("more")), "moved_bins")
        small = F.broadcast(final) if fits_broadcast(final)[0] else final
        place = place.join(small, "sequence_id", "left")
        place = place.select("row", F.coalesce("top", "sequence_id").alias("sequence_id"), (F.col("offset") + F.coalesce("more", F.lit(0))).alias("offset"))
    return place.unionByName(whole)


def pack(df: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """The texts' pieces with their ids (see ``encoded``), and the place of each (see ``placed``); both by ``row``.

    Every row of the table is a text of its own, repeated ones too; a NULL key is carried along, a NULL or
    empty text is the end id alone; texts of any length are cut, never shortened; an empty table gives empty results;
    equal lengths are taken in the order of their rows; other columns, whatever their names, are not read.
    """
    made = encoded(df, vocabulary, key, text, settings)
    return made, placed(made.select("row", "length"), settings)


def sequences(made: DataFrame, places: DataFrame) -> DataFrame:
    """``sequence_id``, ``ids`` (array<int>): the packed sequences themselves; a sequence holds at most the capacity."""
    joined = made.select("row", "ids").join(places, "row")
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))

