"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

Merging by rank can change what is left of a byte only through a chain of merges of falling rank
that starts right of it.  ``Merges.lookahead`` is the length of the longest such chain in bytes:
a token boundary that many bytes before the end of what has been read is final, whatever follows.
So a piece of any length is encoded in windows: merge the window, emit the tokens before the last
final boundary, keep the rest.  Memory does not grow with the text.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm.common import Shared, pieces, text_bytes

WINDOW_BYTES = 1024
TEXT_WINDOW = 1 << 16
CACHED_PIECES = 1 << 18


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in plain}
    return out | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}


SPACES = frozenset(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def character_classes(library: Tokenizer) -> tuple[str, str, str]:
    """Letters, numbers, and what Python's own classes see differently, as regular-expression ranges.

    Letters and numbers are those of the tokenizers library.  Two other Unicode tables agree on
    nearly all characters; where they differ, the library's own splitting of a letter or digit
    followed by the character decides.
    """
    letter, number = regex.compile(r"\p{L}"), regex.compile(r"\p{N}")
    alone = lambda text: len(library.pre_tokenizer.pre_tokenize_str(text)) == 1
    classes: dict[str, list[list[int]]] = {"L": [], "N": [], "odd": []}

    def add(kind, i):
        ranges = classes[kind]
        if ranges and ranges[-1][1] == i - 1:
            ranges[-1][1] = i
        else:
            ranges.append([i, i])

    for i in range(0x110000):
        if 0xD800 <= i < 0xE000:
            continue
        c = chr(i)
        kind = unicodedata.category(c)[0]
        if kind != "L" and kind != "N":
            kind = "O"
        other = "L" if letter.match(c) else "N" if number.match(c) else "O"
        if kind != other:
            kind = "L" if alone("a" + c) else "N" if alone("1" + c) else "O"
        if kind != "O":
            add(kind, i)
        elif c in SPACES:
            kind = "S"
        if kind != ("S" if c.isspace() else "N" if c.isdecimal() else "L" if c.isalnum() else "O"):
            add("odd", i)
    # A class with one range beyond the basic plane is searched much faster than one with many.
    classes["odd"] = [x for x in classes["odd"] if x[0] < 0x10000] + [[0x10000, 0x10FFFF]]
    letters, numbers, odd = ("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in x) for x in classes.values())
    return letters, numbers, odd


def split_patterns(letters: str, numbers: str, odd: str) -> dict[str, str]:
    """The split of GPT-2: contractions, then runs of letters, numbers, other signs, white space.

    ``quick`` says the same in Python's own classes, for texts without a character of ``odd``.
    """
    space = "".join(f"\\U{ord(c):08x}" for c in sorted(SPACES))
    ends = "'s|'t|'re|'ve|'m|'ll|'d"
    return {
        "full": rf"{ends}| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+",
        "quick": rf"{ends}| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+",
        "odd": f"[{odd}]",
    }


@lru_cache(maxsize=4)
def load(path: str) -> dict:
    """What the executors need of a vocabulary file, with a size bound by that file's."""
    model = json.load(open(path, encoding="utf-8"))
    symbols = byte_symbols()
    raw = lambda token: bytes(symbols[c] for c in token)
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["model"]["merges"]]
    vocabulary = model["model"]["vocab"]
    library = Tokenizer.from_file(path)
    return {
        "tokens": {i: raw(t) for t, i in vocabulary.items()} | {a["id"]: a["content"].encode() for a in model["added_tokens"]},
        "merges": [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges],
        "added": {a["content"]: a["id"] for a in model["added_tokens"]},
        "bytes": {symbols[t]: i for t, i in vocabulary.items() if len(t) == 1},
        "patterns": split_patterns(*character_classes(library)),
    }


class Merges:
    """A merge list over token ids: the merging of a window and the lookahead that makes it final."""

    def __init__(self, model: dict):
        self.size = {i: len(t) for i, t in model["tokens"].items()}
        self.first = [model["bytes"][b] for b in range(256)]
        #: (left, right) -> (rank, merged); a rank decides before the id does.
        self.rules = {}
        for rank, (a, b, c) in enumerate(model["merges"]):
            self.rules.setdefault((a, b), (rank, c))
        self.lookahead = self._lookahead(model["merges"])

    def _lookahead(self, merges) -> int:
        made: dict[int, list[tuple[int, int]]] = {}  # token -> ranks at which it is made, with its right part
        after: dict[int, tuple[list[int], list[int]]] = {}  # left token -> ranks, longest reach up to that rank

        def reach(token: int, limit: int) -> int:
            """Bytes right of ``token`` that decide whether its right end lasts until rank ``limit``."""
            best = 0
            if token in after:
                ranks, longest = after[token]
                if i := bisect_left(ranks, limit):
                    best = longest[i - 1]
            for rank, part in made.get(token, ()):
                # The right part ends where the token ends, and stands there until the token is made.
                best = max(best, reach(part, min(limit, rank)))
            return best

        for rank, (a, b, c) in enumerate(merges):
            far = self.size[b] + reach(b, rank)
            ranks, longest = after.setdefault(a, ([], []))
            ranks.append(rank)
            longest.append(max(far, longest[-1]) if longest else far)
            made.setdefault(c, []).append((rank, b))
        return max((reach(t, len(merges)) for t in [*self.first, *made]), default=0)

    def merge(self, data: bytes) -> list[int]:
        """Tokens of a whole window: always the pair of least rank, leftmost first."""
        ids = [self.first[b] for b in data]
        return self._few(ids) if len(ids) <= 48 else self._many(ids)

    def _few(self, ids: list[int]) -> list[int]:
        get = self.rules.get
        rules = [get(p) for p in zip(ids, ids[1:])]
        while True:
            best, at = None, -1
            for i, r in enumerate(rules):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return ids
            ids[at : at + 2] = [best[1]]
            rules[at : at + 1] = []
            if at:
                rules[at - 1] = get((ids[at - 1], ids[at]))
            if at < len(rules):
                rules[at] = get((ids[at], ids[at + 1]))

    def _many(self, ids: list[int]) -> list[int]:
        """The same with a queue of candidates over a linked list."""
        n, get = len(ids), self.rules.get
        right, left = [*range(1, n), -1], [-1, *range(n - 1)]
        queue = [(r[0], i, r[1], ids[i], ids[i + 1]) for i in range(n - 1) if (r := get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        while queue:
            _, i, merged, a, b = heapq.heappop(queue)
            j = right[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = merged, -1
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
                if r := get((merged, ids[right[i]])):
                    heapq.heappush(queue, (r[0], i, r[1], merged, ids[right[i]]))
            if left[i] >= 0 and (r := get((ids[left[i]], merged))):
                heapq.heappush(queue, (r[0], left[i], r[1], ids[left[i]], merged))
        return [t for t in ids if t >= 0]

    def stream(self, blocks: Iterable[bytes], window: int = WINDOW_BYTES) -> Iterator[list[int]]:
        """Tokens of the bytes in ``blocks``, each given out as soon as nothing that follows can change it."""
        held = b""
        for block in blocks:
            held += block
            while len(held) >= window + self.lookahead:
                ids, final, at = self.merge(held[: window + self.lookahead]), 0, 0
                for k, t in enumerate(ids):
                    if (at := at + self.size[t]) > window:
                        break
                    final, end = k + 1, at
                if not final:  # a token longer than the window
                    window *= 2
                    continue
                yield ids[:final]
                held = held[end:]
        if held:
            yield self.merge(held)


class Encoder:
    """Texts to ids: added tokens, then the split, then the transducer; short pieces are remembered."""

    def __init__(self, model: dict, cached: int = CACHED_PIECES):
        self.merges, self.added, self.cached = Merges(model), model["added"], cached
        self.full, self.quick, self.odd = (re.compile(model["patterns"][k]) for k in ("full", "quick", "odd"))
        self.marks = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.known: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def _new(self, piece: str) -> tuple[int, ...]:
        """Ids of a piece that is not among the remembered ones; those are two generations of bounded size."""
        ids = self.older.get(piece)
        if ids is None:
            data = piece.encode()
            ids = tuple(t for part in self.merges.stream([data]) for t in part)
            if len(data) > 64:
                return ids
        if len(self.known) >= self.cached:
            self.older, self.known = self.known, {}
        self.known[piece] = ids
        return ids

    def _plain(self, text: str) -> Iterator[list[int]]:
        """Ids of a text without added tokens, window by window.

        A match that ends three characters before the end of a window is the same in the whole
        text: no alternative looks further than that beyond what it takes.
        """
        at, n = 0, len(text)
        pattern = self.full if self.odd.search(text) else self.quick
        while at < n:
            end = min(at + TEXT_WINDOW, n)
            found = pattern.findall(text, at, end)
            if end < n:
                while found and end > min(at + TEXT_WINDOW, n) - 3:
                    end -= len(found.pop())
            if not found:  # a piece longer than the window
                end = pattern.match(text, at).end()
                yield from self.merges.stream(text[i : min(i + 4096, end)].encode() for i in range(at, end, 4096))
            else:
                ids: list[int] = []
                known = self.known
                for piece in found:
                    got = known.get(piece)
                    if got is None:
                        got = self._new(piece)
                        known = self.known
                    ids += got
                yield ids
            at = end

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of a text in lists of bounded length."""
        at = 0
        for mark in self.marks.finditer(text) if self.marks else ():
            yield from self._plain(text[at : mark.start()])
            yield [self.added[mark.group()]]
            at = mark.end()
        yield from self._plain(text[at:] if at else text)


class Decoder:
    """Ids to text: a UTF-8 state machine that carries an unfinished character from one list to the next."""

    def __init__(self, model: dict):
        self.tokens = model["tokens"]

    def decode(self, parts: Iterable[list[int]]) -> Iterator[str]:
        tokens, state = self.tokens, codecs.getincrementaldecoder("utf-8")("replace")
        for ids in parts:
            yield state.decode(b"".join([tokens[i] for i in ids]))
        yield state.decode(b"", True)


class Codec:
    """Encoder and decoder of one vocabulary, as built in a worker."""

    def __init__(self, model: dict):
        self.encoder, self.decoder = Encoder(model), Decoder(model)
        self.names = {i: str(i) for i in model["tokens"]}

    def ids(self, text: bytes) -> list[int]:
        return [t for part in self.encoder.encode(text.decode("utf-8", "replace")) for t in part]

    def text(self, ids: list[int]) -> str:
        return "".join(self.decoder.decode([ids]))

    def digests(self, text: bytes) -> tuple[int, str, str]:
        """Tokens, digest of the ids, digest of what they decode to; no list of the whole text is made."""
        count, id_hash, text_hash, names = 0, hashlib.sha256(), hashlib.sha256(), self.names

        def seen():
            nonlocal count
            for part in self.encoder.encode(text.decode("utf-8", "replace")):
                if part:
                    id_hash.update((("," if count else "") + ",".join([names[i] for i in part])).encode())
                    count += len(part)
                    yield part

        for piece in self.decoder.decode(seen()):
            text_hash.update(piece.encode())
        return count, id_hash.hexdigest(), text_hash.hexdigest()


def _each(df: DataFrame, path: str, key: str, column, schema: str, make) -> DataFrame:
    """``make(codec, value)`` for each row, beside the key."""
    model = Shared(df.sparkSession, load(path))
    names = [c.split(" ")[0] for c in schema.split(", ")]
    rows = df.select(F.col(key).alias("k"), column.alias("v"))
    binary = dict(rows.dtypes)["v"] == "binary"

    def run(batches):
        codec = model.built(Codec)
        for batch in pieces(batches, "v") if binary else batches:
            made = [make(codec, v) for v in batch.column("v").to_pylist()]
            columns = zip(*made) if made else [()] * len(names)
            out = pa.schema([(n, kinds[n]) for n in names])
            arrays = [pa.array(list(c), out.field(n).type) for n, c in zip(names, columns)]
            yield pa.RecordBatch.from_arrays([batch.column("k"), *arrays], names=["k", *names])

    kinds = {"n_tokens": pa.int64(), "token_ids": pa.list_(pa.int32()), "text": pa.string()}
    kinds |= {"ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    kind = rows.schema["k"].dataType.simpleString()
    return rows.mapInArrow(run, f"k {kind}, {schema}").withColumnRenamed("k", key)


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``key``, ``token_ids``.  A NULL or empty text has no ids."""
    return _each(df, path, key, text_bytes(F.col(text)), "token_ids array<int>", lambda c, v: (c.ids(v),))


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "token_ids") -> DataFrame:
    """One row per input row: ``key``, ``text``.  NULL ids count as none; bytes that are not UTF-8 become U+FFFD."""
    empty = F.array().cast("array<int>")
    return _each(df, path, key, F.coalesce(F.col(ids), empty), "text string", lambda c, v: (c.text(v),))


def round_trip(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode and decode every text in one pass: ``key``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    Row by row, without a shuffle: NULL as an empty text (no ids), repeated rows each for
    themselves, an empty table gives an empty result, other columns are not read.
    """
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _each(df, path, key, text_bytes(F.col(text)), schema, lambda c, v: c.digests(v))
