"""Language-model scoring with a weighted backoff automaton.

States are the contexts of the training texts: the empty one, words, and pairs of words.  An arc leads from a context by a word
to the longest context that is left, at the log10 of the word's probability; a failure arc leads to the context without its
first word, at the log10 of the backoff weight.  A text is scored by the states and arcs of one traversal from left to right; all
texts of a block are traversed at once, by composing what their words do to the state.

The probabilities are smoothed by a prior: p(w | ab) = (n(abw) + m p(w | b)) / (n(ab) + m), and so on down to single words,
whose probability is the base score's.  So m / (n(ab) + m) is the backoff weight, and an automaton needs nothing but counts.

No n-gram of the texts is left out, and no task holds them all.  Texts are cut into blocks.  A block sends each of its
different n-grams once, with its count in the block's training texts, to the part that the n-gram belongs to; a part adds up
and answers each block in the order of its questions; a block then has all counts that its texts can touch, and builds the
states and arcs of the automaton that they can reach.  Parts are chosen by an n-gram's rarest word, and by all its words if that
one is frequent, so that no word and no context is a hot key.  Numbers of the most frequent words are broadcast; other words
are told apart by 62 bits of their hash.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import Shared, pieces, text_bytes, words
from ledgerlens.sources.tables import hand_over

#: The end of a text; words have no white space.
END = b"\n"
FLUSH_WORDS = 200_000
SEED = 42


@dataclass(frozen=True)
class Settings:
    """``prior`` of pairs and of triples; words with a number at most; tokens of a block and bytes of text of a part, about."""

    prior: tuple[float, float] = (64.0, 8.0)
    named: int = 1 << 17
    block: int = 400_000
    part: int = 8 << 20
    #: An n-gram whose words all have lower numbers than this, or than the parts, belongs to a part by all its words.
    spread: int = 4096
    #: Bytes of messages that go from a Python worker to Spark at once, about.
    send: int = 1 << 20


def word_counts(texts: DataFrame) -> DataFrame:
    """``token``, ``n`` over all rows of ``v`` (bytes), the end of each text included."""

    def run(batches):
        held: Counter[bytes] = Counter()

        def rows():
            out = pa.RecordBatch.from_pydict({"token": pa.array(list(held), pa.binary()), "n": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return out

        for batch in pieces(batches, "v"):
            for v in batch.column("v").to_pylist():
                held.update(words(v))
                held[END] += 1
            if len(held) >= FLUSH_WORDS:
                yield rows()
        if held:
            yield rows()

    return texts.select("v").mapInArrow(run, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


def level(n: str = "n") -> Column:
    """Counts in steps of an eighth of a power of two."""
    return F.floor(F.log2(n) * 8).cast("int")


def threshold(counts: DataFrame, most: int) -> int:
    """The lowest level at which at most ``most`` rows are at it or above; a row per level is collected."""
    total, at = 0, 1 << 20
    for r in counts.groupBy(level().alias("level")).agg(F.count("*").alias("rows")).orderBy(F.desc("level")).collect():
        total += r["rows"]
        if total > most:
            break
        at = r["level"]
    return at


def fit_words(texts: DataFrame, settings: Settings) -> dict:
    """The frequent words in order of their counts, their counts, and of all words the total and the number of types."""
    counts = hand_over(word_counts(texts), "word_counts")
    total, types = counts.agg(F.sum("n"), F.count("*")).first()
    most = counts.filter(level() >= threshold(counts, settings.named)).select("token", "n").toArrow()
    rows = sorted(zip(*(c.to_pylist() for c in most.columns)), key=lambda r: (-r[1], r[0]))
    return {"words": [w for w, _ in rows], "counts": [n for _, n in rows], "total": total or 0, "types": types}


# -- arrays as bytes -------------------------------------------------------------
_ZSTD = pa.Codec("zstd", compression_level=1)


def pack(arrays: list[np.ndarray]) -> bytes:
    """Arrays of numbers not below zero; bytes of one place value lie together, and the whole is compressed."""
    wide = [max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 1 for a in arrays]
    planes = [np.ascontiguousarray(a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T).tobytes() for a, w in zip(arrays, wide)]
    head = np.array([len(arrays), *(x for a, w in zip(arrays, wide) for x in (len(a), w))], dtype="<i8").tobytes()
    body = head + b"".join(planes)
    return len(body).to_bytes(8, "little") + _ZSTD.compress(body, asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    body = _ZSTD.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    head = np.frombuffer(body, "<i8", 1 + 2 * int.from_bytes(body[:8], "little"))
    out, at = [], 8 * len(head)
    for n, w in head[1:].reshape(-1, 2).tolist():
        full = np.zeros((n, 8), np.uint8)
        full[:, :w] = np.frombuffer(body, np.uint8, n * w, at).reshape(w, n).T
        out.append(full.reshape(-1).view("<i8"))
        at += n * w
    return out


def steps(a: np.ndarray) -> np.ndarray:
    """Differences of a rising array, the first from zero."""
    return np.diff(a, prepend=0)


def width(a: np.ndarray) -> int:
    """Bytes that the numbers of an array need."""
    return max(1, (int(a.max(initial=0)).bit_length() + 7) // 8)


def planes(columns: list[np.ndarray], widths: list[int]) -> np.ndarray:
    """The lowest bytes of each column's whole numbers, a row for each place value.

    (Parts of the rows are copied before they become bytes: ``tobytes`` of an array with gaps goes element by element.)
    """
    out = np.empty((sum(widths), len(columns[0])), np.uint8)
    rows = iter(out)
    for c, w in zip(columns, widths):
        places = np.ascontiguousarray(c, dtype=c.dtype.newbyteorder("<")).view(np.uint8).reshape(len(c), c.itemsize)
        for k in range(w):
            next(rows)[:] = places[:, k]
    return out


def joined(rows: list[np.ndarray], kind: str) -> np.ndarray:
    """Numbers of a kind from their bytes, which come place value by place value."""
    places = np.zeros((len(rows[0]), np.dtype(kind).itemsize), np.uint8)
    for k, row in enumerate(rows):
        places[:, k] = row
    return places.reshape(-1).view(kind)


def squeezed(body: bytes) -> bytes:
    return len(body).to_bytes(8, "little") + _ZSTD.compress(body, asbytes=True)


def opened(data: bytes) -> np.ndarray:
    return np.frombuffer(_ZSTD.decompress(data[8:], int.from_bytes(data[:8], "little")), np.uint8)


def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers of an array (none below zero) in rising order, and for each place which of them stands there.

    Where a number and its place fit 63 bits, they are sorted as one number, which takes half the time of sorting places.
    """
    bits = len(key).bit_length()
    if not len(key) or int(key.max()).bit_length() + bits > 63:
        return np.unique(key, return_inverse=True)
    both = key << bits
    both |= np.arange(len(key))
    both.sort()
    place = both & ((1 << bits) - 1)
    both >>= bits
    new = np.ones(len(key), bool)
    np.not_equal(both[1:], both[:-1], out=new[1:])
    rank = np.empty(len(key), np.int64)
    rank[place] = np.cumsum(new) - 1
    return both[new], rank


# -- blocks ----------------------------------------------------------------------
class Block:
    """Texts as word codes, and their different n-grams: words, then pairs, then triples, each kind in rising order.

    ``first``, ``second``, ``third`` are words of the block (-1: none).  A text's n-grams lie within the text and its end.
    """

    def __init__(self, names: np.ndarray, at: np.ndarray, lengths: np.ndarray):
        self.names, self.at, self.lengths = names, at, lengths
        w, ends = len(names), np.cumsum(lengths)
        bits = w.bit_length()
        follows = np.ones(len(at), bool)
        follows[ends - 1] = False
        x = np.flatnonzero(follows)
        follows[ends[lengths > 1] - 2] = False
        y = np.flatnonzero(follows)
        self.pairs, pair = ranked(at[x] << bits | at[x + 1])
        pair_at = np.full(len(at), -1)
        pair_at[x] = pair
        triples, triple = ranked(pair_at[y] << bits | at[y + 2])
        #: Of each triple its first pair, and its last.
        self.before, self.after = triples >> bits, np.zeros(len(triples), np.int64)
        self.after[triple] = pair_at[y + 1]
        small, last = np.int32, (1 << bits) - 1
        a, b = (self.pairs >> bits).astype(small), (self.pairs & last).astype(small)
        self.first = np.concatenate([np.arange(w, dtype=small), a, a[self.before]])
        self.second = np.concatenate([np.full(w, -1, small), b, b[self.before]])
        self.third = np.concatenate([np.full(w + len(a), -1, small), (triples & last).astype(small)])
        self.places = [(np.arange(len(at)), at), (x, w + pair), (y, w + len(a) + triple)]

    def grams_at(self) -> list[np.ndarray]:
        """For each token the word, the pair and the triple that end there; -1 where a text has not enough words before it."""
        found = np.full((3, len(self.at)), -1)
        for k, (x, gram) in enumerate(self.places):
            found[k, x + k] = gram
        return list(found)

    def counts(self, learned: np.ndarray) -> np.ndarray:
        """How often each n-gram stands in the texts that are learned from."""
        of = np.repeat(learned, self.lengths)
        return sum(np.bincount(gram[of[x]], minlength=len(self.first)) for x, gram in self.places)

    def asked(self, named: int, spread: int, parts: int) -> list[tuple[int, np.ndarray]]:
        """Parts, and the n-grams each is asked for, in rising order; words with a number are known."""
        columns = self.first, self.second, self.third
        rarest = np.maximum(np.maximum(*columns[:2]), columns[2])
        part = (mixed(self.names) % np.uint64(parts))[rarest]
        whole = np.flatnonzero(rarest < np.searchsorted(self.names, spread))
        if len(whole):
            a, b, c = (np.where(x[whole] < 0, -1, self.names[x[whole]]) for x in columns)
            part[whole] = mixed(c, mixed(b, mixed(a))) % np.uint64(parts)
        # Words with a number go last, beyond all parts.
        part[: len(self.names)][self.names < named] = parts
        order = np.argsort(part.astype(np.uint16 if parts < 1 << 16 else np.uint64), kind="stable")
        cuts = np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
        return [(p, order[cuts[p] : cuts[p + 1]]) for p in range(parts) if cuts[p] < cuts[p + 1]]

    def questions(self, asked: list[tuple[int, np.ndarray]], n: np.ndarray, named: int) -> Iterator[tuple[int, bytes]]:
        """For each part its n-grams with their counts: words above all numbers in a table of their own, numbered on.

        All parts' numbers are found together, so that a question costs little more than its bytes, however many parts there are.
        """
        if not asked:
            return
        known, bits = int(np.searchsorted(self.names, named)), len(self.names).bit_length()
        sizes, grams = np.array([len(g) for _, g in asked]), np.concatenate([g for _, g in asked])
        ends, of = np.cumsum(sizes), np.repeat(np.arange(len(asked)), sizes)
        columns = [c[grams] for c in (self.first, self.second, self.third)]
        high = [np.flatnonzero(c >= known) for c in columns]
        rare, rank = ranked(np.concatenate([of[h] << bits | c[h] for h, c in zip(high, columns)]))
        rare_ends = np.searchsorted(rare >> bits, np.arange(len(asked)), "right")
        # None is 0, the words follow.
        table, less = np.zeros(len(self.names) + 1, np.uint32), named + 1 - np.concatenate([[0], rare_ends])
        table[:known] = self.names[:known] + 1
        numbers = [table[c] for c in columns]
        for h, number, r in zip(high, numbers, np.split(rank, np.cumsum([len(h) for h in high])[:-1])):
            number[h] = r + less[of[h]]
        # First words rise within a part but for the changes of kind; steps are told modulo a power of two.
        firsts, counts = numbers[0][ends - sizes], n[grams]
        numbers[0] = np.diff(numbers[0], prepend=np.uint32(0))
        wide = width(np.array([named + 1 + np.diff(rare_ends, prepend=0).max()]))
        widths = [wide, wide, wide, width(counts)]
        told = planes([*numbers, counts], widths)
        names = planes([self.names[rare & ((1 << bits) - 1)]], [8])
        for (part, _), size, first, end, low, top in zip(asked, sizes, firsts, ends, [0, *rare_ends], rare_ends):
            head = np.array([size, top - low, first, wide, widths[-1]], "<i8").tobytes()
            yield part, squeezed(head + names[:, low:top].copy().tobytes() + told[:, end - size : end].copy().tobytes())


def mixed(code: np.ndarray, seed: np.ndarray | np.uint64 = np.uint64(0)) -> np.ndarray:
    """A 64-bit hash of whole numbers, on top of another."""
    x = (code.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15)) ^ seed
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


def read_questions(questions: list[bytes], named: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray, list[int]]:
    """The tables of words above all numbers, one after the other; first, second and third word of each n-gram (-1: none; from
    ``named`` upwards: places in the tables); their counts; and how many n-grams each question has."""
    bodies = [opened(q) for q in questions]
    heads = np.array([np.frombuffer(b, "<i8", 5) for b in bodies])
    sizes, rare, starts = heads[:, :3].T
    # All questions' bytes in one table, by place value, so that numbers are put together once and not question by question.
    told, names, at, low = np.zeros((16, sizes.sum()), np.uint8), np.empty((8, rare.sum()), np.uint8), 0, 0
    for body, (size, some, _, wide, counts) in zip(bodies, heads.tolist()):
        names[:, low : low + some] = body[40 : 40 + 8 * some].reshape(8, some)
        rows = body[40 + 8 * some :].reshape(3 * wide + counts, size)
        for k in range(3):
            told[4 * k : 4 * k + wide, at : at + size] = rows[k * wide : (k + 1) * wide]
        told[12 : 12 + counts, at : at + size] = rows[3 * wide :]
        at, low = at + size, low + some
    first, second, third, n = (joined(list(told[4 * k : 4 * k + 4]), "<u4") for k in range(4))
    first = np.cumsum(first, dtype=np.uint32)
    first += np.repeat(starts.astype(np.uint32) - first[np.cumsum(sizes) - sizes], sizes)
    first &= np.repeat(((1 << 8 * heads[:, 3]) - 1).astype(np.uint32), sizes)
    before = np.repeat(np.cumsum(rare) - rare, sizes)
    words = [c.astype(np.int64) - 1 + np.where(c > named, before, 0) for c in (first, second, third)]
    return joined(list(names), "<i8"), words, n, sizes.tolist()


def read_question(data: bytes, named: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``first``, ``second``, ``third`` of one question as codes (-1: none) and counts."""
    rare, words, n, _ = read_questions([data], named)
    codes = np.concatenate([np.arange(named), rare, [-1]])
    return *(codes[w] for w in words), n


def answers(questions: list[bytes], named: int) -> list[bytes]:
    """For each question the sums of its n-grams' counts over all of them."""
    rare, words, n, sizes = read_questions(questions, named)
    # Equal words of the tables get one number, from ``named`` upwards.
    codes = np.concatenate([np.arange(named), named + ranked(rare)[1], [-1]])
    sums, ends = totals([(*(codes[w] for w in words), n)], named)[0], np.cumsum(sizes).tolist()
    told = planes([sums], [width(sums)])
    return [squeezed(size.to_bytes(8, "little") + told[:, end - size : end].copy().tobytes()) for size, end in zip(sizes, ends)]


def read_answers(data: list[bytes]) -> np.ndarray:
    bodies = [opened(d) for d in data]
    return np.concatenate([joined(list(b[8:].reshape(-1, int(b[:8].view("<i8")[0]))), "<i8") for b in bodies])


def totals(questions: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], named: int) -> list[np.ndarray]:
    """For each question the sums of its n-grams' counts over all of them."""
    *codes, n = (np.concatenate(c) for c in zip(*questions))
    size = 2 + max(int(c.max(initial=named)) for c in codes)
    if size > 1 << 31:
        seen, rank = np.unique(np.concatenate(codes), return_inverse=True)
        codes, size = [r - int(seen[0] < 0) for r in np.split(rank, 3)], 2 + len(seen)
    # From 0 (none) upwards.
    a, b, c = (x + 1 for x in codes)
    gram = ranked(ranked(a * size + b)[1] * size + c)[1]
    total = np.bincount(gram, weights=n).astype(np.int64)[gram]
    return np.split(total, np.cumsum([len(q[0]) for q in questions])[:-1])


class Automaton:
    """The states and arcs that the texts of a block can reach, from the counts ``n`` of its n-grams; weights are log10.

    State 0 is the empty context; then the words, then the pairs of the block.  An arc has the number of its n-gram in the block
    and leads to the state ``to``, -1 if it is none: only contexts and n-grams of the training texts are states and arcs.  The
    empty context has an arc for every word, an unknown one included, which leads back to it.
    """

    def __init__(self, block: Block, n: np.ndarray, total: int, types: int, prior: tuple[float, float]):
        w, p = len(block.names), len(block.pairs)
        one, two, three = n[:w], n[w : w + p], n[w + p :]
        a, b, self.words = block.first[w : w + p], block.second[w : w + p], w
        uni = (one + 0.5) / (total + 0.5 * (types + 1))
        after_one = (two + prior[0] * uni[b]) / (one[a] + prior[0])
        after_two = (three + prior[1] * after_one[block.after]) / (two[block.before] + prior[1])
        to = [np.where(one > 0, 1 + np.arange(w), 0), np.where(two > 0, 1 + w + np.arange(p), -1), np.where(three > 0, 1 + w + block.after, -1)]
        self.arc_to, self.arc_weight = np.concatenate(to), np.log10(np.concatenate([uni, after_one, after_two]))
        self.fails_to = np.concatenate([np.zeros(1 + w, np.int64), 1 + b])
        self.fail_weight = np.log10(np.concatenate([[1.0], prior[0] / (one + prior[0]), prior[1] / (two + prior[1])]))
        self.states, self.arcs = 1 + int((one > 0).sum() + (two > 0).sum()), w + int((two > 0).sum() + (three > 0).sum())

    # Lists for single steps, made when the first is taken.
    to = cached_property(lambda self: self.arc_to.tolist())
    weight = cached_property(lambda self: self.arc_weight.tolist())
    fail = cached_property(lambda self: self.fails_to.tolist())
    back = cached_property(lambda self: self.fail_weight.tolist())

    def walk(self, words: list[int], pairs: list[int], triples: list[int], at: int = 0, score: float = 0.0) -> tuple[float, int]:
        """The log10 probability of the words that follow a state, added to ``score``, and the state they lead to.

        For each word come the numbers of the arcs by which the empty context, a word and a pair can go on; which of them is
        taken is up to the state.
        """
        to, weight, fail, back, last = self.to, self.weight, self.fail, self.back, self.words
        for word, pair, triple in zip(words, pairs, triples):
            if at > last:
                if (then := to[triple]) > 0:
                    score += weight[triple]
                    at = then
                    continue
                score += back[at]
                at = fail[at]
            if at:
                if (then := to[pair]) > 0:
                    score += weight[pair]
                    at = then
                    continue
                score += back[at]
            score += weight[word]
            at = to[word]
        return score, at

    def walk_all(self, block: Block) -> np.ndarray:
        """The log10 probability of each text of the block: ``walk`` for all texts at once.

        After a word a text is in one of three states: the empty one, the word's, or that of the pair which ends there.  So every
        word maps three states to three, by its arcs and failure arcs; composing the maps of more and more words before it,
        twice as many in each round, gives the state that the walk from the text's start arrives in.
        """
        if not len(block.at):
            return np.zeros(0)
        starts = np.cumsum(block.lengths) - block.lengths
        grams = block.grams_at()
        (word, by_word), (pair, by_pair), (triple, by_triple) = ((self.arc_to[g], self.arc_weight[g]) for g in grams)
        # The states before each word; what follows from the last two is never asked at places without them.
        one, two = (np.concatenate([[0], g[:-1]]) for g in grams[:2])
        one, two = 1 + one, np.maximum(1 + self.words + two - self.words, 0)
        after_one, weight_one = np.where(pair > 0, pair, word), np.where(pair > 0, by_pair, self.fail_weight[one] + by_word)
        after_two = np.where(triple > 0, triple, after_one)
        weight_two = np.where(triple > 0, by_triple, self.fail_weight[two] + weight_one)
        maps = sum((((to > 0).astype(np.uint8) + (to > self.words)) << 2 * k for k, to in enumerate((word, after_one, after_two))))
        # All texts start in the empty state.
        maps[starts] = (maps[starts] & 3) * 21
        back = 1
        while back < len(maps) and not ALIKE[maps].all():
            maps[back:] = COMPOSED[maps[back:], maps[:-back]]
            back *= 2
        state = np.concatenate([[0], maps[:-1] & 3])
        state[starts] = 0
        return np.add.reduceat(np.choose(state, [by_word, weight_one, weight_two]), starts)


#: A map of the states 0, 1, 2 has two bits for the image of each; a map after another; and whether all states have one image.
_IMAGES = np.minimum(np.arange(64)[:, None] >> np.array([0, 2, 4]) & 3, 2)
COMPOSED = (np.take_along_axis(_IMAGES[:, None, :], _IMAGES[None, :, :], axis=2) << np.array([0, 2, 4])).sum(axis=2).astype(np.uint8)
ALIKE = (_IMAGES == _IMAGES[:, :1]).all(axis=1)


def coded(tokens: list[bytes], numbers: dict[bytes, int]) -> np.ndarray:
    """The number of each word, or 62 bits of its hash above all numbers."""
    codes = np.array(list(map(numbers.get, tokens, repeat(-1))), dtype=np.int64)
    rare = np.flatnonzero(codes < 0)
    hashes = np.array([xxhash.xxh64_intdigest(tokens[i], SEED) for i in rare.tolist()], dtype=np.uint64)
    codes[rare] = (hashes >> np.uint64(2) | np.uint64(1 << 62)).view(np.int64)
    return codes


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts (bytes), one after the other, and how many each text has; the same as ``words`` finds."""
    found = pc.ascii_split_whitespace(texts.cast(pa.large_binary()).view(pa.large_string()))
    ends = np.cumsum(pc.list_value_length(found).to_numpy(zero_copy_only=False))
    # Lower-cased in an array of their own: pyarrow's ascii_lower misplaces strings of a slice that begins inside its buffer.
    flat = pc.ascii_lower(pc.take(found.flatten(), pa.array(np.arange(ends[-1] if len(ends) else 0))))
    # White space at an end of a text leaves an empty word.
    full = pc.greater(pc.binary_length(flat), 0)
    kept = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    return flat.filter(full), np.diff(kept[ends], prepend=0)


def in_codes(flat: pa.ChunkedArray, lengths: np.ndarray, numbers: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different codes of texts with these words and an end each, in rising order; the codes' places; tokens of each text."""
    found = flat.combine_chunks().dictionary_encode()
    ends, data = found.dictionary.buffers()[1:]
    ends, data = np.frombuffer(ends, np.int64, len(found.dictionary) + 1).tolist(), data.to_pybytes() if data else b""
    names, rank = np.unique(coded([*(data[i:j] for i, j in zip(ends, ends[1:])), END], numbers), return_inverse=True)
    at = np.insert(rank[found.indices.to_numpy(zero_copy_only=False)], np.cumsum(lengths), rank[-1])
    return names, at, lengths + 1


class Words:
    """What a worker builds of the broadcast."""

    def __init__(self, model: dict):
        self.numbers = {w: i for i, w in enumerate(model["words"])}
        self.counts = np.array(model["counts"], dtype=np.int64)


def score(df: DataFrame, learn: Column, text: str = "text", key: str = "doc_id", settings: Settings = Settings()) -> DataFrame:
    """One row per input row: ``key``, ``learned``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Learned from all n-grams of the rows where ``learn`` holds (NULL: does not).  ``base_score`` is the unigram log10 probability
    of the text and its end, ``score`` the automaton's.  NULL and empty texts have the end as only token; a text of any length is
    scored whole and is a block of its own if it is long; repeated rows count and are scored each for itself; words of equal
    counts may be numbered or not, which changes no score; without training rows every token is unknown; an empty table gives an empty
    result; other columns are not read.
    """
    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("k"), F.coalesce(learn, F.lit(False)).alias("learned"), text_bytes(F.col(text)).alias("v"))
    model = fit_words(rows.filter("learned"), settings)
    shared = Shared(df.sparkSession, model)
    named, total, types, prior = len(model["words"]), model["total"], model["types"], settings.prior
    parts = 1 + (rows.agg(F.sum(F.octet_length("v"))).first()[0] or 0) // settings.part
    spread = max(settings.spread, parts)
    schema = f"part bigint, block bigint, k array<{kind}>, learned array<boolean>, data binary"

    def rows_of(like: pa.DataType, found: list[tuple]) -> dict[str, pa.Array]:
        columns = list(zip(*found)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), like, pa.list_(pa.bool_()), pa.binary()]
        return {n: pa.array(c, t) for n, c, t in zip(("part", "block", "k", "learned", "data"), columns, kinds)}

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = shared.built(Words).numbers
        name, keys, learned, held, lengths, size = None, [], [], [], [], 0

        def block() -> Iterator[pa.RecordBatch]:
            names, at, tokens = in_codes(pa.chunked_array(held), np.concatenate(lengths), numbers)
            mine = Block(names, at, tokens)
            n = mine.counts(np.array(learned))
            found = [(name % parts, name, keys, learned, pack([steps(names), at, tokens]))]
            total = 0
            for part, data in mine.questions(mine.asked(named, spread, parts), n, named):
                found.append((part, name, None, None, data))
                total += len(data)
                if total >= settings.send:
                    yield pa.RecordBatch.from_pydict(rows_of(pa.list_(type_of), found))
                    found, total = [], 0
            if found:
                yield pa.RecordBatch.from_pydict(rows_of(pa.list_(type_of), found))

        for batch in pieces(batches, "v"):
            type_of = batch.schema.field("k").type
            row, k, known = (batch.column(c).to_pylist() for c in ("row", "k", "learned"))
            flat, each = split(batch.column("v"))
            ends, start = np.cumsum(each + 1), 0
            while start < len(row):
                # Texts up to the one that fills the block.
                before = int(ends[start - 1]) if start else 0
                end = min(len(row), int(np.searchsorted(ends, before + settings.block - size)) + 1)
                name = row[start] if name is None else name
                keys += k[start:end]
                learned += known[start:end]
                held.append(flat.slice(before - start, int(ends[end - 1]) - end - (before - start)))
                lengths.append(each[start:end])
                size += int(ends[end - 1]) - before
                start = end
                if size >= settings.block:
                    yield from block()
                    name, keys, learned, held, lengths, size = None, [], [], [], [], 0
        if held:
            yield from block()

    def answer(group: pa.Table) -> pa.Table:
        own = pc.is_valid(group.column("k"))
        told, asked = group.filter(own), group.filter(pc.invert(own))
        if not asked.num_rows:
            return told
        sums = pa.array(answers(asked.column("data").to_pylist(), named), pa.binary())
        return pa.concat_tables([told, asked.set_column(asked.schema.get_field_index("data"), told.schema.field("data"), sums)])

    def finish(group: pa.Table) -> pa.Table:
        is_own = pc.is_valid(group.column("k"))
        own, told = group.filter(is_own), group.filter(pc.invert(is_own)).sort_by("part")
        names, at, lengths = unpack(own.column("data")[0].as_py())
        block = Block(np.cumsum(names), at, lengths)
        n, known = np.zeros(len(block.first), np.int64), block.names[block.names < named]
        n[: len(known)] = shared.built(Words).counts[known]
        if asked := block.asked(named, spread, parts):
            n[np.concatenate([grams for _, grams in asked])] = read_answers(told.column("data").to_pylist())
        automaton = Automaton(block, n, total, types, prior)
        starts = np.cumsum(lengths) - lengths
        return pa.table({
            key: own.column("k").combine_chunks().flatten(), "learned": own.column("learned").combine_chunks().flatten(),
            "n_tokens": pa.array(lengths, pa.int64()), "n_known": pa.array(np.add.reduceat((n[at] > 0).astype(np.int64), starts)),
            "train_tokens": pa.array(np.full(len(lengths), total, np.int64)),
            "base_score": pa.array(np.add.reduceat(automaton.arc_weight[at], starts)), "score": pa.array(automaton.walk_all(block)),
        })

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "k", "learned", "v")
    told = numbered.mapInArrow(ask, schema).repartition(parts, "part").groupBy("part").applyInArrow(answer, schema)
    out = f"`{key}` {kind}, learned boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return told.repartition(parts, "block").groupBy("block").applyInArrow(finish, out)
