"""Chat formatting at the level of tokens.

Every segment is encoded by itself and the template's marks are reserved ids above the vocabulary, so
no text can become a mark.  In the written form control strings that occur in a text are escaped
reversibly.  The loss mask is derived from the segments' lengths by prefix sums.

    <s> { [INST] role [/INST] text </s> } ...
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm.common import Shared, pieces, text_bytes

BEGIN, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
MARKS = (BEGIN, END, OPEN, CLOSE)
#: A mark with any number of backslashes after its first sign, and with at least one.
CONTROL = re.compile(r"(<)(\\*)(/?s>)|(\[)(\\*)(/?INST\])")
ESCAPED = re.compile(r"(<)\\(\\*/?s>)|(\[)\\(\\*/?INST\])")
CHUNK = 4096
TOKENS = "conv_id bigint, chunk bigint, token_ids array<int>, loss_mask array<boolean>"


def escape(text: str) -> str:
    """One more backslash inside everything that is a control string but for backslashes: none is left."""
    return CONTROL.sub(lambda m: f"{m[1]}\\{m[2]}{m[3]}" if m[1] else f"{m[4]}\\{m[5]}{m[6]}", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: m[1] + m[2] if m[1] else m[3] + m[4], text)


class Template:
    """Segments to ids and back; reserved ids follow the vocabulary's."""

    def __init__(self, model: dict):
        self.library = Tokenizer.from_str(model["json"])
        self.library.encode_special_tokens = True  # their strings in a text are then ordinary text
        self.library.no_truncation()
        self.library.no_padding()
        self.ids = {m: model["size"] + i for i, m in enumerate(MARKS)}
        self.marks = {i: m for m, i in self.ids.items()}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch([escape(t) for t in texts], add_special_tokens=False)]

    def turn(self, role: list[int], text: list[int], learned: bool) -> tuple[list[int], np.ndarray]:
        """Ids and loss mask of a turn; only the text of a learned one is under the mask."""
        ids = [self.ids[OPEN], *role, self.ids[CLOSE], *text, self.ids[END]]
        lengths = np.array([1, len(role), 1, len(text), 1])
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1])
        return ids, (at >= ends[2]) & (at < ends[3]) if learned else np.zeros(len(at), dtype=bool)

    def segments(self, ids: Iterable[int], mask: Iterable[bool]) -> Iterator[tuple[str | None, list[int], bool]]:
        """(mark, [], False) for a reserved id, (None, ids, under the mask) for what lies between."""
        held, learned = [], False
        for i, m in zip(ids, mask):
            if i in self.marks:
                if held:
                    yield None, held, learned
                    held = []
                yield self.marks[i], [], False
            else:
                held.append(i)
                learned = m
        if held:
            yield None, held, learned

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids, skip_special_tokens=False)


def load(path: str) -> dict:
    text = open(path, encoding="utf-8").read()
    library = Tokenizer.from_str(text)
    return {"json": text, "size": library.get_vocab_size(with_added_tokens=True)}


def turns(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """The rows as conversations, each in the order of its turns within one partition."""
    rows = df.select(
        F.col(key).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), text_bytes(F.col(role)).alias("role"), text_bytes(F.col(text)).alias("text")
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def format_chats(
    df: DataFrame, path: str, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learned: str = "assistant"
) -> DataFrame:
    """``conv_id``, ``chunk``, ``token_ids``, ``loss_mask``: each conversation in chunks of whole turns.

    A chunk ends at the first turn that reaches CHUNK ids, so a conversation of any number of turns streams
    through; chunk 0 begins with the mark of a conversation.  Rows are ordered by turn (NULL first),
    then role and text; repeated rows are turns of their own; a NULL role or text is empty; rows with a
    NULL key are one conversation; an empty table gives an empty result; other columns are not read.
    """
    shared = Shared(df.sparkSession, load(path))

    def run(batches):
        template = shared.built(Template)
        at, chunk, ids, mask, done = None, 0, [], [], []

        def batch():
            columns = zip(*done)
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.bool_())]
            out = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=["conv_id", "chunk", "token_ids", "loss_mask"])
            done.clear()
            return out

        for piece in (p for b in batches for p in pieces([b], "text")):
            convs = piece.column("conv_id").to_pylist()
            roles = [r.decode("utf-8", "replace") for r in piece.column("role").to_pylist()]
            texts = [t.decode("utf-8", "replace") for t in piece.column("text").to_pylist()]
            for conv, r, role_ids, text_ids in zip(convs, roles, template.encode(roles), template.encode(texts)):
                if at is None or at[0] != conv:
                    if ids:
                        done.append((at[0], chunk, ids, mask))
                    at, chunk, ids, mask = (conv,), 0, [template.ids[BEGIN]], [False]
                turn_ids, turn_mask = template.turn(role_ids, text_ids, r == learned)
                ids = ids + turn_ids
                mask = mask + turn_mask.tolist()
                if len(ids) >= CHUNK:
                    done.append((conv, chunk, ids, mask))
                    chunk, ids, mask = chunk + 1, [], []
            if len(done) >= 200:
                yield batch()
        if ids:
            done.append((at[0], chunk, ids, mask))
        if done:
            yield batch()

    return turns(df, key, turn, role, text).mapInArrow(run, TOKENS)


def read_back(formatted: DataFrame, path: str) -> DataFrame:
    """One row per conversation, from its ids and mask alone: number and digest of its turns, size and digest of
    the text under the loss mask, characters of the written form.

    Takes what ``format_chats`` gives.  Digests run over the chunks in order, whatever their number.
    """
    shared = Shared(formatted.sparkSession, load(path))
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    schema = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        template = shared.built(Template)
        at, state, done = None, None, []

        def finish():
            n, turn_hash, loss, loss_hash, size = state
            done.append((at[0], n, turn_hash.hexdigest(), loss, loss_hash.hexdigest(), size))

        for batch in batches:
            for conv, ids, mask in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "token_ids", "loss_mask"))):
                if at is None or at[0] != conv:
                    if at is not None:
                        finish()
                    at, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                parts: dict[str, str] = {}
                inside = None
                for mark, held, learned in template.segments(ids, mask):
                    if mark is None:
                        written = template.decode(held)
                        state[4] += len(written)
                        parts[inside] = plain = unescape(written)
                        if learned:
                            state[2] += len(plain)
                            state[3].update(plain.encode())
                        continue
                    state[4] += len(mark)
                    if mark == END:
                        state[0] += 1
                        state[1].update(f"{parts.pop(OPEN, '')}\n{parts.pop(CLOSE, '')}\n".encode())
                    inside = mark
            if len(done) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), kinds)], names=names)
                done.clear()
        if at is not None:
            finish()
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*done), kinds)], names=names)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return ordered.mapInArrow(run, schema)
