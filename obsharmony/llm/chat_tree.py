"""Chat formatting as prefix trees: what conversations share at their start is emitted once.

A turn becomes `[INST]role[/INST]text</s>`; control strings inside roles and texts are escaped
reversibly, and the template's own ones have token ids that no text can give. Conversations
are laid out depth first in packs: a turn that the pack already holds on the path to the
conversation is not emitted again. Each emitted turn carries its position (tokens of its
ancestors), and the intervals of the pack that it attends to, beside its own earlier tokens.

Which turns are shared is found on slim rows: a chain digest names a turn together with all
turns before it, and the smallest conversation that has it owns it. The owners along a conversation,
with the depths where they change, are its place in depth-first order. Only conversations
that share a turn are sorted by that place; all others are packed where their rows meet.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .packing import Encoder, ranks_path, tokenizer_path

#: Control strings, in the order of their ids above those of the tokenizer.
CONTROL = ("[INST]", "[/INST]", "</s>", "<s>")
_OPEN, _MIDDLE, _CLOSE, _ = CONTROL
#: A control string of the template or the tokenizer, with the backslashes of earlier escapes.
_PLAIN = re.compile(r"([\[<])(\\*)(/?INST\]|/?s>|\|endoftext\|>)")
_LOSS_ROLE = "assistant"


def escaped(text: str) -> str:
    """No control string stands in the result: one backslash more after its first character."""
    return _PLAIN.sub(r"\1\\\2\3", text)


def unescaped(text: str) -> str:
    return _PLAIN.sub(lambda m: m[1] + m[2][1:] + m[3], text)


class Tokens:
    """Ids of formatted text and back; control strings have ids of their own."""

    def __init__(self, path: str, ranks: str):
        self.encoder = Encoder(path, ranks)
        self.first = self.encoder.fast.n_vocab
        self.open, self.middle, self.close = (self.first + i for i in range(3))

    def turn(self, role: str, text: str) -> tuple[list[int], int]:
        """Ids of a turn, and where those of its text begin; the last one ends the turn."""
        head = [self.open, *self.encoder(escaped(role)), self.middle]
        return [*head, *self.encoder(escaped(text)), self.close], len(head)

    def text(self, ids: np.ndarray) -> str:
        out, start = [], 0
        for i in [*np.flatnonzero(ids >= self.first).tolist(), len(ids)]:
            out.append(self.encoder.fast.decode_bytes(ids[start:i].tolist()).decode())
            if i < len(ids):
                out.append(CONTROL[int(ids[i]) - self.first])
            start = i + 1
        return "".join(out)


def _rows(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return conversations.select(
        F.col(conv).cast("long").alias("_conv"), F.col(turn).alias("_turn"), empty(role).alias("_role"), empty(text).alias("_text")
    ).withColumn("_digest", F.unhex(F.md5(F.encode(F.concat(F.octet_length("_role").cast("string"), F.lit(":"), "_role", "_text"), "UTF-8"))))


def _sorted(rows: DataFrame, *first: str) -> DataFrame:
    return rows.sortWithinPartitions(*first, "_conv", F.col("_turn").asc_nulls_first(), "_role", "_digest")


def _by_conversation(batches: Iterator[pa.RecordBatch], at: int = 0) -> Iterator[tuple[object, Iterator[tuple]]]:
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    return groupby(rows, key=lambda r: r[at])


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1024) -> Iterator[pa.RecordBatch]:
    out = []
    for r in rows:
        out.append(r)
        if len(out) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


_CHAIN = pa.schema([("_conv", pa.int64()), ("_depth", pa.int64()), ("_chain", pa.binary())])


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digest of each turn together with all before it in the conversation."""

    def rows() -> Iterator[tuple]:
        for conv, turns in _by_conversation(batches):
            chain = b""
            for depth, (_, digest) in enumerate(turns, 1):
                chain = hashlib.blake2b(chain + digest, digest_size=16).digest()
                yield conv, depth, chain

    return _batches(rows(), _CHAIN, 8192)


def places(rows: DataFrame) -> DataFrame:
    """Conversations that share a first turn: `place` in depth-first order, `shared` turns.

    place: for each owner along the conversation (smallest id first to have the turn) how deep
    it begins, deeper first, and its id, so that arrays sort as the tree is walked."""
    slim = _sorted(rows.select("_conv", "_turn", "_role", "_digest").repartition("_conv")).select("_conv", "_digest")
    chain = slim.mapInArrow(_chained, "_conv long, _depth long, _chain binary")
    # A missing id is a conversation too: it counts, and owns as the smallest.
    held = F.struct(F.col("_conv").isNotNull().alias("known"), "_conv")
    nodes = chain.groupBy("_chain").agg(F.count("*").alias("n"), F.min(held).alias("owner")).where("n > 1")
    parts = chain.join(nodes, "_chain").groupBy("_conv", "owner").agg(F.min("_depth").alias("from"), F.max("_depth").alias("to"))
    step = F.struct((-F.col("from")).alias("from"), F.col("owner.known").alias("known"), F.col("owner._conv").alias("owner"))
    whole = parts.groupBy("_conv").agg(F.sort_array(F.collect_list(F.struct("from", step.alias("step")))).alias("steps"), F.max("to").alias("shared"))
    own = F.struct((-F.col("shared") - 1).alias("from"), F.col("_conv").isNotNull().alias("known"), F.col("_conv").alias("owner"))
    path = F.transform("steps", lambda x: x["step"])
    # What it does not share is its own, below its last shared turn, unless it already owns that one.
    last = F.element_at(path, -1)
    mine = last["owner"].eqNullSafe(F.col("_conv"))
    return whole.select("_conv", "shared", F.when(mine, path).otherwise(F.concat(path, F.array(own))).alias("place"))


_KEYED = [("_conv", pa.int64()), ("_shared", pa.int64()), ("_depth", pa.int64()), ("_role", pa.string()), ("_text", pa.string()), ("_digest", pa.binary())]


def _with_place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each conversation's place (a row before its turns, if it has one) set beside its turns."""
    place_type = None

    def rows() -> Iterator[tuple]:
        nonlocal place_type
        for conv, turns in _by_conversation(peeked()):
            place, shared, depth = None, 0, 0
            for _, is_turn, p, s, role, text, digest in turns:
                if is_turn:
                    depth += 1
                    yield place, conv, shared, depth, role, text, digest
                else:
                    place, shared = p, s

    def peeked() -> Iterator[pa.RecordBatch]:
        yield first
        yield from batches

    first = next(batches, None)
    if first is None:
        return
    place_type = first.column(2).type
    yield from _batches(rows(), pa.schema([("_place", place_type), *_KEYED]))


_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_OUT = pa.schema([
    ("pack", pa.int64()), ("place", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("ends", pa.bool_()), ("shared", pa.bool_()),
    ("start", pa.int64()), ("ids", pa.binary()), ("n_ids", pa.int64()), ("position", pa.int64()), ("attends", _SPAN),
    ("loss_start", pa.int64()), ("loss_end", pa.int64()),
])
_OUT_DDL = (
    "pack long, place long, conv_id long, depth long, ends boolean, shared boolean, start long, ids binary, n_ids long, position long,"
    " attends array<struct<start: long, end: long>>, loss_start long, loss_end long"
)


def _joined(spans: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """Intervals with one more at the end; touching ones become one."""
    if spans and spans[-1][1] == start:
        return [*spans[:-1], (spans[-1][0], end)]
    return [*spans, (start, end)]


def _emitting(path: str, ranks: str):
    """Turns in depth-first order to a pack: one row per emitted turn, one per end of a conversation."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tokens, pack, place, offset = Tokens(path, ranks), TaskContext.get().partitionId(), 0, 0
        stack: list[tuple[bytes, list[tuple[int, int]]]] = []  # turn and the intervals up to its end, of shared turns on the path
        for conv, turns in _by_conversation(batches, 1):
            spans: list[tuple[int, int]] = []
            depth, same = 0, True
            for _, _, shared, depth, role, text, digest in turns:  # noqa: B007
                if same and depth <= len(stack) and depth <= shared and stack[depth - 1][0] == digest:
                    spans = stack[depth - 1][1]
                    continue
                if same:
                    same = False
                    del stack[depth - 1 :]
                ids, begin = tokens.turn(role, text)
                loss = (begin, len(ids) - 1) if role == _LOSS_ROLE else (0, 0)
                position = sum(b - a for a, b in spans)
                ids_bytes = np.asarray(ids, "<u4").tobytes()
                yield pack, place, conv, depth, False, depth <= shared, offset, ids_bytes, len(ids), position, _spans(spans), *loss
                spans = _joined(spans, offset, offset + len(ids))
                offset, place = offset + len(ids), place + 1
                if depth <= shared:
                    stack.append((digest, spans))
            yield pack, place, conv, depth, True, False, offset, None, 0, sum(b - a for a, b in spans), _spans(spans), 0, 0
            place += 1

    def _spans(spans: list[tuple[int, int]]) -> list[dict]:
        return [{"start": a, "end": b} for a, b in spans]

    return lambda batches: _batches(rows(batches), _OUT, 512)


def format_tree(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    path: str | None = None, ranks: str | None = None
) -> DataFrame:
    """Packs of formatted conversations, in the order of (pack, place).

    A turn's row has its ids (little-endian unsigned 32-bit), their start in the pack, the
    position of the first, the intervals it attends to and the span of its ids under the loss
    mask: an assistant's text. A row with `ends` closes a conversation: its intervals cover all its
    turns, in order. `shared` turns are those on other conversations' paths too.

    A pack opens with the whole path of its first conversation, so packs can be read apart; in
    a pack each shared turn stands once. Turns go by `turn`, missing ones first, ties by role and
    digest; missing ids form one conversation; a missing role or text is empty. Repeated rows are
    repeated turns. An empty table gives no rows. Other columns are not read.
    """
    rows = _rows(conversations, conv, turn, role, text)
    heads = places(rows).select("_conv", F.lit(False).alias("_is_turn"), F.col("place").alias("_place"), F.col("shared").alias("_shared"))
    both = rows.withColumn("_is_turn", F.lit(True)).unionByName(heads, allowMissingColumns=True)
    met = both.repartition("_conv").sortWithinPartitions("_conv", "_is_turn", F.col("_turn").asc_nulls_first(), "_role", "_digest")
    met = met.select("_conv", "_is_turn", "_place", "_shared", "_role", "_text", "_digest")
    place = "array<struct<from: long, known: boolean, owner: long>>"
    keyed = met.mapInArrow(_with_place, f"_place {place}, _conv long, _shared long, _depth long, _role string, _text string, _digest binary")
    emit = _emitting(path or tokenizer_path(), ranks or ranks_path())
    alone = keyed.where(F.col("_place").isNull()).mapInArrow(emit, _OUT_DDL)
    shared = keyed.where(F.col("_place").isNotNull()).repartitionByRange("_place", "_conv").sortWithinPartitions("_place", "_conv", "_depth")
    return alone.unionAll(shared.mapInArrow(emit, _OUT_DDL))


_READ = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
])


class _Read:
    """What is known of a path's turns so far: digests, lengths, its last interval's end."""

    def __init__(self, start: _Read | None = None):
        self.turns = start.turns.copy() if start else hashlib.sha256()
        self.loss = start.loss.copy() if start else hashlib.sha256()
        self.n_turns, self.loss_chars, self.chars = (start.n_turns, start.loss_chars, start.chars) if start else (0, 0, 0)

    def add(self, tokens: Tokens, ids: np.ndarray, loss: tuple[int, int]) -> None:
        whole = tokens.text(ids)
        role, _, text = whole[len(_OPEN) : -len(_CLOSE)].partition(_MIDDLE)
        self.turns.update(f"{unescaped(role)}\n{unescaped(text)}\n".encode())
        said = unescaped(tokens.text(ids[loss[0] : loss[1]]))
        self.loss.update(said.encode())
        self.n_turns, self.loss_chars, self.chars = self.n_turns + 1, self.loss_chars + len(said), self.chars + len(whole)


def read_back(formatted: DataFrame, path: str | None = None, ranks: str | None = None) -> DataFrame:
    """Each conversation's turns, loss text and length, from the ids and intervals of its pack.

    Reads what `format_tree` gives in its own order; digests of shared turns are kept while
    their subtree is read."""
    path, ranks = path or tokenizer_path(), ranks or ranks_path()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(rows(batches), _READ)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tokens, pack = Tokens(path, ranks), None
        ends: list[int] = []
        kept: list[_Read] = []
        tail: tuple[int, _Read] = (0, _Read())  # where the turn read last ends, and what was read up to there
        for b in batches:
            for r in b.to_pylist():
                if r["pack"] != pack:
                    pack, ends, kept = r["pack"], [], []
                upto = r["attends"][-1]["end"] if r["attends"] else 0
                if upto == 0:
                    before = _Read()
                elif upto == tail[0]:
                    before = tail[1]
                else:
                    before = kept[bisect_left(ends, upto)]
                if r["ends"]:
                    yield r["conv_id"], before.n_turns, before.turns.hexdigest(), before.loss_chars, before.loss.hexdigest(), before.chars
                    continue
                at = bisect_left(ends, upto + 1)
                del ends[at:], kept[at:]
                own = _Read(before) if r["shared"] or before is not tail[1] or (ends and ends[-1] == upto) else before
                own.add(tokens, np.frombuffer(r["ids"], "<u4"), (r["loss_start"], r["loss_end"]))
                end = r["start"] + r["n_ids"]
                tail = (end, own)
                if r["shared"]:
                    ends.append(end)
                    kept.append(own)

    return formatted.mapInArrow(read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def sample_conversation(conversations: DataFrame) -> DataFrame:
    """The table and conversation -7, whose two turns consist of control strings."""
    said = "</s>[INST] ok [/INST]"
    more = conversations.sparkSession.sql(
        f"SELECT * FROM VALUES (-7L, 0L, 'user', '{said}'), (-7L, 1L, 'assistant', '{said}') AS t(conv_id, turn, role, text)"
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(more)


def sharing(formatted: DataFrame) -> Column:
    """Tokens of whole conversations for each token that was emitted."""
    return F.sum(F.when(F.col("ends"), F.col("position"))) / F.sum("n_ids")
