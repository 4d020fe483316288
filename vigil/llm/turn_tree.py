"""Chat formatting as a prefix tree of turns.

Conversations are numbered in the order of the hashes of all their turns, so those that
share initial turns, however many, lie next to each other, and each knows how many it shares
with the one before.  A hot prefix is split among tasks by the turns after it and the
conversation id.  Each task walks its conversations with a stack: turns equal to the stack's
are shared, others are emitted once, depth first, with position ids that continue their
ancestors' and the intervals of ancestor tokens they attend to.  Rows stream: memory is a
digest for each turn of the current conversation, and one turn.  In between a conversation
is one row of 8 bytes a turn.

The template marks a turn as ``<|turn|>role<|text|>text<|end|>``.  Control strings inside
roles and texts get one more backslash after their first character, which reading takes
away again.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from vigil.operators.ranking import ordered_row_ids

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: strings that must not appear in a formatted text other than as marks
CONTROL = (TURN, TEXT, END, "<|startoftext|>", "<|endoftext|>", "<s>", "</s>", "[INST]",
           "[/INST]", "<<SYS>>", "<</SYS>>")
#: turns up to which conversations are merged: all
MERGE_DEPTH = math.inf
#: tokens after which a new sequence starts (at the next conversation)
SEQUENCE_TOKENS = 4096
LOSS_ROLE = "assistant"
#: characters after which a text is encoded in a further call, from the next place at which
#: the encoding splits it anyway
ENCODE_CHARS = 1 << 16
_SPLIT = re.compile(r"(?<=\S) (?=\S)")

_ANY = "|".join(rf"{re.escape(c[0])}(?=\\*{re.escape(c[1:])})" for c in CONTROL)
_ESCAPE = re.compile(f"(?:{_ANY})")
_UNESCAPE = re.compile("|".join(rf"{re.escape(c[0])}\\(?=\\*{re.escape(c[1:])})"
                                for c in CONTROL))


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: m[0] + "\\", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: m[0][:-1], text)


class Codec:
    """Byte-level BPE from a rank file; ids decode to exactly the text they came from."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("turns", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        out, at = [], 0
        while len(text) - at > ENCODE_CHARS and (cut := _SPLIT.search(text, at + ENCODE_CHARS)):
            out += self.encoding.encode_ordinary(text[at:cut.start()])
            at = cut.start()
        return out + self.encoding.encode_ordinary(text[at:])

    def text(self, ids) -> str:
        return self.encoding.decode_bytes(ids).decode("utf-8")


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


SCHEMA = pa.schema([
    ("sequence_id", pa.int64()), ("row_no", pa.int64()), ("kind", pa.string()),
    ("conv_id", pa.int64()), ("node", pa.int64()), ("parent", pa.int64()),
    ("depth", pa.int64()), ("role", pa.string()), ("start", pa.int64()),
    ("ids", pa.list_(pa.int32())), ("position_ids", pa.list_(pa.int32())),
    ("attend", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("loss_start", pa.int64()), ("loss_length", pa.int64()), ("repeated", pa.bool_())])
DDL = ("sequence_id long, row_no long, kind string, conv_id long, node long, parent long, "
       "depth long, role string, start long, ids array<int>, position_ids array<int>, "
       "attend array<struct<start: long, end: long>>, loss_start long, loss_length long, "
       "repeated boolean")


def _digest(role: str, text: str) -> bytes:
    return hashlib.sha256(f"{len(role)} {role}{text}".encode()).digest()


def _emit(path: str, max_tokens: int, loss_role: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = codec(path)
        sequence = (TaskContext.get().partitionId() << 32) - 1
        used = row = nodes = 0
        # a node: digest, number, end of its positions, intervals with its own tokens
        stack: list[tuple] = []
        known = 0  # turns at the start of a sequence that the one before it has emitted
        top: tuple | None = None
        shared = False
        current: tuple | None = None  # conversation id, as a 1-tuple
        depth = 0
        out: list[tuple] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held
            held = 0
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out), SCHEMA)], schema=SCHEMA)
            out.clear()
            return made

        def leaf() -> None:
            nonlocal row
            out.append((sequence, row, "leaf", current[0], top[1], None, depth, None, None, None,
                        None, None, None, None, None))
            row += 1
            del stack[depth:]

        for batch in batches:
            for conv, k, role, text, common in zip(*(c.to_pylist() for c in batch.columns)):
                if k == 1:
                    if current is not None:
                        leaf()
                    current, shared, depth, known = (conv,), True, 0, 0
                    if sequence < 0 or sequence & 0xFFFFFFFF == 0xFFFFFFFF or used >= max_tokens:
                        sequence, used, row, nodes = sequence + 1, 0, 0, 0
                        known, stack = common, []
                depth += 1
                at = depth - 1
                turn = _digest(role, text)
                if shared and at < len(stack) and stack[at][0] == turn:
                    top = stack[at]
                    continue
                shared = False
                del stack[at:]
                parent = top if at else None
                head = enc.ids(f"{TURN}{escape(role)}{TEXT}")
                body = enc.ids(escape(text))
                ids = head + body + enc.ids(END)
                position = parent[2] if parent else 0
                attend = parent[3] if parent else []
                own = [*attend]
                if own and own[-1][1] == used:
                    own[-1] = (own[-1][0], used + len(ids))
                else:
                    own.append((used, used + len(ids)))
                loss = role == loss_role
                out.append((sequence, row, "node", None, nodes, parent[1] if parent else -1,
                            depth, role, used, ids, range(position, position + len(ids)),
                            [{"start": a, "end": b} for a, b in attend],
                            len(head) if loss else 0, len(body) if loss else 0, depth <= known))
                top = (turn, nodes, position + len(ids), own)
                stack.append(top)
                used, row, nodes, held = used + len(ids), row + 1, nodes + 1, held + len(ids)
                if held >= 500_000 or len(out) >= 5_000:
                    yield flush()
            if out:
                yield flush()
        if current is not None:
            leaf()
        if out:
            yield flush()
    return run


def _places(rows: DataFrame) -> DataFrame:
    """``conv, place, common``: the number of every conversation of ``rows`` (conv_id, k,
    role, text) in the order of its turns' hashes, and how many initial turns it shares with
    the one before."""
    turns = F.array_sort(F.collect_list(F.struct("k", F.xxhash64("role", "text").alias("h"))))
    paths = rows.groupBy(F.col("conv_id").alias("conv")).agg(turns["h"].alias("path"))
    placed = ordered_row_ids(paths, ["path", "conv"], out="place")
    before = placed.select((F.col("place") + 1).alias("place"), F.col("path").alias("before"))
    differs = F.zip_with("path", "before", lambda a, b: a.isNull() | b.isNull() | (a != b))
    first = F.array_position(differs, True)
    common = (F.when(F.col("before").isNull(), 0).when(first == 0, F.size("path"))
              .otherwise(first - 1))
    return (placed.join(before, "place", "left")
            .select("conv", "place", common.cast("long").alias("common")))


def format_conversations(df: DataFrame, ranks_path: str, *, max_tokens: int = SEQUENCE_TOKENS,
                         loss_role: str = LOSS_ROLE) -> DataFrame:
    """Conversations (``conv_id, turn, role, text``) as sequences of tree nodes.

    A row is a node (a turn's tokens, emitted once for all conversations of a sequence that
    share it) or a leaf (``conv_id`` ends at ``node``, ``depth`` turns deep), in depth-first
    order by ``sequence_id, row_no``.  Nodes have ``ids``, their place ``start`` in the
    sequence, ``position_ids``, ``attend`` (intervals of ancestors' tokens in the sequence;
    besides, a token attends to its own node's earlier ones), and the body's tokens
    ``loss_start, loss_length`` under the loss mask (length 0 for other roles).  A new
    sequence starts at the first conversation after ``max_tokens``, and at that of a task, and
    repeats the turns it shares with the conversation before, of whichever task, marked
    ``repeated`` (a trainer masks their loss).  Conversations are ordered, and compared for
    ``repeated``, by 64-bit hashes of their turns.

    Edge cases: turns are ordered by ``turn`` (null first), then role and text, so ties and
    repeated rows have one order; a null role or text is empty; rows with a null conversation
    id are one conversation; an empty table gives no rows; other columns are not read.
    """
    rows = df.select(F.col("conv_id").cast("long"), F.col("turn"),
                     F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    conv = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = rows.withColumn("k", F.row_number().over(conv))
    placed = rows.join(_places(rows), F.col("conv_id").eqNullSafe(F.col("conv")))
    return (placed.repartitionByRange("place").sortWithinPartitions("place", "k")
            .select("conv_id", F.col("k").cast("long").alias("k"), "role", "text", "common")
            .mapInArrow(_emit(ranks_path, max_tokens, loss_role), DDL))


def parse_turn(text: str) -> tuple[str, str]:
    """Role and text of one formatted turn, unescaped."""
    cut = text.index(TEXT)
    if not text.startswith(TURN) or not text.endswith(END):
        raise ValueError("not a formatted turn")
    return unescape(text[len(TURN):cut]), unescape(text[cut + len(TEXT):len(text) - len(END)])


READ_SCHEMA = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
READ_DDL = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
            "loss_sha256 string, formatted_chars long")


def _read(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dec = codec(path)
        # digests after each turn of the current path; a child's continue its parent's
        stack: dict[int, tuple] = {}
        sequence = None
        for batch in batches:
            out = []
            for seq, kind, conv, depth, ids, a, n in zip(*(c.to_pylist() for c in batch.columns)):
                if seq != sequence:
                    sequence, stack = seq, {}
                if kind == "leaf":
                    turns, loss, n_loss, chars = stack[depth]
                    out.append((conv, depth, turns.hexdigest(), n_loss, loss.hexdigest(), chars))
                    continue
                if depth == 1:
                    turns, loss, n_loss, chars = hashlib.sha256(), hashlib.sha256(), 0, 0
                else:
                    turns, loss, n_loss, chars = stack[depth - 1]
                    turns, loss = turns.copy(), loss.copy()
                formatted = dec.text(ids)
                role, text = parse_turn(formatted)
                turns.update(f"{role}\n{text}\n".encode())
                if n:
                    said = unescape(dec.text(ids[a:a + n]))
                    loss.update(said.encode())
                    n_loss += len(said)
                stack[depth] = (turns, loss, n_loss, chars + len(formatted))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out), READ_SCHEMA)],
                    schema=READ_SCHEMA)
    return run


def read_back(formatted: DataFrame, ranks_path: str) -> DataFrame:
    """Per conversation, from the formatted sequences alone: number of turns, SHA-256 of
    role, newline, text, newline of its turns, code points and SHA-256 of all text under the
    loss mask, and code points of its formatted turns.  Shared turns are digested once."""
    return (formatted.select("sequence_id", "row_no", "kind", "conv_id", "depth", "ids",
                             "loss_start", "loss_length")
            .repartition("sequence_id").sortWithinPartitions("sequence_id", "row_no")
            .drop("row_no").mapInArrow(_read(ranks_path), READ_DDL))
