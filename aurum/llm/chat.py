"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all turns before it are context, and
only its own text is trainable.  Examples of one conversation share prefixes,
so the stored form holds each rendered turn once: row k of a conversation is its
k-th rendered turn with the place where it starts in the conversation, and each
assistant row closes an example whose text is all rows up to it.  The stored
form is linear in the input, however long a conversation is; ``expand`` streams
the full text of every example, with the loss span, to whoever trains.
``read_examples`` does the same and takes its digests from the full texts, so its
work is that of all prefixes: with the square of a conversation's length.

A turn is rendered as ``<s>[role] text</s>``.  In roles and texts, ``\\`` is
doubled and ``\\`` is put behind each ``<``, ``[`` and ``]``, so that none of the
template's marks can occur inside, and reading backs out exactly.

Rows of a conversation are taken by turn; equal turns by role, then by text.
Null roles and texts count as empty (an empty role is never trainable); a null
conversation or turn is a value of its own, turns without number first.  An
empty table gives no rows; other columns are not read.  Formatting holds one turn
at a time; full examples need the text of one conversation in memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[", "] ", "</s>"
TRAINED = "assistant"
_SPECIAL = re.compile(r"[<\[\]]|\\")
_ESCAPED = re.compile(r"([<\[\]])\\|\\\\")


def escape(text: str) -> str:
    return _SPECIAL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1] or "\\", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn as text, and where its escaped text starts and ends."""
    head = f"{OPEN}{escape(role)}{MIDDLE}"
    body = escape(text)
    return f"{head}{body}{CLOSE}", len(head), len(head) + len(body)


def parse(piece: str) -> tuple[str, str]:
    """(role, text) of a rendered turn."""
    at = len(OPEN)
    while piece[at:at + 2] != MIDDLE:  # an escaped ] is followed by \, never by a blank
        at += 2 if piece[at] in "<[]\\" else 1
    if not (piece.startswith(OPEN) and piece.endswith(CLOSE)):
        raise ValueError("not a rendered turn")
    return unescape(piece[len(OPEN):at]), unescape(piece[at + len(MIDDLE):len(piece) - len(CLOSE)])


def _by_conversation(df: DataFrame, *order) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


FORMAT = ("conv_id long, position long, example long, trained boolean, start long, "
          "loss_start long, loss_end long, piece string")


def formatted(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, position, example (the number of the example
    it is the target of, or the next one it is context for), trained, start (in
    the conversation's text), loss_start, loss_end (in the piece; equal if not
    trained), piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, position, example, start = object(), 0, 0, 0
        for batch in batches:
            out: list[tuple] = []
            for conv, role, text in zip(*(batch.column(i) for i in range(3))):
                conv = conv.as_py()
                if conv != own:
                    own, position, example, start = conv, 0, 0, 0
                role = role.as_py()
                piece, a, b = render(role, text.as_py())
                trained = role == TRAINED
                out.append((conv, position, example, trained, start, a if trained else b, b, piece))
                position, example, start = position + 1, example + trained, start + len(piece)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), _TYPES)] if out else
                [pa.array([], t) for t in _TYPES], names=_NAMES)

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"),
                        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (_by_conversation(rows, "turn", "role", "text").select("conv_id", "role", "text")
            .mapInArrow(run, FORMAT))


_NAMES = [x.split()[0] for x in FORMAT.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


def examples(stored: DataFrame) -> DataFrame:
    """The examples by reference: conv_id, example, target (position of its
    reply), context_chars, and where the reply's loss span is in its full text."""
    return stored.where("trained").select(
        "conv_id", "example", F.col("position").alias("target"), F.col("start").alias("context_chars"),
        (F.col("start") + F.col("loss_start")).alias("loss_start"),
        (F.col("start") + F.col("loss_end")).alias("loss_end"))


_STORED = ["conv_id", "example", "trained", "start", "loss_start", "loss_end", "piece"]


def _full(batches: Iterator[pa.RecordBatch], rest: bool = False) -> Iterator[tuple]:
    """(conversation, example, text, loss_start, loss_end) of every example in
    full.  With ``rest``, turns behind a conversation's last reply close a text
    of all its turns, which has no example's number and no loss."""
    own, text, ended = object(), "", True
    for batch in batches:
        for r in zip(*(batch.column(i) for i in range(len(_STORED)))):
            conv, example, trained, start, a, b, piece = (x.as_py() for x in r)
            if conv != own:
                if rest and not ended:
                    yield own, None, text, len(text), len(text)
                own, text = conv, ""
            if start != len(text):
                raise ValueError(f"conversation {conv}: a turn is missing before {start}")
            text, ended = text + piece, trained
            if trained:
                yield conv, example, text, start + a, start + b
    if rest and not ended:
        yield own, None, text, len(text), len(text)


def expand(stored: DataFrame) -> DataFrame:
    """Every example in full: conv_id, example, text, loss_start, loss_end.
    Its size is that of all prefixes; one conversation is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _full(batches):
            yield pa.RecordBatch.from_pylist([dict(zip(_EXAMPLE.names, row))], schema=_EXAMPLE)

    return (_by_conversation(stored, "position").select(*_STORED)
            .mapInArrow(run, "conv_id long, example long, text string, loss_start long, loss_end long"))


_EXAMPLE = pa.schema([("conv_id", pa.int64()), ("example", pa.int64()), ("text", pa.string()),
                      ("loss_start", pa.int64()), ("loss_end", pa.int64())])


def read_examples(stored: DataFrame) -> DataFrame:
    """The columns of ``read_back``, from every example in full: its loss span
    gives the trained text, its context has to be the example before it with the
    turns since, and the last text of a conversation gives its size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, before, state = object(), "", None
        done: list[tuple] = []

        def close() -> None:
            if state is not None:
                n, turns, chars, loss = state
                done.append((own, n, turns.hexdigest(), chars, loss.hexdigest(), len(before)))

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), _DIGEST)] if done else
                [pa.array([], t) for t in _DIGEST], names=_DIGEST_NAMES)
            done.clear()
            return out

        for conv, example, text, a, b in _full(batches, rest=True):
            if conv != own or state is None:
                close()
                own, before, state = conv, "", [0, hashlib.sha256(), 0, hashlib.sha256()]
                if len(done) >= 10_000:
                    yield flush()
            if not text.startswith(before) or (example is not None and text[b:] != CLOSE):
                raise ValueError(f"conversation {conv}: an example is not context and reply")
            for piece in text[len(before):].split(CLOSE)[:-1]:  # the mark is in no role or text
                role, said = parse(piece + CLOSE)
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
            trained = unescape(text[a:b])
            state[2] += len(trained)
            state[3].update(trained.encode())
            before = text
        close()
        yield flush()

    return (_by_conversation(stored, "position").select(*_STORED)
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                             "loss_sha256 string, formatted_chars long"))


def read_back(stored: DataFrame) -> DataFrame:
    """Per conversation, from the stored form alone: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state = object(), None
        done: list[tuple] = []

        def close() -> None:
            if state is not None:
                n, turns, chars, loss, total = state
                done.append((own, n, turns.hexdigest(), chars, loss.hexdigest(), total))

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*done), _DIGEST)] if done else
                [pa.array([], t) for t in _DIGEST], names=_DIGEST_NAMES)
            done.clear()
            return out

        for batch in batches:
            for r in zip(*(batch.column(i) for i in range(4))):
                conv, a, b, piece = (x.as_py() for x in r)
                if conv != own or state is None:
                    close()
                    own, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(piece)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                trained = unescape(piece[a:b])
                state[2] += len(trained)
                state[3].update(trained.encode())
                state[4] += len(piece)
            yield flush()
        close()
        yield flush()

    return (_by_conversation(stored, "position").select("conv_id", "loss_start", "loss_end", "piece")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                             "loss_sha256 string, formatted_chars long"))


_DIGEST_NAMES = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
_DIGEST = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
