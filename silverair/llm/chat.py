"""Chat logs to final messages, and messages to masked training text.

A log holds one row per event: (conv_id, seq, message_id, kind, role, text). Kinds:
``message`` sets the text of a message, ``delta`` appends to it, ``edit`` replaces
it, ``regenerate`` empties it and removes all messages that began after it and
before the event. A message begins with its first event.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
# Control strings of common chat templates. Texts must not hold any of them.
CONTROLS = (
    START, SEPARATOR, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
OPENED = "([<\\[])(?=" + "|".join(re.sub(r"([|\[\]])", r"\\\1", c[1:]) for c in CONTROLS) + ")"
TURN = re.compile(f"{re.escape(START)}(.*?){re.escape(SEPARATOR)}(.*?){re.escape(END)}", re.DOTALL)


def reconstruct(log: DataFrame) -> DataFrame:
    """``conv_id``, ``position``, ``role`` and ``text`` of every message that is left at the end of the log.

    ``position`` is the sequence number of the message's first event, its role
    that of the first event that has one. Null texts count as empty, a null
    conversation is a conversation of its own, events of an unknown kind only
    begin a message. Events with one sequence number are ordered by kind and
    text. Extra columns are ignored; an empty log gives no messages.

    Only events from the last one that sets a text are gathered, so a cell holds
    one final text. Windows read sorted rows and spill.
    """
    message = Window.partitionBy("conv_id", "message_id")
    sets = F.col("kind").isin("message", "edit", "regenerate")
    events = log.select("conv_id", "seq", "message_id", "kind", "role", F.coalesce("text", F.lit("")).alias("text"))
    current = events.select(
        "*",
        F.min("seq").over(message).alias("position"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(message).alias("regenerated"),
        F.min(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).over(message)["role"].alias("speaker"),
        F.max(F.when(sets, F.struct("seq", "kind", "text"))).over(message).alias("base"),
    )
    appended = F.when(
        (F.col("kind") == "delta") & (F.col("base").isNull() | (F.col("seq") >= F.col("base.seq"))),
        F.struct("seq", "kind", "text"),
    )
    messages = current.groupBy("conv_id", "message_id", "position", "regenerated", "speaker", "base").agg(
        F.array_sort(F.collect_list(appended)).alias("deltas")
    )
    start = F.when(F.col("base.kind") == "regenerate", F.lit("")).otherwise(F.coalesce("base.text", F.lit("")))
    text = F.concat(start, F.array_join(F.transform("deltas", lambda d: d["text"]), ""))
    earlier = Window.partitionBy("conv_id").orderBy("position", "message_id").rowsBetween(Window.unboundedPreceding, -1)
    cut = F.max("regenerated").over(earlier)
    whole = messages.select("conv_id", "message_id", "position", "regenerated", F.col("speaker").alias("role"), text.alias("text"))
    left = whole.withColumn("cut", cut).where(F.col("cut").isNull() | (F.col("position") > F.col("cut")))
    return left.select("conv_id", "position", "role", "text")


def escape(text: Column) -> Column:
    """Double each backslash, and put one behind the first character of each control string."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), OPENED, "$1\\\\")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(messages: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One ``piece`` of training text per message, with the loss mask as a span of its code points.

    The pieces of a conversation, by ``position``, make up its text; they stay
    apart, so that no cell holds a whole conversation. The span
    (``loss_start``, ``loss_end``) covers the escaped text of ``learn_from`` turns
    and is empty for others. A null role is written as an empty one.
    """
    head = F.concat(F.lit(START), escape(F.coalesce("role", F.lit(""))), F.lit(SEPARATOR))
    body = escape(F.coalesce("text", F.lit("")))
    begin = F.length("head")
    end = F.when(F.col("role") == learn_from, begin + F.length("body")).otherwise(begin)
    parts = messages.select("conv_id", "position", "role", head.alias("head"), body.alias("body"))
    return parts.select(
        "conv_id",
        "position",
        F.concat("head", "body", F.lit(END)).alias("piece"),
        begin.alias("loss_start"),
        end.alias("loss_end"),
    )


class Reader:
    """Turns and masked text of one conversation, read from its pieces as they come."""

    def __init__(self) -> None:
        self.rest = ""
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def feed(self, piece: str, begin: int, end: int) -> None:
        self.chars += len(piece)
        masked = unescape(piece[begin:end])
        self.loss_chars += len(masked)
        self.loss.update(masked.encode())
        self.rest += piece
        done = 0
        for turn in TURN.finditer(self.rest):
            self.n_turns += 1
            self.turns.update(f"{unescape(turn[1])}\n{unescape(turn[2])}\n".encode())
            done = turn.end()
        self.rest = self.rest[done:]

    def row(self) -> list:
        return [self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars]


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation: counts and hashes of what a reader gets back from ``pieces``.

    A hash over a conversation takes its pieces in order, so they pass through one
    task, sorted by Spark. The task holds one turn and the state of two hashes.
    """
    columns = "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, reader, kind = None, None, None
        for batch in batches:
            kind = batch.column(0).type
            done = []
            for conv, piece, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if reader is None or conv != current:
                    if reader is not None:
                        done.append([current, *reader.row()])
                    current, reader = conv, Reader()
                reader.feed(piece, begin, end)
            yield batch_of(done, kind)
        if reader is not None:
            yield batch_of([[current, *reader.row()]], kind)

    def batch_of(rows: list[list], kind: pa.DataType) -> pa.RecordBatch:
        arrays = [pa.array([r[i] for r in rows], t) for i, t in enumerate([kind, *kinds])]
        return pa.RecordBatch.from_arrays(arrays, names)

    names = ["conv_id", *(c.split()[0] for c in columns.split(", "))]
    dealt = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "position")
    key = pieces.schema["conv_id"].dataType.simpleString()
    return dealt.select("conv_id", "piece", "loss_start", "loss_end").mapInArrow(read, f"conv_id {key}, {columns}")
