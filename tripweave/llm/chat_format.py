"""Chat formatting from an event log.

A log holds, per conversation and in sequence: the start of a message with its role, streamed
deltas of its text, edits and regenerations. Folding gives the final messages: a message's text
is that of its last edit or regeneration, then the deltas after it; what followed a message
that was edited or regenerated later is gone, since the conversation went on from there.

Messages are folded one by one and never meet in a group of a whole conversation. Rendering is
one row per turn; a conversation's text is its rows in order. Reading back streams over sorted
rows and holds one turn at a time, so a conversation may have any number of turns.

Template: ``<turn>role\\ntext</turn>\\n``. In texts a backslash becomes two, and control strings
get one after their ``<``; roles also have their line ends written as ``\\n``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripweave.llm.common import written

OPEN, CLOSE = "<turn>", "</turn>"
LEARNED_ROLE = "assistant"
RESETS = ("edit", "regenerate")
#: Code points of a delta when whole texts are written as a log.
DELTA = 1000


def escaped(text: Column) -> Column:
    """A text in which no control string can be found."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit(OPEN), F.lit("<\\turn>"))
    return F.replace(text, F.lit(CLOSE), F.lit("<\\/turn>"))


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def as_events(turns: DataFrame) -> DataFrame:
    """A log of ``conv_id, turn, role, text`` rows: each row is a message that starts, then
    streams its text in deltas. Rows are numbered, so repeated rows stay messages apart."""
    numbered = written(turns.withColumn("message", F.monotonically_increasing_id()), "chat-turns")
    text = F.coalesce("text", F.lit(""))
    parts = F.transform(
        F.sequence(F.lit(0), F.ceil(F.length(text) / DELTA).cast("int")),
        lambda k: F.struct(
            k.cast("long").alias("part"),
            F.when(k == 0, F.lit("start")).otherwise(F.lit("delta")).alias("kind"),
            F.when(k > 0, F.substring(text, (k - 1) * DELTA + 1, F.lit(DELTA))).alias("text"),
        ),
    )
    return numbered.select(
        "conv_id", F.col("turn").alias("seq"), "message", "role", F.inline(parts)
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, message, at, role, text`` of a log with the columns ``conv_id,
    seq, part, message, kind, role, text``; ``(seq, part)`` orders a conversation's events.

    ``kind`` is start, delta, edit or regenerate. NULL texts add nothing. A message without a
    start begins at its first event. Events without a message number are ignored.
    """
    events = events.where("message is not null")
    order = F.struct("seq", "part")
    reset = F.col("kind").isin(*RESETS)
    messages = events.groupBy("conv_id", "message").agg(
        F.min("seq").alias("at"),
        F.min_by("role", order).alias("role"),
        F.max(F.when(reset, order)).alias("reset"),
        F.sort_array(
            F.collect_list(F.struct("seq", "part", F.coalesce("text", F.lit("")).alias("text")))
        ).alias("parts"),
    )
    live = F.filter(
        "parts",
        lambda p: F.col("reset").isNull()
        | (F.struct(p["seq"].alias("seq"), p["part"].alias("part")) >= F.col("reset")),
    )
    messages = messages.select(
        "conv_id",
        "message",
        "at",
        "role",
        F.array_join(F.transform(live, lambda p: p["text"]), "").alias("text"),
    )
    # A message is gone if a later reset goes back to a message before it. Only numbers of the
    # conversations that have resets are sorted for this. Numbers are a conversation's own.
    none = F.lit(None).cast("long")
    resets = events.where(reset).select("conv_id", "message", F.col("seq").alias("again"))
    starts = events.groupBy("conv_id", "message").agg(F.min("seq").alias("at"))
    back = _same(resets, starts, ["conv_id", "message"], "inner").select(
        "conv_id", F.col("again").alias("place"), F.col("at").alias("target"), none.alias("message")
    )
    marks = _same(starts, resets.select("conv_id").distinct(), ["conv_id"], "left_semi").select(
        "conv_id", F.col("at").alias("place"), none.alias("target"), "message"
    )
    later = Window.partitionBy("conv_id").orderBy(F.col("place").desc()).rangeBetween(
        Window.unboundedPreceding, -1
    )
    gone = (
        marks.unionByName(back)
        .withColumn("oldest", F.min("target").over(later))
        .where("message is not null and oldest < place")
        .select("conv_id", "message")
    )
    return _same(messages, gone, ["conv_id", "message"], "left_anti").select(
        "conv_id", "message", "at", "role", "text"
    )


def _same(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """A join on columns where NULL equals NULL; the left side's columns stay."""
    other = right.withColumnsRenamed({name: f"_{name}" for name in columns})
    alike = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in columns]
    return left.join(other, alike, how).drop(*(f"_{name}" for name in columns))


def render(messages: DataFrame) -> DataFrame:
    """One row per turn: ``conv_id, at, message, formatted, loss_start, loss_end``.

    The loss span is in code points of ``formatted`` and covers an assistant's escaped text,
    neither its header nor its end mark; other turns have an empty span.
    """
    role = F.replace(escaped(F.coalesce("role", F.lit(""))), F.lit("\n"), F.lit("\\n"))
    head = F.concat(F.lit(OPEN), role, F.lit("\n"))
    body = escaped(F.coalesce("text", F.lit("")))
    start = F.length(head)
    learned = F.col("role").eqNullSafe(LEARNED_ROLE)
    return messages.select(
        "conv_id",
        "at",
        "message",
        F.concat(head, body, F.lit(CLOSE + "\n")).alias("formatted"),
        F.when(learned, start).otherwise(0).alias("loss_start"),
        F.when(learned, start + F.length(body)).otherwise(0).alias("loss_end"),
    )


_TURN = re.compile(f"{OPEN}(.*?)\n(.*?){CLOSE}\n", re.S)


def read_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a rendered turn."""
    found = _TURN.fullmatch(formatted)
    if not found:
        raise ValueError("not a rendered turn")
    role = re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], found[1], flags=re.S)
    return role, unescaped(found[2])


class _Reader:
    """What is read back of one conversation, turn by turn."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns = self.formatted = self.learned = 0
        self.digest, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, formatted: str, start: int, end: int) -> None:
        role, text = read_turn(formatted)
        self.turns += 1
        self.formatted += len(formatted)
        self.digest.update(f"{role}\n{text}\n".encode())
        learned = unescaped(formatted[start:end])
        self.learned += len(learned)
        self.loss.update(learned.encode())

    def row(self) -> tuple:
        return (
            self.conv_id, self.turns, self.digest.hexdigest(), self.learned,
            self.loss.hexdigest(), self.formatted,
        )


_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by conversation and place."""
    reader, done = None, []

    def emit() -> pa.RecordBatch:
        columns = zip(*done) if done else [()] * len(_READ)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, field.type) for c, field in zip(columns, _READ)], schema=_READ
        )

    for batch in batches:
        for conv_id, *turn in zip(*(column.to_pylist() for column in batch.columns)):
            if reader is None or conv_id != reader.conv_id:
                if reader:
                    done.append(reader.row())
                reader = _Reader(conv_id)
            reader.add(*turn)
        if len(done) > 5000:
            yield emit()
            done = []
    if reader:
        done.append(reader.row())
    yield emit()


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation: turns, digests of turns and of the text under the loss mask, and sizes,
    all read from the rendered rows. Turns of one place are ordered by their formatted text."""
    return (
        rendered.repartition("conv_id")
        .sortWithinPartitions("conv_id", "at", "formatted")
        .select("conv_id", "formatted", "loss_start", "loss_end")
        .mapInArrow(
            _read_batches,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long,"
            " loss_sha256 string, formatted_chars long",
        )
    )


def format_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` rows by way of their event log to rendered turns.

    NULL text and NULL role count as empty; a NULL turn comes first; rows without a
    conversation are one conversation. Repeated rows are turns of their own. Other columns of
    the input are not read.
    """
    turns = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    return render(fold(as_events(turns)))
