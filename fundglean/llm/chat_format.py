"""Chat formatting from an event log.

Events carry ``conv_id``, ``message`` (any orderable key of the message within its
conversation), ``seq``, ``kind``, ``role`` and ``text``. A ``delta`` appends its text
to the message; an ``edit`` replaces what the message says; a ``regenerate`` clears it,
and later deltas build it anew. A message's role is the last one given that is not
null. Events of one message meet in one task, sorted by ``seq``; a conversation of any
length is therefore spread by its messages.

Rendering is per message, ``<|im_start|>role``, newline, text, ``<|im_end|>``, newline;
a conversation's string is its messages' strings in order of ``message``. Control
strings inside roles and texts get a backslash after their first character, and each
backslash is doubled, so that ``unescape`` gives back the exact text. The loss mask of
a message is one span of code points in its string: the assistant's text, else none.

Edge cases: null texts are empty deltas; a null role is an empty one; a null kind is
a delta; null conversation ids form one conversation; events with equal ``seq`` apply in
order of kind, then text; repeated events apply each time; no events give no rows;
columns besides those named are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that common chat templates read as control strings.
CONTROL = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
           "<<SYS>>", "<</SYS>>")
ASSISTANT = "assistant"
MASKED = re.compile(r"\\(.)", re.S)


def reconstruct(events: DataFrame) -> DataFrame:
    """``conv_id``, ``message``, ``role``, ``text``: the final messages of all conversations."""
    event = F.struct(
        "seq",
        F.coalesce("kind", F.lit("delta")).alias("kind"),
        F.coalesce("text", F.lit("")).alias("text"),
        "role",
    )
    ordered = F.sort_array(F.collect_list(event))
    folded = events.groupBy("conv_id", "message").agg(ordered.alias("events"))
    # What counts begins at the last event that starts the message anew.
    start = F.array_max(
        F.transform("events", lambda e, i: F.when(e["kind"].isin("edit", "regenerate"), i))
    )
    counting = F.slice("events", F.coalesce(start, F.lit(0)) + 1, F.size("events"))
    said = F.transform(
        counting, lambda e: F.when(e["kind"] == "regenerate", "").otherwise(e["text"])
    )
    roles = F.filter("events.role", lambda r: r.isNotNull())
    return folded.select(
        "conv_id",
        "message",
        F.coalesce(F.get(roles, F.size(roles) - 1), F.lit("")).alias("role"),
        F.array_join(said, "").alias("text"),
    )


def escaped(text: Column) -> Column:
    rest = "|".join(re.escape(x[1:]) for x in CONTROL)
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, rf"([<\[])(?={rest})", r"$1\\")


def unescape(text: str) -> str:
    return MASKED.sub(r"\1", text)


def render(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``message``, ``formatted``, ``loss_start``, ``loss_end`` (code points, end excluded).

    The span counts from the start of the message's own string; both ends are equal if
    nothing is trained on.
    """
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit("\\\n"))
    shown = messages.select("conv_id", "message", "role", role.alias("tag"), escaped(F.col("text")).alias("body"))
    start = F.length("tag") + len(START) + 1
    length = F.when(F.col("role") == ASSISTANT, F.length("body")).otherwise(0)
    return shown.select(
        "conv_id",
        "message",
        F.concat(F.lit(START), "tag", F.lit("\n"), "body", F.lit(END + "\n")).alias("formatted"),
        start.alias("loss_start"),
        (start + length).alias("loss_end"),
    )


def turn_events(conversations: DataFrame) -> DataFrame:
    """A log with one delta for each row of ``conv_id``, ``turn``, ``role``, ``text``.

    Rows of one turn stay messages of their own, in order of role and text.
    """
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return conversations.select(
        "conv_id",
        F.struct(F.col("turn").alias("turn"), F.row_number().over(same).alias("place")).alias("message"),
        F.col("turn").alias("seq"),
        F.lit("delta").alias("kind"),
        "role",
        "text",
    )


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of one message's string."""
    body = formatted[len(START) : -len(END) - 1]
    i = 0
    while body[i] != "\n":
        i += 2 if body[i] == "\\" else 1
    return unescape(body[:i]), unescape(body[i + 1 :])


def digests(rendered: DataFrame) -> DataFrame:
    """What a reader of the output finds in each conversation, message by message.

    Each conversation's rows stream through one task in order; only running digests
    are held. A digest is sequential, so this step cannot split a conversation.
    """

    kind_of_id = rendered.schema["conv_id"].dataType
    arrow_id = to_arrow_type(kind_of_id)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
        now: object = read  # no conversation yet
        turns = loss = None
        counts = [0, 0, 0]
        done: list[tuple] = []

        def close() -> None:
            if now is not read:
                done.append((now, counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]))

        def batch_of() -> pa.RecordBatch:
            values = list(zip(*done, strict=True)) if done else [[]] * 6
            kinds = (arrow_id, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(v, kind) for v, kind in zip(values, kinds, strict=True)], list(names)
            )

        for batch in batches:
            for conv, formatted, start, end in zip(
                *(batch.column(i).to_pylist() for i in range(4)), strict=True
            ):
                if conv != now or now is read:
                    close()
                    now, turns, loss, counts = conv, hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                role, text = parse(formatted)
                trained = unescape(formatted[start:end])
                turns.update(f"{role}\n{text}\n".encode())
                loss.update(trained.encode())
                counts[0] += 1
                counts[1] += len(trained)
                counts[2] += len(formatted)
            yield batch_of()
            done.clear()
        close()
        yield batch_of()

    schema = (
        f"conv_id {kind_of_id.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, "
        "loss_sha256 string, formatted_chars long"
    )
    return (
        rendered.repartition("conv_id")
        .sortWithinPartitions("conv_id", "message")
        .select("conv_id", "formatted", "loss_start", "loss_end")
        .mapInArrow(read, schema)
    )


def format_conversations(conversations: DataFrame) -> DataFrame:
    return render(reconstruct(turn_events(conversations)))
