"""Chat formatting by event-sourced reconstruction.

A log of events is partitioned by conversation, sorted, and folded into final
messages: ``message`` starts one or sets its text, ``delta`` appends to it (and
starts it if need be), ``edit`` replaces its text, ``regenerate`` empties it and
takes back every message started after it, ``delete`` removes it. The messages
of a conversation are then rendered into one text:

    <|im_start|>role NEWLINE text <|im_end|> NEWLINE

Control strings inside a text get a backslash after their first character (one
more where there are some already), which ``unescape`` takes out again, so the
template's own marks are the only ones and every text can be read back as it
was. The loss mask is the spans of the assistant texts, as code points.

Rows stream through a task in sorted order and only the conversation at hand is
held, which has to fit one row of the result anyway.

Defined results: null texts and roles are empty; an event of an unknown kind is
ignored; ties in the order are broken by the kind and text of the event, so the
result does not depend on how rows arrive; rows with a null conversation id form
one conversation; an empty log gives no rows; a conversation without messages
left is formatted as an empty text. Only the named columns are read, so extra
ones cannot clash. Texts are read whole.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
REST = r"(\||/?s>|/?INST\]|</?SYS>>)"
CONTROL = re.compile(r"([<\[])(\\*)" + REST)
ESCAPED = re.compile(r"([<\[])\\(\\*)" + REST)
TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + r"\n", re.DOTALL)
BATCH_CHARS = 8 << 20
FORMATTED = pa.schema([("conv_id", pa.int64()), ("formatted", pa.string()),
                       ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def escape(text: str) -> str:
    return CONTROL.sub(r"\1\\\2\3", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text)


def _role(role: str) -> str:
    """Roles stand on one line: line ends and backslashes are spelled out."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unrole(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def fold(events: list[tuple]) -> list[tuple[str, str]]:
    """(role, text) of the final messages; events are (kind, message, role, text) in order."""
    at: dict = {}  # message -> [role, pieces of text]; a dict keeps the order of starts
    for kind, message, role, text in events:
        if kind in ("message", "delta", "edit"):
            own = at.setdefault(message, [role or "", []])
            if kind != "delta":
                own[1].clear()
            own[1].append(text or "")
        elif kind == "regenerate" and message in at:
            order = list(at)
            for later in order[order.index(message) + 1:]:
                del at[later]
            at[message][1].clear()
        elif kind == "delete":
            at.pop(message, None)
    return [(role, "".join(pieces)) for role, pieces in at.values()]


def render(turns: list[tuple[str, str]]) -> tuple[str, list[dict]]:
    """The formatted text and the spans under the loss mask."""
    parts, loss, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{_role(role)}\n", escape(text)
        if role == "assistant":
            loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
        parts += [head, body, END, "\n"]
        at += len(head) + len(body) + len(END) + 1
    return "".join(parts), loss


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns that a formatted text was rendered from."""
    return [(_unrole(m[1]), unescape(m[2])) for m in TURN.finditer(formatted)]


def _fold_sorted(batches):
    rows, size, conv, events = [], 0, None, []

    def done():
        text, loss = render(fold(events))
        rows.append((conv, text, loss))
        return len(text)

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], FORMATTED.field(i).type) for i in range(3)], schema=FORMATTED)

    for b in batches:
        for c, *event in zip(*(col.to_pylist() for col in b.columns)):
            if events and c != conv:
                size += done()
                events = []
                if size >= BATCH_CHARS:
                    yield out()
                    rows, size = [], 0
            conv = c
            events.append(tuple(event))
    if events:
        done()
    if rows:
        yield out()


def format_conversations(events: DataFrame, order: list[str], conv_col: str = "conv_id", kind_col: str = "kind",
                         message_col: str = "message", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (spans of code points)."""
    log = events.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(kind_col).alias("kind"),
                        F.col(message_col).alias("message"), F.col(role_col).alias("role"),
                        F.col(text_col).alias("text"), F.struct(*order).alias("at"))
    dealt = log.repartition("conv_id").sortWithinPartitions("conv_id", "at", "message", "kind", "text")
    return dealt.drop("at").mapInArrow(
        _fold_sorted, "conv_id long, formatted string, loss array<struct<start:long, end:long>>")


def digests(formatted: DataFrame) -> DataFrame:
    """What each formatted text says, read back from it and its loss spans."""
    def run(batches):
        for b in batches:
            rows = []
            for text, loss in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                turns = parse(text)
                said = "".join(f"{role}\n{body}\n" for role, body in turns)
                learned = "".join(unescape(text[s["start"]:s["end"]]) for s in loss)
                rows.append((len(turns), _sha(said), len(learned), _sha(learned), len(text)))
            kinds = (("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(kinds))],
                names=["conv_id", *(n for n, _ in kinds)])

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                                     "loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def log_of(conversations: DataFrame, chunk: int = 256) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as an event log.

    Assistant turns are streamed: a draft, its regeneration, then chunks of the
    text. Other turns are sent in part and then edited to the whole.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("message"))
    streamed = F.expr(f"""concat(
        array(struct('delta' AS kind, left(text, 16) AS text), struct('regenerate' AS kind, '' AS text)),
        transform(sequence(0, greatest(0, (length(text) - 1) div {chunk})),
                  i -> struct('delta' AS kind, substring(text, cast(i * {chunk} + 1 AS int), {chunk}) AS text)))""")
    edited = F.expr("array(struct('message' AS kind, left(text, 16) AS text), struct('edit' AS kind, text AS text))")
    rows = rows.withColumn("events", F.when(F.col("role") == "assistant", streamed).otherwise(edited))
    # equal turns of a conversation keep apart by message; equal rows are alike anyway
    return rows.select("conv_id", "turn", "message", "role", F.xxhash64("role", "text").alias("tie"),
                       F.posexplode("events").alias("step", "event")).select(
        "conv_id", "turn", "tie", "message", "step", "role", F.col("event.kind").alias("kind"),
        F.col("event.text").alias("text"))
