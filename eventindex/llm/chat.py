"""Chat formatting from an event log.

A conversation is stored as events; they are partitioned by conversation, sorted by turn and
sequence, and folded into final messages:

| kind | effect on its turn |
| --- | --- |
| `message` (or null) | a complete message; a second one of the same turn is a message of its own |
| `delta` | its text is added to the last message of the turn, or begins one |
| `edit` | replaces the text (and the role, if it has one) of the last message |
| `regenerate` | empties the last message; deltas that follow fill it anew |

Events act on their own turn only, so sorted events are folded as a stream: a task holds one
message, never a conversation, however long it is. Messages are rendered as segments, one row each:

    ### role: text </turn>\\n

Inside roles and texts every `\\`, `#`, `/` after `<`, and (roles only) `:` gets a backslash before
it, so the control strings `###` and `</turn>` occur at turn borders only, and unescaping gives back
every text. `loss_from` and `loss_chars` are the span of a segment under the loss mask: the escaped
text of an assistant's message.

Defined results: null text and role are empty; null turns sort first; events that are equal in
turn and sequence are ordered by kind, role and text; a null conversation id is one conversation;
an empty table gives an empty result. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from eventindex.llm.common import rows_of

LEARNED = "assistant"
EVENT = "conv_id bigint, turn bigint, seq bigint, kind string, role string, text string"
SEGMENT = ("conv_id bigint, position bigint, role string, segment string, loss_from bigint, "
           "loss_chars bigint")
DIGEST = ("conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
          "loss_sha256 string, formatted_chars bigint")

_TEXT, _ROLE = re.compile(r"[\\#]|(?<=<)/"), re.compile(r"[\\#:]|(?<=<)/")
_ESCAPED = re.compile(r"\\(.)", re.S)
_SEGMENT = re.compile(r"### ((?:\\.|[^\\:])*): ((?:\\.|[^\\<]|<(?!/))*) </turn>\n", re.S)


def escape(text: str) -> str:
    return _TEXT.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The segment of a message, and its span under the loss mask."""
    head, body = "### " + _ROLE.sub(lambda m: "\\" + m[0], role) + ": ", escape(text)
    learned = role == LEARNED
    return f"{head}{body} </turn>\n", len(head) if learned else 0, len(body) if learned else 0


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a segment; the text span is what lies between the markers."""
    m = _SEGMENT.fullmatch(segment)
    if m is None:
        raise ValueError(f"not a segment: {segment[:80]!r}")
    return unescape(m[1]), unescape(m[2])


def events_of(turns: DataFrame) -> DataFrame:
    """A table of finished turns (conv_id, turn, role, text) as a log of messages."""
    return turns.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"),
                        F.lit(0).cast("bigint").alias("seq"), F.lit("message").alias("kind"),
                        F.col("role").cast("string"), F.col("text").cast("string"))


def fold(events: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted (conv_id, turn, kind, role, text) to (conv_id, role, text) of final messages."""
    at, role, parts = None, "", None
    for conv, turn, kind, new_role, text in events:
        key, kind, text = (conv, turn), kind or "message", text or ""
        if parts is not None and (key != at or kind == "message"):
            yield at[0], role, "".join(parts)
            parts = None
        if parts is None:
            at, role, parts = key, new_role or "", []
        if kind in ("edit", "regenerate"):
            parts, role = [], new_role or role
        if kind != "regenerate":
            parts.append(text)
    if parts is not None:
        yield at[0], role, "".join(parts)


def _render_task(batches: Iterator) -> Iterator:
    import pyarrow as pa

    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()),
                        ("segment", pa.string()), ("loss_from", pa.int64()),
                        ("loss_chars", pa.int64())])
    events = (e for b in batches for e in rows_of(b, "conv_id", "turn", "kind", "role", "text"))
    out, last, position = [[] for _ in schema.names], (), 0
    for conv, role, text in fold(events):
        position = position + 1 if last == (conv,) else 0
        last = (conv,)
        for column, v in zip(out, (conv, position, role, *render(role, text))):
            column.append(v)
        if len(out[0]) >= 1_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)],
                                             schema=schema)
            out = [[] for _ in out]
    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema)], schema=schema)


def format_log(events: DataFrame) -> DataFrame:
    """One row per final message, in order within each partition: conv_id, position, role,
    segment, loss_from, loss_chars. A conversation's segments joined by position are its text."""
    return (events.repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "seq", "kind", "role", "text")
            .mapInArrow(_render_task, SEGMENT))


def _digest_task(batches: Iterator) -> Iterator:
    import pyarrow as pa

    at, state = None, None

    def row():
        n, turns, loss, loss_n, chars = state
        return pa.RecordBatch.from_pydict({
            "conv_id": pa.array([at[0]], pa.int64()), "n_turns": [n],
            "turns_sha256": [turns.hexdigest()], "loss_chars": [loss_n],
            "loss_sha256": [loss.hexdigest()], "formatted_chars": [chars]})

    for batch in batches:
        for conv, segment, start, length in rows_of(batch, "conv_id", "segment", "loss_from",
                                                    "loss_chars"):
            if at != (conv,):
                if at is not None:
                    yield row()
                at, state = (conv,), [0, hashlib.sha256(), hashlib.sha256(), 0, 0]
            role, text = parse(segment)
            learned = unescape(segment[start:start + length])
            state[0] += 1
            state[1].update(f"{role}\n{text}\n".encode())
            state[2].update(learned.encode())
            state[3] += len(learned)
            state[4] += len(segment)
    if at is not None:
        yield row()


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation, from the formatted segments only: counts and digests of the roles
    and texts parsed out of them. `segments` must be as `format_log` returns them (conversations
    whole and in order within a partition)."""
    return segments.mapInArrow(_digest_task, DIGEST)
