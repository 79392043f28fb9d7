"""Chat formatting with a grammar round trip.

Grammar, all a deterministic parser needs (``role`` and ``text`` are escaped):

    conversation = turn*
    turn         = "[INST]" role "\\n" text "[/INST]"      any role but the trained one
                 | "<s>" role "\\n" text "</s>"            the trained role

Each turn is first rendered as it is, parsed, and compared with its source. Only where the turn
does not come back identical is its content escaped, once more per round, until it does: one
backslash goes after the bracket of each control string, with or without backslashes there
already, and the parser takes one away. So control strings never stand inside a text.

Conversations are rendered in parts of bounded size: rows are dealt by conversation, sorted
(spilling to disk), and streamed, so one conversation may be as long as it likes.

Defined cases: a null text or role is empty; rows of one turn number are ordered by role and text,
and repeated rows are repeated turns; null turn numbers come first; rows with a null conversation
id form one conversation; an empty table gives no rows; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from cadence.llm.tables import only

TRAINED = "assistant"
PART_CHARS = 1 << 20
#: The control strings of the template.
OPEN, CLOSE, OPEN_TRAINED, CLOSE_TRAINED = "[INST]", "[/INST]", "<s>", "</s>"
_RAW = re.compile(r"\[/?INST\]|</?s>")
_CONTROL = re.compile(r"(\[|<)(\\*)(?=/?INST\]|/?s>)")
_ESCAPED = re.compile(r"(\[|<)(\\*)\\(?=/?INST\]|/?s>)")
PARTS = "conv_id long, part long, n_turns long, text string, mask array<struct<start:long,end:long>>"


def escape(text: str) -> str:
    return _CONTROL.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2", text)


def role_line(role: str) -> str:
    return role.replace("\\", "\\\\").replace("\n", "\\n")


def role_of(line: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], line)


def write_turn(role: str, text: str) -> str:
    head = f"{role_line(role)}\n"
    return f"{OPEN_TRAINED}{head}{text}{CLOSE_TRAINED}" if role == TRAINED else f"{OPEN}{head}{text}{CLOSE}"


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start, end) of each turn; the span is that of the escaped text. Raises ValueError off the grammar."""
    at, out = 0, []
    while at < len(rendered):
        if rendered.startswith(OPEN, at):
            begin, close = at + len(OPEN), CLOSE
        elif rendered.startswith(OPEN_TRAINED, at):
            begin, close = at + len(OPEN_TRAINED), CLOSE_TRAINED
        else:
            raise ValueError(f"no turn begins at {at}")
        line = rendered.find("\n", begin)
        end = rendered.find(close, line + 1)
        if line < 0 or end < 0:
            raise ValueError(f"the turn at {at} does not end")
        if _RAW.search(rendered, begin, end):
            raise ValueError(f"a control string stands inside the turn at {at}")
        role = role_of(unescape(rendered[begin:line]))
        if (role == TRAINED) != (close == CLOSE_TRAINED):
            raise ValueError(f"the turn at {at} has another role's marks")
        out.append((role, unescape(rendered[line + 1 : end]), line + 1, end))
        at = end + len(close)
    return out


def render_turn(role: str, text: str) -> str:
    """The turn, escaped as often as it takes to come back as it was."""
    line, body = role, text
    for _ in range(3):
        rendered = write_turn(line, body)
        try:
            if [t[:2] for t in parse(rendered)] == [(role, text)]:
                return rendered
        except ValueError:
            pass
        line, body = (role if role == TRAINED else escape(role)), escape(text)
    raise ValueError(f"turn of {role!r} can't be rendered reversibly")


def format_conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rendered parts: conv_id, part, n_turns, text, mask (spans of the trained role's texts, in code points).

    The parts of a conversation joined in order are its rendering; in each task they come in order, one
    conversation after another.
    """

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = object()
        now, part, turns, size = none, 0, [], 0

        def flush() -> pa.RecordBatch:
            rendered = "".join(turns)
            parsed = parse(rendered)
            if len(parsed) != len(turns):
                raise ValueError(f"conversation {now}: {len(turns)} turns went in, {len(parsed)} come back")
            mask = [{"start": s, "end": e} for r, _, s, e in parsed if r == TRAINED]
            return pa.RecordBatch.from_pylist([{"conv_id": now, "part": part, "n_turns": len(turns), "text": rendered, "mask": mask}], schema=schema)

        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("n_turns", pa.int64()), ("text", pa.string()), ("mask", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
        for batch in batches:
            for c, r, t in zip(batch["conv_id"].to_pylist(), batch["role"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if (c != now or size >= PART_CHARS) and turns:
                    yield flush()
                    part, turns, size = part + 1, [], 0
                if now is none or c != now:
                    now, part = c, 0
                turns.append(render_turn(r or "", t or ""))
                size += len(turns[-1])
        if turns:
            yield flush()

    rows = only(rows, conv_id=conv_id, turn=turn, role=role, text=text)
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(render, PARTS)
