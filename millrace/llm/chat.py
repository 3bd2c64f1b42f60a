"""Chat formatting with a grammar round trip.

A conversation is rendered as turns ``### role: text</turn>`` and a line feed each. Rendering is proved by parsing: the rendered turn goes through the
deterministic parser, and where role and text do not come back as they were, conflicting content is escaped a step further until they do.
The steps are: as it is; control strings with a backslash before them; every backslash doubled as well. The last one always comes back.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, NAMED, CLOSE = "### ", ": ", "</turn>"
LEARNED = "assistant"
#: Characters of rendered text that a task gathers before it hands them on.
FLUSH_CHARS = 1 << 22

_CONTROL = re.compile(r"### |</turn>|: ")
_MARKS = re.compile(r"\\[\\#<:]|### |</turn>|: ")
_ESCAPED = re.compile(r"\\([\\#<:])")


class GrammarError(ValueError):
    """The string is no sequence of turns."""


def escape(text: str, step: int) -> str:
    if step > 1:
        text = text.replace("\\", "\\\\")
    return _CONTROL.sub(lambda m: "\\" + m[0], text) if step else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _until(rendered: str, at: int, stop: str, passing: str | None) -> int:
    """Where ``stop`` begins; escaped marks and ``passing`` are passed over, any other control string is an error."""
    while m := _MARKS.search(rendered, at):
        if m[0] == stop:
            return m.start()
        if m[0][0] != "\\" and m[0] != passing:
            break
        at = m.end()
    raise GrammarError(f"no {stop!r} after {at}")


def turn_at(rendered: str, at: int) -> tuple[str, str, int, int, int]:
    """The turn that begins at ``at``: role, text, start and end of the text as rendered, and where the next turn begins."""
    if not rendered.startswith(OPEN, at):
        raise GrammarError(f"no turn at {at}")
    named = _until(rendered, at + len(OPEN), NAMED, None)
    start = named + len(NAMED)
    end = _until(rendered, start, CLOSE, NAMED)
    after = end + len(CLOSE)
    if not rendered.startswith("\n", after):
        raise GrammarError(f"no line feed at {after}")
    return unescape(rendered[at + len(OPEN) : named]), unescape(rendered[start:end]), start, end, after + 1


def parse(rendered: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start and end of the text as rendered) for each turn."""
    turns, at = [], 0
    while at < len(rendered):
        role, text, start, end, at = turn_at(rendered, at)
        turns.append((role, text, start, end))
    return turns


def render(role: str, text: str) -> tuple[str, int]:
    """One turn, and how far it had to be escaped."""
    for step in (0, 1, 2):
        turn = f"{OPEN}{escape(role, step)}{NAMED}{escape(text, step)}{CLOSE}\n"
        try:
            if [t[:2] for t in parse(turn)] == [(role, text)]:
                return turn, step
        except GrammarError:
            continue
    raise AssertionError("a fully escaped turn must come back")


def format_conversations(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learned: str = LEARNED
) -> DataFrame:
    """One row per conversation: ``conv_col``, ``formatted``, ``loss`` (starts and ends, in code points, of the learned role's texts) and ``n_escaped``.

    Turns stand by turn number, nulls first; of equal numbers by role and text, and a row given twice is two turns. A null role or text is empty. Rows
    with a null conversation id make one conversation. The finished conversation is parsed once more and must give all its turns. A task holds the rendered
    text of one conversation at a time (it is one value of the result), its rows arrive sorted. An empty table gives no row; other columns are not read.
    """
    given = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = given.schema["conv"].dataType.simpleString()
    ordered = given.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    loss_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv_type, open_, conv, chars = None, False, None, 0
        pieces: list[str] = []
        source: list[tuple[str, str]] = []
        escaped = 0

        def finish() -> int:
            formatted = "".join(pieces)
            back = parse(formatted)
            if [t[:2] for t in back] != source:
                raise AssertionError("the formatted conversation must give back its turns")
            loss = [{"start": s, "end": e} for role, _, s, e in back if role == learned]
            done.append((conv, formatted, loss, escaped))
            return len(formatted)

        def out() -> pa.RecordBatch:
            columns = zip(*done)
            types = (conv_type, pa.string(), loss_type, pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["conv", "formatted", "loss", "n_escaped"])

        for batch in batches:
            conv_type = batch.schema.field(0).type
            for own, _, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if open_ and own != conv:
                    chars += finish()
                    pieces, source, escaped = [], [], 0
                    if chars > FLUSH_CHARS:
                        yield out()
                        done, chars = [], 0
                open_, conv = True, own
                turn, step = render(role, text)
                pieces.append(turn)
                source.append((role, text))
                escaped += step > 0
        if open_:
            finish()
            yield out()

    fields = f"conv {kind}, formatted string, loss array<struct<start: bigint, end: bigint>>, n_escaped bigint"
    return ordered.mapInArrow(task, fields).withColumnRenamed("conv", conv_col)


def digests(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What formatted conversations give back: turns and text under the loss mask, as counts and SHA-256."""
    given = formatted.select(F.col(conv_col).alias("conv"), "formatted", "loss")
    kind = given.schema["conv"].dataType.simpleString()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for formatted_, loss in zip(batch.column(1), batch.column(2)):
                whole = formatted_.as_py()
                turns = parse(whole)
                all_ = hashlib.sha256()
                for role, text, _, _ in turns:
                    all_.update(f"{role}\n{text}\n".encode())
                masked = "".join(unescape(whole[s["start"] : s["end"]]) for s in loss.as_py())
                rows.append((len(turns), all_.hexdigest(), len(masked), hashlib.sha256(masked.encode()).hexdigest(), len(whole)))
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=["conv", *names])

    out = given.mapInArrow(task, f"conv {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
    return out.withColumnRenamed("conv", conv_col)
