"""Chat formatting with a grammar round trip.

A conversation is rendered as one ``<|im_start|>role`` line, the text and ``<|im_end|>`` for every turn. Each rendered turn is
parsed again by a deterministic parser; when the recovered role or text differs from the source, the conflicting control
sequences are escaped and the turn is rendered again until it is identical. The escape puts one more backslash between ``<``
and ``|`` of every ``<|``, ``<\\|``, ... of the text, and the parser takes exactly one away, so it is reversible and leaves texts
without such a sequence alone. Since every turn parses to itself, so does their concatenation.

Defined cases: null text or role is empty; turns are taken in order of (turn, role, text), null turns first, so repeated rows
stay and ties have one order; a null conversation id is a conversation of its own; an empty table gives an empty table; only
the four named columns are read, whatever else there is. A conversation longer than ``part_chars`` comes out in several part
rows, so neither a row nor a task ever holds more than one turn beyond that.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
PART_CHARS = 1 << 20
_CONTROL = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    return _CONTROL.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render_turn(role: str, text: str) -> tuple[str, int, int]:
    """The rendered turn, and where its text begins and ends in it."""
    plain = [(role, text), (role, escape(text)), (escape_role(role), escape(text))]
    for shown_role, shown in plain:
        turn = f"{START}{shown_role}\n{shown}{END}\n"
        if parse(turn) == [(role, text)]:
            start = len(START) + len(shown_role) + 1
            return turn, start, start + len(shown)
    raise ValueError(f"turn does not survive its grammar: {role!r}")


def turns_of(formatted: str) -> Iterator[tuple[str, str, str]]:
    """(role, text, text as rendered) of each turn; anything outside the grammar is an error."""
    at = 0
    while at < len(formatted):
        head = formatted.find("\n", at)
        tail = formatted.find(END, head + 1)
        if not formatted.startswith(START, at) or head < 0 or tail < 0 or formatted[tail + len(END) : tail + len(END) + 1] != "\n":
            raise ValueError(f"no turn at {at}")
        role, shown = formatted[at + len(START) : head], formatted[head + 1 : tail]
        if START in shown or END in role or START in role:
            raise ValueError(f"control string inside the turn at {at}")
        yield unescape_role(role), unescape(shown), shown
        at = tail + len(END) + 1


def parse(formatted: str) -> list[tuple[str, str]] | None:
    try:
        return [(role, text) for role, text, _ in turns_of(formatted)]
    except ValueError:
        return None


def _streams(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """All rows of a key in one task, in order; they stream through and are never held together."""
    return df.repartition(F.col(key)).sortWithinPartitions(F.col(key), *order)


def format_conversations(
    df: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", part_chars: int = PART_CHARS
) -> DataFrame:
    """(conv_id, part, formatted, loss): rendered conversations; ``loss`` lists the [start, end) of assistant texts in ``formatted``."""

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        pieces: list[str] = []
        spans: list[dict] = []
        current, size, part, open_ = None, 0, 0, False

        def close():
            rows.append((current, part, "".join(pieces), list(spans)))

        for batch in batches:
            for conv_id, who, said in zip(batch["conv"], batch["role"], batch["text"]):
                if not open_ or conv_id != current or size >= part_chars:
                    same = open_ and conv_id == current
                    if open_:
                        close()
                    part = part + 1 if same else 0
                    current, size, open_ = conv_id, 0, True
                    pieces, spans = [], []
                shown, start, end = render_turn(who, said)
                if who == "assistant":
                    spans.append({"start": size + start, "end": size + end})
                pieces.append(shown)
                size += len(shown)
            if len(rows) >= 256:
                yield pd.DataFrame(rows, columns=["conv", "part", "formatted", "loss"])
                rows = []
        if open_:
            close()
        if rows:
            yield pd.DataFrame(rows, columns=["conv", "part", "formatted", "loss"])

    read = df.select(
        # pandas turns a long column with nulls into doubles, so ids travel as text
        F.coalesce(F.col(conv).cast("string"), F.lit("")).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    shown = _streams(read, "conv", ["turn", "role", "text"]).mapInPandas(
        render, "conv string, part bigint, formatted string, loss array<struct<start:bigint,end:bigint>>"
    )
    return shown.select(F.when(F.col("conv") != "", F.col("conv")).cast(df.schema[conv].dataType).alias("conv_id"), "part", "formatted", "loss")


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns, digests and lengths of each formatted conversation, recovered from the formatted text alone.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline per turn), loss_chars and loss_sha256 (assistant texts under the
    loss spans, unescaped, nothing between), formatted_chars.
    """

    def recover(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        rows: list[tuple] = []
        current, state = None, None

        def close():
            n, turns, chars, loss, size = state
            rows.append((current, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for batch in batches:
            for conv_id, text, spans in zip(batch["conv"], batch["formatted"], batch["loss"]):
                if state is None or conv_id != current:
                    if state:
                        close()
                    current, state = conv_id, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said, _ in turns_of(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for span in spans:
                    learned = unescape(text[span["start"] : span["end"]])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(text)
            if rows:
                yield pd.DataFrame(rows, columns=columns)
                rows = []
        if state:
            close()
            yield pd.DataFrame(rows, columns=columns)

    parts = formatted.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"), "part", "formatted", "loss")
    back = _streams(parts, "conv", ["part"]).mapInPandas(
        recover, "conv string, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    )
    key = F.when(F.col("conv") != "", F.col("conv")).cast(formatted.schema["conv_id"].dataType).alias("conv_id")
    return back.select(key, *back.columns[1:])
