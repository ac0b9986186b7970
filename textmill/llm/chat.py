"""Chat formatting by a grammar round trip.

A turn of the assistant is ``<s>text</s>`` and any other turn ``[INST] role``, a line end, its text and
``[/INST]``; a line end follows each turn. The parser is deterministic: a control string inside a text is an
error, and a backslash after the first character of one is taken off. A turn is first rendered as it is and
read back; where the reading differs, or fails, its control strings get one backslash more and it is read again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textmill.llm.rows import columns, map_batches

# The template's control strings, with the backslashes that escaping puts after the first character.
CONTROL = r"([\[<])(\\*)(/?INST\]|/?s>)"
_control = re.compile(CONTROL)
_stray = re.compile(r"\[/?INST\]|</?s>")
_assistant = re.compile(r"<s>(.*?)</s>\n", re.DOTALL)
_other = re.compile(r"\[INST\] ([^\n]*)\n(.*?)\[/INST\]\n", re.DOTALL)
SPEAKER = "assistant"


def escape(text: str) -> str:
    return _control.sub(lambda m: m[1] + "\\" + m[2] + m[3], text)


def unescape(text: str) -> str:
    return _control.sub(lambda m: m[1] + m[2][1:] + m[3], text)


def escape_role(role: str) -> str:
    """A role is one line: its backslashes are doubled and its line ends written as ``\\n``."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def render(role: str, body: str) -> str:
    return f"<s>{body}</s>\n" if role == SPEAKER else f"[INST] {escape_role(role)}\n{body}[/INST]\n"


def parse(formatted: str) -> list[tuple[str, str, int, int]]:
    """(role, text, start and end of the raw text under the loss mask; equal where there is none) for each turn."""
    turns, at = [], 0
    while at < len(formatted):
        if found := _assistant.match(formatted, at):
            role, body, mask = SPEAKER, found[1], found.span(1)
        elif found := _other.match(formatted, at):
            role, body, mask = unescape_role(found[1]), found[2], (at, at)
        else:
            raise ValueError("no turn begins here")
        if _stray.search(body):
            raise ValueError("a control string inside a text")
        turns.append((role, unescape(body), *mask))
        at = found.end()
    return turns


def format_turn(role: str, text: str) -> str:
    """The rendered turn, which reads back as (role, text)."""
    body = text
    while True:
        formatted = render(role, body)
        try:
            if [turn[:2] for turn in parse(formatted)] == [(role, text)]:
                return formatted
        except ValueError:
            pass
        # Each round adds one backslash to every control string, which is what reading takes off: two rounds at most.
        body = escape(text)


def format_turns(conversations: DataFrame) -> DataFrame:
    """Each row of (conv_id, turn, role, text) with ``formatted``, its part of the conversation's string.

    A conversation's string is its parts by turn, then role, then text, and each part parses on its own. Null
    roles and texts are empty ones; repeated rows are turns of their own; a null conv_id is a conversation, and a
    null turn comes first. Other columns are left out; no rows give no rows. No shuffle.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        said = zip(batch.column("role").to_pylist(), batch.column("text").to_pylist(), strict=True)
        made = pa.array([format_turn(role, text) for role, text in said], pa.string())
        return pa.RecordBatch.from_arrays([*batch.columns, made], [*batch.schema.names, "formatted"])

    rows = columns(conversations, conv_id="long", turn="long", role="string", text="string")
    rows = rows.fillna("", ["role", "text"])
    return map_batches(rows, work, "conv_id long, turn long, role string, text string, formatted string")


class _Reading:
    """What reading a conversation's formatted parts in order gives; grows with no part of the conversation."""

    def __init__(self):
        self.turns = self.loss_chars = self.chars = 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def take(self, formatted: str) -> None:
        self.chars += len(formatted)
        for role, text, start, end in parse(formatted):
            self.turns += 1
            self.said.update(f"{role}\n{text}\n".encode())
            if role == SPEAKER:
                learned = unescape(formatted[start:end])
                self.loss_chars += len(learned)
                self.loss.update(learned.encode())

    def result(self) -> tuple:
        return self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(formatted: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, parsed from ``formatted`` alone.

    Rows of a conversation stream by in order and only digests are held, so its length does not matter.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [field.split()[0] for field in DIGESTS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        current, reading = None, None
        for batch in batches:
            done = []
            for conv, part in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist(), strict=True):
                if reading is None or conv != current:
                    if reading is not None:
                        done.append((current, *reading.result()))
                    current, reading = conv, _Reading()
                reading.take(part)
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, k) for v, k in zip(zip(*done, strict=True), kinds, strict=True)], names
                )
        if reading is not None:
            last = (current, *reading.result())
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(last, kinds, strict=True)], names)

    together = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return together.select("conv_id", "formatted").mapInArrow(run, DIGESTS)


def chat_format(conversations: DataFrame) -> DataFrame:
    """Formatted parts of all conversations, and conversation -7, whose texts are control strings."""
    hard = "</s>[INST] ok [/INST]"
    added = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string"
    )
    rows = columns(conversations, conv_id="long", turn="long", role="string", text="string")
    return format_turns(rows.unionByName(added))


SQL = r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), measured as (
    select *,
        length(text) + len(regexp_extract_all(text, '[\[<]\\*(?:/?INST\]|/?s>)')) as body,
        length(role) as named
    from turns
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    cast(sum(body + case when role = 'assistant' then 8 else named + 16 end) as bigint) as formatted_chars
from measured group by conv_id
"""
