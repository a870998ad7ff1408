"""Conversations as training examples: one text, its token ids, and the tokens that count for the loss.

* Template. A turn is ``<|im_start|>role<|im_sep|>text<|im_end|>`` and a line feed. The three marks are
  special tokens, added to the vocabulary behind its own ids, so no token reaches over a mark and none
  holds text of two turns.
* Control strings in roles and texts, those of this template and of other common ones, get a backslash
  after their first character; one that has backslashes there already gets one more. Reading takes one
  away, so every text comes back as it was, and none can open or close a turn.
* Masks. A conversation is rendered as a whole and encoded once, with the place of each token in it. The
  spans of the texts of the roles that are learned are sorted, and so are the tokens; binary search
  gives the run of tokens that meets each span.

Rows are dealt out by conversation and sorted by turn; a task renders one conversation at a time, so
it holds no more than the longest one and an Arrow batch. A conversation is one training example
and must fit a task's memory several times over.

Defined results: rows of one conversation are ordered by turn, then role, then text, NULLs first, and
repeated rows stay. NULL roles and texts are empty. Rows without conversation id are one
conversation, whose id is NULL. Other columns are left out. No rows, no conversations.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
MARKS = (START, SEPARATOR, END)

# Strings that steer the formats of common chat models. None holds a backslash, and only
# their first characters occur in front of the rest.
CONTROL = (
    *MARKS,
    "<|endoftext|>",
    "<|startoftext|>",
    "<|system|>",
    "<|user|>",
    "<|assistant|>",
    "<|end|>",
    "<s>",
    "</s>",
    "<unk>",
    "[INST]",
    "[/INST]",
    "<<SYS>>",
    "<</SYS>>",
)

#: Opening character, backslashes, rest. A pattern that Spark, DuckDB and Python read alike.
CONTROL_PATTERN = "(<|\\[)(\\\\*)(" + "|".join(
    re.escape(rest) for rest in sorted({c[1:] for c in CONTROL if c[0] == "<"} | {c[1:] for c in CONTROL if c[0] == "["}, key=lambda r: (-len(r), r))
) + ")"

_control = re.compile(CONTROL_PATTERN)
_turn = re.compile(f"{re.escape(START)}(.*?){re.escape(SEPARATOR)}(.*?){re.escape(END)}\n", re.DOTALL)

#: Characters of conversations that are encoded at a time, or one longer conversation.
CHARS_AT_ONCE = 1 << 20


def escaped(text: str) -> str:
    return _control.sub(r"\1\\\2\3", text)


def unescaped(text: str) -> str:
    return _control.sub(lambda m: m[1] + m[2][1:] + m[3], text)


@dataclass
class Rendered:
    """One conversation as text, and where in it the learned texts lie."""

    text: str
    spans: list[tuple[int, int]]


def render(turns: Iterable[tuple[str | None, str | None]], learned: Sequence[str] = ("assistant",)) -> Rendered:
    parts: list[str] = []
    spans: list[tuple[int, int]] = []
    at = 0
    for role, text in turns:
        own = escaped(text or "")
        head = f"{START}{escaped(role or '')}{SEPARATOR}"
        begin = at + len(head)
        if (role or "") in learned:
            spans.append((begin, begin + len(own)))
        parts += [head, own, END, "\n"]
        at = begin + len(own) + len(END) + 1
    return Rendered("".join(parts), spans)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a rendered conversation."""
    out, at = [], 0
    for m in _turn.finditer(text):
        if m.start() != at:
            raise ValueError(f"no turn at character {at}")
        out.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    if at != len(text):
        raise ValueError(f"no turn at character {at}")
    return out


def runs_of_tokens(starts: np.ndarray, ends: np.ndarray, spans: Sequence[tuple[int, int]]) -> np.ndarray:
    """(first token, end token) of the tokens that meet each span, by binary search.

    Both bounds of the tokens ascend; several tokens may share the place of one character.
    """
    bounds = np.array(spans, np.int64).reshape(-1, 2)
    first = np.searchsorted(ends, bounds[:, 0], "right")
    end = np.searchsorted(starts, bounds[:, 1], "left")
    return np.stack([first, np.maximum(first, end)], axis=1)


def masked_text(text: str, starts: np.ndarray, ends: np.ndarray, runs: np.ndarray) -> str:
    """The learned texts, one after the other, as the tokens of the runs hold them.

    A character that several tokens share counts once.
    """
    return "".join(unescaped(text[int(starts[first]) : int(ends[end - 1])]) for first, end in runs if first < end)


class Encoder:
    """A tokenizer file with the marks added as special tokens."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import AddedToken, Tokenizer

        # Tasks are many already; a worker with threads of its own would slow down its neighbours.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.add_special_tokens([AddedToken(m, normalized=False) for m in MARKS])

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, starts, ends) of the tokens of each text; places count code points."""
        for one in self.tokenizer.encode_batch(texts, add_special_tokens=False):
            places = np.array(one.offsets, np.int64).reshape(-1, 2)
            yield np.array(one.ids, np.int32), places[:, 0], places[:, 1]


_encoders: dict[str, Encoder] = {}


def _encoder(tokenizer_json: str) -> Encoder:
    if tokenizer_json not in _encoders:
        _encoders.clear()
        _encoders[tokenizer_json] = Encoder(tokenizer_json)
    return _encoders[tokenizer_json]


SCHEMA = "conv_id long, formatted string, ids array<int>, starts array<int>, ends array<int>, loss_runs array<array<int>>"


def _conversations(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str | None, str | None]]]]:
    """Rows sorted by conversation, as conversations."""
    own: int | None = None
    turns: list[tuple[str | None, str | None]] = []
    for batch in batches:
        for conv, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            if turns and conv != own:
                yield own, turns
                turns = []
            own = conv
            turns.append((role, text))
    if turns:
        yield own, turns


def format_conversations(
    df: DataFrame,
    tokenizer_path: str,
    learned: Sequence[str] = ("assistant",),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, token ``ids``, their ``starts`` and ``ends`` in
    ``formatted``, and ``loss_runs``, a (first, end) range of tokens for each learned text."""
    with open(tokenizer_path, encoding="utf-8") as file:
        # A vocabulary; its size does not depend on the data.
        vocabulary = df.sparkSession.sparkContext.broadcast(file.read())
    learned = tuple(learned)
    rows = df.select(
        df[conv_col].cast("long").alias("conv"),
        df[turn_col].cast("long").alias("turn"),
        df[role_col].cast("string").alias("role"),
        df[text_col].cast("string").alias("text"),
    )

    def encode(encoder: Encoder, some: list[tuple[int | None, Rendered]]) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in range(6)]
        for (conv, one), (ids, starts, ends) in zip(some, encoder.encode([one.text for _, one in some])):
            runs = runs_of_tokens(starts, ends, one.spans)
            for column, value in zip(columns, (conv, one.text, ids, starts.astype(np.int32), ends.astype(np.int32), runs.tolist())):
                column.append(value)
        ints = pa.list_(pa.int32())
        kinds = (pa.int64(), pa.string(), ints, ints, ints, pa.list_(ints))
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "formatted", "ids", "starts", "ends", "loss_runs"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary.value)
        some: list[tuple[int | None, Rendered]] = []
        size = 0
        for conv, turns in _conversations(batches):
            one = render(turns, learned)
            if some and size + len(one.text) > CHARS_AT_ONCE:
                yield encode(encoder, some)
                some, size = [], 0
            some.append((conv, one))
            size += len(one.text)
        if some:
            yield encode(encoder, some)

    return rows.repartition(F.col("conv")).sortWithinPartitions("conv", "turn", "role", "text").mapInArrow(run, SCHEMA)


#: Conversations that are read at a time.
READ_AT_ONCE = 256
_READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("formatted_chars", pa.int64()),
        ("turns", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))),
        ("loss_text", pa.string()),
    ]
)
READ_SCHEMA = "conv_id long, formatted_chars long, turns array<struct<role string, text string>>, loss_text string"


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and learned text of formatted conversations, from their texts, places and runs alone."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, READ_AT_ONCE):
                lines = []
                for row in range(at, min(at + READ_AT_ONCE, batch.num_rows)):
                    text = batch.column(1)[row].as_py()
                    starts, ends = (batch.column(i)[row].values.to_numpy() for i in (2, 3))
                    loss = masked_text(text, starts, ends, np.array(batch.column(4)[row].as_py(), np.int64).reshape(-1, 2))
                    turns = [{"role": role, "text": own} for role, own in parse(text)]
                    lines.append({"conv_id": batch.column(0)[row].as_py(), "formatted_chars": len(text), "turns": turns, "loss_text": loss})
                yield pa.RecordBatch.from_pylist(lines, _READ)

    return formatted.select("conv_id", "formatted", "starts", "ends", "loss_runs").mapInArrow(run, READ_SCHEMA)
