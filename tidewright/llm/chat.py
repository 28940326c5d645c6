"""Chat formatting with masks aligned to token offsets.

A conversation is rendered as a whole and encoded once, with offsets. Control strings are tokens of their own. Turn spans and token
spans are both sorted, so the tokens of a span are found by binary search; a token's place under the loss mask is its overlap with an
assistant's text.

    [INST]role, line feed, text[/INST]        every role but assistant
    <s>text</s>                               assistant; the text is under the loss mask

Inside texts a backslash is doubled and a control string gets one after its first character; roles are percent-encoded.
Turns are ordered by turn, role and text, nulls first; null roles and texts are empty. A null conv_id is a conversation. Repeated
rows are turns of their own. An empty table gives no rows. One conversation is one training text and is held by one task, one at a
time; rows of other columns are not used.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.llm import common as c

CONTROL = ["</s>", "<s>", "[INST]", "[/INST]"]
_TURN = re.compile(r"\[INST\](.*?)\n(.*?)\[/INST\]|<s>(.*?)</s>", re.DOTALL)


def escaped(text: str) -> str:
    text = text.replace("\\", "\\\\")
    for control in CONTROL:
        text = text.replace(control, control[0] + "\\" + control[1:])
    return text


def unescaped(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def rendered(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The whole text, and the spans of the assistant's texts in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        body = escaped(text)
        if role == "assistant":
            spans.append((at + 3, at + 3 + len(body)))
            part = f"<s>{body}</s>"
        else:
            part = f"[INST]{quote(role, safe=' ')}\n{body}[/INST]"
        parts.append(part)
        at += len(part)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def parsed(text: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    return [("assistant", unescaped(m[3])) if m[3] is not None else (unquote(m[1]), unescaped(m[2])) for m in _TURN.finditer(text)]


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer, processors

    tokenizer = Tokenizer.from_file(path)
    tokenizer.post_processor = processors.ByteLevel(trim_offsets=False)  # white space belongs to its token
    tokenizer.add_special_tokens(CONTROL)
    return tokenizer


def masked(offsets: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per token, the part of it that lies in a span; empty where none does. Both inputs are sorted."""
    low, high = np.zeros(len(offsets), np.int64), np.zeros(len(offsets), np.int64)
    for start, end in spans.tolist():
        if start < end:
            a = np.searchsorted(offsets[:, 1], start, "right")
            b = np.searchsorted(offsets[:, 0], end, "left")
            low[a:b], high[a:b] = np.maximum(offsets[a:b, 0], start), np.minimum(offsets[a:b, 1], end)
    return low, high


FORMATTED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("loss_start", T.ArrayType(T.IntegerType())),
        T.StructField("loss_end", T.ArrayType(T.IntegerType())),
    ]
)
_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("text", pa.string()), ("ids", pa.list_(pa.int32())), ("loss_start", pa.list_(pa.int32())), ("loss_end", pa.list_(pa.int32()))]
)


def _format(path: str):
    def one(conv_id: int | None, turns: list[tuple[str, str]]) -> pa.RecordBatch:
        text, spans = rendered(turns)
        encoded = _tokenizer(path).encode(text, add_special_tokens=False)
        low, high = masked(np.array(encoded.offsets, np.int64).reshape(-1, 2), spans)
        columns = [[conv_id], [text], [encoded.ids], [low.tolist()], [high.tolist()]]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _ARROW)], schema=_ARROW)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, turns, ready, size = None, [], [], 0
        for conv_id, role, text in c.arrow_rows(batches, ["conv_id", "role", "text"]):
            if turns and conv_id != now:
                ready.append(one(now, turns))
                size += len(ready[-1].column("text")[0].as_py())
                turns = []
                if len(ready) >= 1_000 or size > 8 << 20:
                    yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
                    ready, size = [], 0
            now = conv_id
            turns.append((role or "", text or ""))
        if turns:
            ready.append(one(now, turns))
        if ready:
            yield from pa.Table.from_batches(ready).combine_chunks().to_batches()

    return run


def formatted(turns: DataFrame, path: str) -> DataFrame:
    """conv_id, text, ids, and per token the part under the loss mask (loss_start = loss_end: none)."""
    spark = turns.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), "role", "text")
    met = own.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return met.mapInArrow(_format(path), FORMATTED)


_READ = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)
_READ_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
)


def under_mask(text: str, starts: list[int], ends: list[int]) -> str:
    """Text under the mask; tokens that share a character count it once."""
    parts, done = [], 0
    for start, end in zip(starts, ends):
        if end > max(start, done):
            parts.append(text[max(start, done) : end])
            done = end
    return unescaped("".join(parts))


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[list] = [[] for _ in _READ_ARROW]
        for conv_id, text, starts, ends in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "text", "loss_start", "loss_end"))):
            turns = parsed(text)
            whole = "".join(f"{role}\n{body}\n" for role, body in turns)
            loss = under_mask(text, starts, ends)
            digests = [hashlib.sha256(x.encode()).hexdigest() for x in (whole, loss)]
            for column, value in zip(rows, (conv_id, len(turns), digests[0], len(loss), digests[1], len(text))):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, _READ_ARROW)], schema=_READ_ARROW)


def read_back(conversations: DataFrame) -> DataFrame:
    """Turns and loss text recovered from formatted conversations, as digests."""
    return conversations.mapInArrow(_read_back, _READ)
