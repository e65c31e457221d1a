"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as ``<|turn|>role<|text|>text<|end|>`` for each turn,
in order.  The three marks are added to the tokenizer as special tokens.  Inside
roles and texts a backslash is doubled and ``<|`` becomes ``<\\|``, so no text
can hold a mark and ``unescape`` gives back what was there.

The rendered conversation is encoded once, with offsets.  The spans of the
assistant texts are sorted, and so are the spans of the tokens: a binary search of
the former in the latter gives the tokens under the loss mask.  Special tokens
split the text before any merge, so no token reaches over the end of a span.

Turns are dealt by ranges of (conv_id, turn), so one conversation may span many
tasks; a task renders runs of turns of at most ``CHUNK_CHARS`` characters (or one
turn).  A chunk starts at a mark, so its tokens are those of the whole.

Null roles and texts are empty; a null conv_id is one conversation; turns with equal
numbers are ordered by role, then text; repeated rows are repeated turns; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlane.llm.common import bounded_batches

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CHUNK_CHARS = 1 << 20
RENDERED = re.compile(r"<\|turn\|>(.*?)<\|text\|>(.*?)<\|end\|>", re.DOTALL)
ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]], learned: str = "assistant") -> tuple[str, list[tuple[int, int]]]:
    """The formatted text of (role, text) turns and the spans of the texts to learn."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape(role)}{TEXT}", escape(text)
        if role == learned and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def mask_tokens(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens (sorted spans) lie in one of the sorted ``spans``."""
    mask = np.zeros(len(starts), np.uint8)
    if spans:
        a, b = np.array(spans).T
        for lo, hi in zip(np.searchsorted(starts, a, "left"), np.searchsorted(ends, b, "right"), strict=True):
            mask[lo:hi] = 1
    return mask


def parse(formatted: str) -> list[tuple[str, str]]:
    return [(unescape(role), unescape(text)) for role, text in RENDERED.findall(formatted)]


def loss_texts(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The unescaped text under each run of masked tokens."""
    on = np.concatenate(([0], mask.astype(np.int8), [0]))
    first, last = np.flatnonzero(np.diff(on) == 1), np.flatnonzero(np.diff(on) == -1) - 1
    return [unescape(formatted[starts[i]:ends[j]]) for i, j in zip(first.tolist(), last.tolist(), strict=True)]


def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (TURN, TEXT, END)])
    return tokenizer


CHUNKS = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("chunk", pa.int32()), ("formatted", pa.string()),
     ("ids", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary()), ("loss", pa.binary())]
)


def format_conversations(conversations: DataFrame, tokenizer_path: str) -> DataFrame:
    """Chunks of formatted conversations: conv_id, part and chunk (their order),
    formatted, ids (uint32), starts and ends (int32 offsets in code points) and loss
    (uint8) per token.  All but very long conversations are one or two chunks."""
    bounded_batches(conversations.sparkSession)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )

    def run(batches):
        from pyspark import TaskContext

        part, tokenizer, chunk = TaskContext.get().partitionId(), _tokenizer(tokenizer_path), 0
        held, size, conv = [], 0, None

        def flush():
            formatted, spans = render(held)
            e = tokenizer.encode(formatted, add_special_tokens=False)
            starts, ends = np.array(e.offsets, np.int32).reshape(-1, 2).T
            loss = mask_tokens(starts, ends, spans)
            ids = np.array(e.ids, "<u4")
            return (conv, part, chunk, formatted, *(x.tobytes() for x in (ids, starts, ends, loss)))

        for batch in batches:
            out = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if held and (conv_id != conv or size + len(text) > CHUNK_CHARS):
                    out.append(flush())
                    chunk, held, size = chunk + 1, [], 0
                conv = conv_id
                held.append((role, text))
                size += len(text)
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(CHUNKS.names, zip(*out, strict=True), strict=True)), schema=CHUNKS)
        if held:
            yield pa.RecordBatch.from_pydict(dict(zip(CHUNKS.names, zip(flush()), strict=True)), schema=CHUNKS)

    dealt = rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(
        run, "conv_id long, part int, chunk int, formatted string, ids binary, starts binary, ends binary, loss binary"
    )


def read_back(chunks: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars and
    n_tokens, parsed from the formatted text and the masked tokens alone.  A
    conversation's chunks are read in order, one at a time."""
    schema = pa.schema(
        [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
         ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_tokens", pa.int64())]
    )

    def run(batches):
        state = None

        def done(s):
            return (s["conv"], s["turns"], s["all"].hexdigest(), s["chars"], s["loss"].hexdigest(), s["size"], s["tokens"])

        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if state is None or state["conv"] != row["conv_id"]:
                    if state is not None:
                        out.append(done(state))
                    state = {"conv": row["conv_id"], "turns": 0, "chars": 0, "size": 0, "tokens": 0,
                             "all": hashlib.sha256(), "loss": hashlib.sha256()}
                for role, text in parse(row["formatted"]):
                    state["all"].update(f"{role}\n{text}\n".encode())
                    state["turns"] += 1
                starts, ends = np.frombuffer(row["starts"], np.int32), np.frombuffer(row["ends"], np.int32)
                for text in loss_texts(row["formatted"], starts, ends, np.frombuffer(row["loss"], np.uint8)):
                    state["loss"].update(text.encode())
                    state["chars"] += len(text)
                state["size"] += len(row["formatted"])
                state["tokens"] += len(starts)
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(*out, strict=True), strict=True)), schema=schema)
        if state is not None:
            yield pa.RecordBatch.from_pydict(dict(zip(schema.names, zip(done(state)), strict=True)), schema=schema)

    ordered = chunks.repartition("conv_id").sortWithinPartitions("conv_id", "part", "chunk")
    return ordered.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, n_tokens long"
    )


def _escaped_length(x: str) -> str:
    return f"length(replace(replace({x}, '\\', '\\\\'), '<|', '<\\|'))"


#: the query's rows: op2 adds conversation -1 to the table
ORACLE = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(TURN + TEXT + END)} + {_escaped_length('role')} + {_escaped_length('text')})::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
