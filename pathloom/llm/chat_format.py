"""Conversations as training text, assembled column by column.

A turn is a header, its text and a footer, by role.  Control strings that a text
itself holds get a backslash after their first character (one more than they had),
so the marks of the template stay the only ones and the text can be read back.
For a slice of turns numpy works out segment lengths, cumulative offsets and the
index of every byte; headers and texts are then copied by one gather into a
buffer that becomes the Arrow column.  Assistant texts are under the loss mask.

Rows are dealt out by ranges of (conversation, turn), so a conversation with very
many turns is formatted by several tasks, in parts that follow each other; a part
is at most a slice of text or one turn.  Only the digest of a conversation, which is
one after the other by nature, streams through a single task, a part at a time.

Defined results: a null text or role is empty; any role is allowed; turns are
ordered by turn (null first), then role, then text, and repeated rows are repeated
turns; rows with a null conv_id form one conversation with a null id; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.llm.base import query, table
from pathloom.llm.textcols import SLICE_BYTES, ragged, slices

#: Marks around a text by role; any other role is named in its header.
MARKS = {"system": ("<<SYS>>\n", "\n<</SYS>>\n"), "user": ("[INST] ", " [/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE={}] ", " [/ROLE]")
LEARNT = "assistant"

#: The control strings, behind their first character.
REST = r"(/?s>|</?SYS>>|/?INST\]|/?ROLE[=\]])"
ESCAPE = r"([<\[])(\\*)" + REST
ESCAPED = re.compile(r"([<\[])\\(\\*)" + REST)
HEADER = re.compile(r"<<SYS>>\n|\[INST\] |<s>|\[ROLE=([^\]]*)\] ")


def marks(role: str) -> tuple[str, str]:
    return MARKS.get(role) or (OTHER[0].format(quote(role, safe="")), OTHER[1])


def assemble(roles: list[str], texts, first: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Formatted text of each part and its loss spans in code points.  ``texts``
    holds the escaped texts, ``first`` the first turn of each part and the end."""
    n = len(roles)
    names, role = np.unique(np.array(roles, dtype=object).astype(str), return_inverse=True) if n else ([], np.empty(0, int))
    pieces = [m.encode() for name in names for m in marks(str(name))]
    size = np.array([len(p) for p in pieces], np.int64)
    place = np.cumsum(size) - size
    source = np.concatenate([np.frombuffer(b"".join(pieces), np.uint8), texts.buf])
    head = int(size.sum())
    # three segments a turn: header, text, footer
    length, start = np.empty((n, 3), np.int64), np.empty((n, 3), np.int64)
    length[:, 0], length[:, 1], length[:, 2] = size[2 * role], np.diff(texts.off), size[2 * role + 1]
    start[:, 0], start[:, 1], start[:, 2] = place[2 * role], head + texts.off[:-1], place[2 * role + 1]
    offset = np.concatenate([[0], np.cumsum(length.ravel())])
    out = np.empty(offset[-1], np.uint8)
    np.take(source, ragged(start.ravel(), length.ravel()), out=out)
    border = offset[3 * first]
    column = pa.LargeStringArray.from_buffers(len(first) - 1, pa.py_buffer(border.astype(np.int64)), pa.py_buffer(out)).cast(pa.string())
    # the mask in code points, counted from the start of the part
    char = np.concatenate([[0], np.cumsum((out & 0xC0) != 0x80)])
    learnt = np.flatnonzero(np.array([r == LEARNT for r in roles], bool))
    part = np.searchsorted(first, learnt, "right") - 1
    base = char[border[part]]
    spans = pa.StructArray.from_arrays(
        [pa.array(char[offset[3 * learnt + 1]] - base), pa.array(char[offset[3 * learnt + 2]] - base)], names=["start", "end"]
    )
    where = np.searchsorted(learnt, first).astype(np.int32)
    return column, pa.ListArray.from_arrays(pa.array(where), spans)


FORMATTED = "conv_id bigint, first_turn bigint, part bigint, n_turns bigint, formatted string, loss array<struct<start:bigint,end:bigint>>"


def format_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of conversations from turns in order.  A slice ends a part; its last
    conversation waits for more turns while it is short."""
    part, held = 0, None

    def out(rows: pa.Table, start: int) -> pa.RecordBatch:
        conv = rows.column("conv_id").combine_chunks()
        same = conv.to_pylist()
        first = np.array([i for i in range(len(same)) if i == 0 or same[i] != same[i - 1]] + [len(same)])
        escaped = pc.replace_substring_regex(pc.fill_null(rows.column("text").combine_chunks(), ""), ESCAPE, r"\1\\\2\3")
        texts = next(slices(escaped, 1 << 62))[2]
        column, loss = assemble([r or "" for r in rows.column("role").to_pylist()], texts, first)
        lead = pa.array(first[:-1])
        return pa.RecordBatch.from_arrays(
            [conv.take(lead), rows.column("turn").combine_chunks().take(lead), pa.array(np.arange(start, start + len(lead))),
             pa.array(np.diff(first)), column, loss],
            names=["conv_id", "first_turn", "part", "n_turns", "formatted", "loss"],
        )

    for batch in batches:
        whole = pa.Table.from_batches([batch])
        for a, b, _ in slices(whole.column("text")):
            rows = whole.slice(a, b - a)
            held = rows if held is None else pa.concat_tables([held, rows])
            ids = held.column("conv_id").to_pylist()
            cut = len(ids)
            while cut and ids[cut - 1] == ids[-1]:
                cut -= 1
            if held.slice(cut).nbytes >= SLICE_BYTES:
                cut = len(ids)
            if cut:
                made = out(held.slice(0, cut), part)
                part += made.num_rows
                yield made
                held = held.slice(cut).combine_chunks() if cut < len(ids) else None
    if held is not None:
        yield out(held, part)


def format_chats(conversations: DataFrame) -> DataFrame:
    """Parts of formatted conversations: conv_id, first_turn, part (these two order
    the parts of a conversation), n_turns, formatted text, loss spans."""
    rows = conversations.select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    dealt = rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(format_parts, FORMATTED)


def read_turns(formatted: str, loss: list[dict]) -> Iterator[tuple[str, str, bool]]:
    """Role, text and whether the text is under the loss mask, from a formatted part."""
    learnt = {(x["start"], x["end"]) for x in loss}
    at = 0
    while at < len(formatted):
        head = HEADER.match(formatted, at)
        if not head:
            raise ValueError(f"no header at {at}")
        known = {h: (role, f) for role, (h, f) in MARKS.items()}.get(head[0])
        role, footer = known or (unquote(head[1]), OTHER[1])
        start = head.end()
        end = formatted.index(footer, start)
        yield role, ESCAPED.sub(r"\1\2\3", formatted[start:end]), (start, end) in learnt
        at = end + len(footer)


def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, read back from its parts in order."""
    now, rows, open_ = None, [], False

    def close() -> None:
        rows.append((now["id"], now["turns"], now["all"].hexdigest(), now["loss_chars"], now["loss"].hexdigest(), now["chars"]))

    def out() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=[str(i) for i in range(6)])
        rows.clear()
        return made

    for batch in batches:
        for conv, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "loss"))):
            if not open_ or now["id"] != conv:
                if open_:
                    close()
                now, open_ = {"id": conv, "turns": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}, True
            now["chars"] += len(formatted)
            for role, text, learnt in read_turns(formatted, loss):
                now["turns"] += 1
                now["all"].update(f"{role}\n{text}\n".encode())
                if learnt:
                    now["loss"].update(text.encode())
                    now["loss_chars"] += len(text)
        if rows:
            yield out()
    if open_:
        close()
        yield out()


DIGEST = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"


def digest_chats(parts: DataFrame) -> DataFrame:
    dealt = parts.select("conv_id", "first_turn", "part", "formatted", "loss")
    dealt = dealt.repartition("conv_id").sortWithinPartitions("conv_id", "first_turn", "part")
    return dealt.mapInArrow(digest, DIGEST)


@query("op6_chat_format")
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest_chats(format_chats(turns.unionByName(more)))
