"""Conversations as chat-formatted texts with loss spans, assembled column by column; and the way back.

A turn is written as ``### <role>: <text></turn>`` and a line feed. Inside roles and texts a backslash goes before each
backslash, before each ``#`` that begins ``###`` and before each ``<`` that begins ``</turn>``; inside roles also before each
colon. So no control string stands unescaped in a text, and reading takes away exactly what writing put in.

Rows are dealt by ranges of (conversation, turn), so that a conversation of any size spreads over tasks, and are sorted
there. A batch is assembled at once: the lengths of all segments (header, role, colon, text, end) give their offsets by
one running sum; each content byte's place is its own number plus a shift of its row plus the escapes before it. Headers
and contents are then copied by these scatter indices into one preallocated buffer, which becomes the Arrow column as it
is. Consecutive turns of a conversation make one part, up to PART bytes; parts in order are the conversation.

Reading back streams parts in order, so a task holds one batch of parts and, for each conversation, a few counters.

Defined results: null roles and texts are empty ones. Turns are in the order of turn (null first), then role and text in
bytes; rows that are equal in all three are turns of their own. Rows with a null conversation are one conversation,
whose id is null. An empty table makes no parts. Only the named columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.shared import cut
from .common import give_back, giving_back, prepare

#: the template's control strings
HEAD, COLON, STOP = b"### ", b": ", b"</turn>\n"
#: bytes of formatted text after which a part ends; a single turn is never cut
PART = 1 << 20
#: bytes whose scatter indices are made at once
SLICE = 4 << 20

PARTS = "conv_id long, part long, n_turns long, text string, loss array<struct<start:long,length:long>>"
BACKSLASH, HASH, LESS, COLON_BYTE = 0x5C, 0x23, 0x3C, 0x3A


def _bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if column.buffers()[2] else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


def _begins(data: np.ndarray, row_end: np.ndarray, word: bytes) -> np.ndarray:
    """Places where word begins; row_end: the end of the row that a place belongs to."""
    at = np.flatnonzero(data == word[0])
    at = at[at + len(word) <= len(data)]
    for i, b in enumerate(word[1:], 1):
        at = at[data[at + i] == b]
    return at[at + len(word) <= row_end[np.searchsorted(row_end, at, side="right")]]


def _escapes(data: np.ndarray, offsets: np.ndarray, colon: bool) -> np.ndarray:
    """Places before which a backslash goes, ascending. Ends of rows tell strings that span two rows apart."""
    ends = offsets[1:]
    found = [np.flatnonzero(data == BACKSLASH), _begins(data, ends, b"###"), _begins(data, ends, b"</turn>")]
    if colon:
        found.append(np.flatnonzero(data == COLON_BYTE))
    return np.sort(np.concatenate(found))


def _scatter(out: np.ndarray, data: np.ndarray, offsets: np.ndarray, escape: np.ndarray, start: np.ndarray) -> None:
    """Copies the rows of data to out, row r from start[r] on, with a backslash before each place of escape."""
    before = np.searchsorted(escape, offsets[:-1])  # escapes in earlier rows
    shift = start - offsets[:-1] - before
    for a in range(0, len(data), SLICE):
        b = min(a + SLICE, len(data))
        low, high = np.searchsorted(offsets, a, side="right") - 1, np.searchsorted(offsets, b, side="left")
        rows = np.diff(np.clip(offsets[low : high + 1], a, b))
        here = escape[np.searchsorted(escape, a) : np.searchsorted(escape, b)] - a
        more = np.zeros(b - a, np.int64)
        more[here] = 1
        to = np.arange(a, b) + np.repeat(shift[low:high], rows) + np.cumsum(more) + np.searchsorted(escape, a)
        out[to] = data[a:b]
        out[to[here] - 1] = BACKSLASH


def assemble(roles, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all turns one after the other, where each ends, then in characters: its length, where its text starts in
    it, and the text's length)."""
    (role, role_at), (text, text_at) = _bytes_of(roles), _bytes_of(texts)
    role_esc, text_esc = _escapes(role, role_at, True), _escapes(text, text_at, False)
    count = lambda escape, at: np.diff(np.searchsorted(escape, at))
    n_role, n_text = count(role_esc, role_at), count(text_esc, text_at)
    role_size, text_size = np.diff(role_at) + n_role, np.diff(text_at) + n_text
    role_from = len(HEAD)
    size = len(HEAD) + role_size + len(COLON) + text_size + len(STOP)
    end = np.cumsum(size)
    begin = end - size
    out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
    for word, at in ((HEAD, begin), (COLON, begin + role_from + role_size), (STOP, end - len(STOP))):
        out[at[:, None] + np.arange(len(word))] = np.frombuffer(word, np.uint8)
    _scatter(out, role, role_at, role_esc, begin + role_from)
    _scatter(out, text, text_at, text_esc, end - len(STOP) - text_size)
    chars = lambda column, n: pc.utf8_length(pc.fill_null(column, "")).to_numpy(zero_copy_only=False).astype(np.int64) + n
    role_chars, text_chars = chars(roles, n_role), chars(texts, n_text)
    text_from = len(HEAD) + role_chars + len(COLON)
    return out, end, text_from + text_chars + len(STOP), text_from, text_chars


def _parts(learn: str, part_bytes: int):
    """Batches of sorted turns -> batches of parts."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            out, end, chars, text_from, text_chars = assemble(batch.column("role"), batch.column("text"))
            # a part begins with each conversation, and where the one before it is full
            conv = batch.column("conv_id")
            key, null = conv.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(conv.is_null())
            new = np.ones(n, bool)
            new[1:] = (key[1:] != key[:-1]) | (null[1:] != null[:-1])
            begin = end - np.diff(end, prepend=0)
            first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
            within = (begin - begin[first]) // part_bytes
            new[1:] |= within[1:] != within[:-1]
            at = np.flatnonzero(new)
            stop = np.append(at[1:], n)
            which = np.cumsum(new) - 1
            learnt = pc.fill_null(pc.equal(batch.column("role"), learn), False).to_numpy(zero_copy_only=False)
            from_part = np.cumsum(chars) - chars
            start = (from_part - from_part[at][which] + text_from)[learnt]
            spans = pa.StructArray.from_arrays([pa.array(start), pa.array(text_chars[learnt])], names=["start", "length"])
            per = np.concatenate([[0], np.cumsum(np.bincount(which[learnt], minlength=len(at)))])
            texts = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(begin[at], end[-1]).astype(np.int64)), pa.py_buffer(out))
            yield pa.RecordBatch.from_arrays(
                [conv.take(pa.array(at)), pa.array(number + np.arange(len(at))), pa.array(stop - at), texts.cast(pa.string()), pa.ListArray.from_arrays(pa.array(per, pa.int32()), spans)],
                names=["conv_id", "part", "n_turns", "text", "loss"],
            )
            number += len(at)

    return run


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", learn: str = "assistant", part_bytes: int = PART) -> DataFrame:
    """(conv_id, part, n_turns, text, loss) of each part. loss: spans of the texts of `learn` in the part's text, in characters.

    Parts of a conversation in the order of `part`, put together, are its formatted text.
    """
    prepare(turns.sparkSession)
    rows = turns.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    by = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # ranges do not look at texts: rows that share conversation, turn and role stay together and are sorted in their task
    dealt = rows.repartitionByRange(*by[:3]).sortWithinPartitions(*by).select("conv_id", "role", "text")
    # parts are numbered by their task: with a checkpoint all readers see one numbering
    return cut(dealt.mapInArrow(giving_back(_parts(learn, part_bytes)), PARTS))


#: one formatted turn: the escaped role and the escaped text
_TURN = re.compile(rb"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]+|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)
_ESCAPED = re.compile(rb"\\(.)", re.DOTALL)
_ESCAPED_TEXT = re.compile(r"\\(.)", re.DOTALL)


def read_turns(text: bytes):
    """(role, text) of each turn of a formatted text; anything else in it is an error."""
    at = 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at byte {at}")
        role, said = m.groups()
        yield _ESCAPED.sub(rb"\1", role), _ESCAPED.sub(rb"\1", said) if b"\\" in said else said
        at = m.end()


def read_loss(text: str, spans) -> list[str]:
    """What stands under the spans, unescaped."""
    found = [text[s["start"] : s["start"] + s["length"]] for s in spans]
    return [_ESCAPED_TEXT.sub(r"\1", x) if "\\" in x else x for x in found]


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def _digests(batches):
    """Parts in order -> a row for each conversation, made when the next one begins."""
    now, state, rows = None, None, []

    def close():
        if state:
            n, turns, chars, loss, formatted = state
            rows.append((now[0], n, turns.hexdigest(), chars, loss.hexdigest(), formatted))

    def flush():
        columns = zip(*rows, strict=True) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()], strict=True)], names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    for batch in batches:
        for conv, text, spans in zip(batch.column("conv_id").to_pylist(), batch.column("text"), batch.column("loss").to_pylist(), strict=True):
            if now != (conv,):
                close()
                now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            text = text.as_py()
            for role, said in read_turns(text.encode()):
                state[0] += 1
                state[1].update(role + b"\n" + said + b"\n")
            for said in read_loss(text, spans):
                state[2] += len(said)
                state[3].update(said.encode())
            state[4] += len(text)
        if rows:
            yield flush()
            rows.clear()
    close()
    yield flush()
    give_back()


def digest_chats(parts: DataFrame) -> DataFrame:
    """What formatted conversations hold, read back from the parts: numbers and digests of turns and of what is learnt."""
    dealt = parts.select("conv_id", "part", "text", "loss").repartition("conv_id").sortWithinPartitions(F.col("conv_id"), "part")
    return dealt.select("conv_id", "text", "loss").mapInArrow(_digests, DIGESTS)
