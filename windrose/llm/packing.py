"""Best-fit packing of documents into token sequences, planned on the histogram of lengths.

1. Tasks turn texts into token ids and cut longer documents into pieces of ``limit`` tokens; the first piece takes what
   is left over. Each piece is numbered among the pieces of its length in its task. The pieces (without their ids) are
   written to the shared checkpoint folder.
2. The histogram of lengths has at most ``limit`` rows. Best fit runs on the driver over counts: lengths in falling
   order go, many at once, to the open sequences with the least room that is enough. Sequences with one history are one
   group, so the plan has a few thousand slots at any number of documents: (length, ranks from, to) go to the sequences
   from a number on, at one offset.
3. Pieces get their rank within length: their number in their task, plus the count of their length in the tasks before.
   They take their planned slots by a join on length and rank. Ranks are cut into ranges by the plan, and the slots are
   joined on length and range.

Defined results: a null text is an empty one, and has only the end token. Repeated rows and null ids are documents of
their own. An empty table makes no pieces. Only the id column is carried.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, giving_back, prepare
from .textnum import FIRST, chunks, encode, loads, ragged, span_hashes

#: distinct strings whose ids a worker remembers, about 45 bytes each
MEMORY = 1_000_000
#: longer strings are not remembered; a remembered one keeps its first KEPT eights of bytes
SHORT, KEPT = 24, 2
#: bytes of text that are encoded together
TOGETHER = 1 << 20
#: strings that the tokenizer takes at once: what it returns for each is large
AT_ONCE = 2000
#: slots of a plan that are sent to all executors, at most
BROADCAST_SLOTS = 100_000
END = 2


#: bytes of strings that the tokenizer takes as one text
JOINED = 1 << 9
#: ASCII white space, and first bytes of characters that can be other white space
_NO_CUT = np.zeros(256, bool)
_NO_CUT[[0x20, *range(0x09, 0x0E), 0xC2, 0xE1, 0xE2, 0xE3]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
#: second bytes of characters from U+00C0 to U+00FF that are letters
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
#: ASCII that is no letter and no blank; what is white space for nobody
_OTHER, _BLACK = np.zeros(256, bool), np.zeros(256, bool)
_OTHER[:0x80] = ~_LETTER[:0x80]
_OTHER[0x20] = False
_BLACK[0x21:0x7F] = True
#: the characters by which a byte-level vocabulary writes bytes stand for one byte each; this tells such files
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}


class Encoder:
    """Ids of a tokenizer file of the byte-level kind, as the tokenizers library gives them with add_special_tokens=False.

    Its pre-tokenizer puts a space before a word with the word, and ends what stands before; it ends a word where its
    letters end; and a line feed after a visible character stands alone before a word. So texts are cut before spaces that no
    white space follows, before what follows a letter and is none, and between such a line feed and a letter. Each distinct
    string of up to SHORT bytes is encoded once and remembered, with its bytes. New strings are encoded many at once, as one
    text that is cut between them by the same rules; the bytes of each id tell which are whose.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        rules = json.loads(self.tokenizer.to_str())
        known = rules["normalizer"] is None and rules["pre_tokenizer"] is not None and _BYTES.items() <= rules["pre_tokenizer"].items()
        vocabulary = self.tokenizer.get_vocab()
        #: bytes of each id; None: strings are not joined, and texts are cut before spaces alone
        self.bytes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64) if known else None
        for token, i in vocabulary.items() if known else ():
            self.bytes[i] = len(token)
        self.forget()

    def forget(self) -> None:
        self.hash = np.empty(0, np.uint64)
        self.key, self.length = np.empty((0, KEPT), np.uint64), np.empty(0, np.uint8)
        self.start, self.size = np.empty(0, np.int32), np.empty(0, np.int32)
        self.ids, self.used = np.empty(0, np.uint32), 0  # the first `used` are in use

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has."""
        raw = b"".join(texts)
        data = np.frombuffer(raw, np.uint8)
        sizes = np.fromiter((len(t) for t in texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        cut = np.zeros(len(data) + 1, bool)
        cut[:-1] = data == 0x20
        cut[: max(0, len(data) - 1)] &= ~_NO_CUT[data[1:]]
        cut[max(0, len(data) - 1) :] = False
        if self.bytes is not None:
            letter = _LETTER[data]
            ends_word = letter.copy()
            ends_word[1:] |= (data[:-1] == 0xC3) & _LATIN[data[1:]]
            cut[1 : len(data)] |= ends_word[:-1] & _OTHER[data[1:]]
            cut[2 : len(data)] |= _BLACK[data[:-2]] & (data[1:-1] == 0x0A) & letter[2:]
        for i, t in enumerate(texts):
            if any(x in t for x in self.special):  # such a text is encoded whole
                cut[ends[i] - sizes[i] : ends[i]] = False
        last = ends[sizes > 0] - 1
        cut[last] = False  # a space at a text's end
        cut[(ends - sizes)[sizes > 0]] = True
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(data))[: len(start)]
        begin, size = np.empty(len(start), np.int64), np.empty(len(start), np.int64)
        short = end - start <= SHORT
        begin[short], size[short] = self._remembered(raw, start[short], end[short])
        long = np.flatnonzero(~short)  # few: each is encoded where it stands
        begin[long], size[long] = self._add([raw[a:b] for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)])
        text = np.searchsorted(ends, start, side="right")
        out = self.ids[ragged(begin, size)], np.bincount(text, size, len(texts)).astype(np.int64)
        if len(long):  # what was not remembered goes
            self.used = int(begin[long].min())
        return out

    def _remembered(self, raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of short strings stand, and how many: strings are found by their hash, and their bytes are compared."""
        h, size = span_hashes(raw, start, end), end - start
        eight = loads(raw)
        block = lambda some, k: eight[start[some] + 8 * k] & FIRST[np.minimum(size[some] - 8 * k, 8)]
        distinct, first, where = np.unique(h, return_index=True, return_inverse=True)
        self._learn(distinct, raw, start[first], end[first], block, first)
        at = np.searchsorted(self.hash, distinct)[where]
        # each eight bytes are mixed in by a bijection: strings of one length and hash whose other eights are equal agree in the last one
        odd = self.length[at] != size
        some = np.flatnonzero(size > 8)
        for k in range(KEPT):
            some = some[size[some] > 8 * (k + 1)]
            odd[some] |= self.key[at[some], k] != block(some, k)
        begin, count = self.start[at].astype(np.int64), self.size[at].astype(np.int64)
        if odd.any():  # another string has that hash
            begin[odd], count[odd] = self._add([raw[a:b] for a, b in zip(start[odd].tolist(), end[odd].tolist(), strict=True)])
        return begin, count

    def _add(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Encodes strings and puts their ids at the end of all."""
        parts, sizes = [], []
        for i in range(0, len(strings), AT_ONCE):
            ids, size = self._joined(strings[i : i + AT_ONCE])
            parts.append(ids)
            sizes.append(size)
        size = np.concatenate([np.empty(0, np.int64), *sizes])
        begin = self.used + np.cumsum(size) - size
        for ids in parts:
            if self.used + len(ids) > len(self.ids):
                more = np.empty(max(self.used + len(ids), len(self.ids) * 3 // 2), np.uint32)
                more[: self.used] = self.ids[: self.used]
                self.ids = more
            self.ids[self.used : self.used + len(ids)] = ids
            self.used += len(ids)
        return begin, size

    def _joined(self, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of strings, one after the other, and how many each has."""
        blob = b"\n".join(strings)
        special = [s for s in self.special if s in blob]
        guards = [self._guard(x) if not any(s in x for s in special) else None for x in strings] if special else [self._guard(x) for x in strings]
        groups, group, room = [], [], JOINED
        start, at = [], 0  # of joined strings, in all groups
        for x, guard in zip(strings, guards, strict=True):
            if guard is not None:
                start.append(at + len(guard))
                at += len(guard) + len(x)
                group += [guard, x]
                room -= len(x)
                if room <= 0:
                    groups.append(b"".join(group))
                    group, room = [], JOINED
        if group:
            groups.append(b"".join(group))
        ids = self._library(groups)
        found = np.concatenate([np.empty(0, np.uint32), *ids])
        if len(start):
            ends = np.concatenate([[0], np.cumsum(self.bytes[found])])
            first = np.array(start)
            last = first + np.fromiter((len(x) for x, guard in zip(strings, guards, strict=True) if guard is not None), np.int64, len(first))
            a, b = np.searchsorted(ends, first), np.searchsorted(ends, last)
            if ends[-1] != at or (ends[a] != first).any() or (ends[b] != last).any():
                a = None  # the file has rules of its own
        if not len(start) or a is None:
            ids = self._library(strings)
            return np.concatenate([np.empty(0, np.uint32), *ids]), np.array([len(x) for x in ids], np.int64)
        alone = [k for k, guard in enumerate(guards) if guard is None]
        own = self._library([strings[k] for k in alone])
        begin, size = np.empty(len(strings), np.int64), np.empty(len(strings), np.int64)
        joined = np.array([guard is not None for guard in guards])
        begin[joined], size[joined] = a, b - a
        size[alone] = [len(x) for x in own]
        begin[alone] = len(found) + np.cumsum(size[alone]) - size[alone]
        return np.concatenate([found, *own])[ragged(begin, size)], size

    def _guard(self, x: bytes) -> bytes | None:
        """What stands before a string in a joined text, so that the text is cut there; None: it is encoded by itself."""
        if self.bytes is None or len(x) < 2:
            return None
        if x[0] == 0x20:
            return None if _NO_CUT[x[1]] else b""
        return b" a\n" if _LETTER[x[0]] else b" a" if _OTHER[x[0]] else None

    def _library(self, strings: list[bytes]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast([x.decode("utf-8", "surrogatepass") for x in strings], add_special_tokens=False) if strings else []
        return [np.array(e.ids, np.uint32) for e in found]

    def _learn(self, distinct, raw: bytes, start, end, block, first) -> None:
        at = np.searchsorted(self.hash, distinct)
        known = np.zeros(len(distinct), bool)
        known[at < len(self.hash)] = self.hash[at[at < len(self.hash)]] == distinct[at < len(self.hash)]
        if len(self.hash) + (~known).sum() > MEMORY:
            self.forget()
            known[:], at[:] = False, 0
        new = np.flatnonzero(~known)
        if not len(new):
            return
        length = (end - start)[new]
        key = np.zeros((len(new), KEPT), np.uint64)
        for k in range(KEPT):
            some = np.flatnonzero(length > 8 * k)
            key[some, k] = block(first[new[some]], k)
        begin, size = self._add([raw[a:b] for a, b in zip(start[new].tolist(), end[new].tolist(), strict=True)])
        # new hashes go between the old ones
        place = at[new] + np.arange(len(new))
        old = np.ones(len(self.hash) + len(new), bool)
        old[place] = False
        for name, more in (("hash", distinct[new]), ("key", key), ("length", length.astype(np.uint8)), ("start", begin.astype(np.int32)), ("size", size.astype(np.int32))):
            both = np.empty((len(old), *more.shape[1:]), more.dtype)
            both[old], both[place] = getattr(self, name), more
            setattr(self, name, both)


_encoders: dict[str, Encoder] = {}  # one in each worker


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _cutter(path: str, limit: int):
    def cut(batches):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        e = encoder(path)
        for batch in batches:
            rows = []
            docs, texts = batch.column("id").to_pylist(), encode(batch.column("t").to_pylist())
            for a, b in chunks([len(t) for t in texts], TOGETHER):
                all_ids, sizes = e.encode(texts[a:b])
                for doc, n, stop_at in zip(docs[a:b], sizes.tolist(), np.cumsum(sizes).tolist(), strict=True):
                    ids = np.append(all_ids[stop_at - n : stop_at], np.uint32(END)).astype("<u4")
                    n += 1
                    start, piece = 0, 0
                    stop = n % limit or min(n, limit)
                    while start < n:
                        size = stop - start
                        rows.append((doc, piece, start, size, zlib.crc32(ids[start:stop].tobytes()), seen[size]))
                        seen[size] += 1
                        start, stop, piece = stop, stop + limit, piece + 1
            if rows:
                doc, piece, start, size, crc, rank = zip(*rows, strict=True)
                give_back()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(rows), pa.int32()), pa.array(rank, pa.int64())],
                    names=["id", "piece", "start", "length", "ids_crc32", "task", "nth"],
                )

    return cut


def plan(histogram: dict[int, int], limit: int) -> list[tuple[int, int, int, int, int]]:
    """Best fit over counts: (length, rank from, rank to, first sequence, offset); rank r goes to first + r - from."""
    slots = []
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # free tokens -> ranges of sequences, [from, to)
    sizes: list[int] = []  # rooms in use, ascending
    sequences = 0
    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while count:
            at = bisect_left(sizes, length)
            if at == len(sizes):
                # none has room: new sequences, each with as many of this length as it takes
                fits = limit // length
                n = -(-count // fits)
                for i in range(fits):
                    take = min(n, count)
                    if not take:
                        break
                    slots.append((length, rank, rank + take, sequences, i * length))
                    rank, count = rank + take, count - take
                    used = (i + 1) * length
                    # those that the next round does not reach stay with this room
                    rest = min(n, count) if i + 1 < fits else 0
                    if take > rest:
                        _put(room, sizes, limit - used, (sequences + rest, sequences + take))
                sequences += n
                continue
            free = sizes[at]
            a, b = room[free].pop()
            if not room[free]:
                sizes.pop(at)
            take = min(b - a, count)
            slots.append((length, rank, rank + take, a, limit - free))
            rank, count = rank + take, count - take
            _put(room, sizes, free - length, (a, a + take))
            if take < b - a:
                _put(room, sizes, free, (a + take, b))
    return slots


def _put(room, sizes: list[int], free: int, of: tuple[int, int]) -> None:
    if free:
        if not room[free]:
            insort(sizes, free)
        room[free].append(of)


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """Pieces of docs: id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    pieces = texts.mapInArrow(giving_back(_cutter(tokenizer, limit)), "id long, piece int, start long, length long, ids_crc32 long, task int, nth long").checkpoint()
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n")).checkpoint()
    slots = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, limit)
    # ranks of a length are cut at all ends of its slots: a slot's range is found by its number
    cuts: dict[int, list[int]] = defaultdict(list)
    rows = []
    for length, a, b, first, offset in sorted(slots):
        rows.append((length, len(cuts[length]), a, first, offset))
        cuts[length].append(b)
    slot_table = spark.createDataFrame(rows, "length long, slot int, rank_from long, first_sequence long, offset long")
    ends = spark.createDataFrame([(k, v) for k, v in cuts.items()], "length long, ends array<long>")
    before = counts.selectExpr("length", "task", "sum(n) over (partition by length order by task rows between unbounded preceding and 1 preceding) as earlier")
    ranked = pieces.join(before, ["length", "task"]).withColumn("rank", F.col("nth") + F.coalesce("earlier", F.lit(0)))
    # the plan's tables grow with the limit, not with the documents; a plan that is large all the same is not broadcast
    small = F.broadcast if len(rows) <= BROADCAST_SLOTS else lambda df: df
    found = ranked.join(small(ends), "length").withColumn("slot", F.size(F.filter("ends", lambda e: e <= F.col("rank"))))
    placed = found.drop("ends").join(small(slot_table), ["length", "slot"])
    return placed.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        (F.col("first_sequence") + F.col("rank") - F.col("rank_from")).alias("sequence_id"), "offset",
    )
