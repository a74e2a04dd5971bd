"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Every run of ``window`` words of a benchmark item is a pattern; an item with fewer words, but not none, is one shorter
pattern. Words are symbols. For patterns of one length m, the search looks at the block of two words that ends at a
position: a shift table, indexed by the block's hash, says how many positions can be skipped since no pattern can end
there. Where the shift is 0 the block's suffix-hash bucket selects the patterns that end in that block, and a direct
comparison of all words, and then of the bytes, confirms an occurrence. Many stretches of text are searched side by
side, so that each step is a numpy operation.

The patterns are made on the driver from about ``part_bytes`` of benchmark text at a time, as flat arrays: the items' words
as numbers, and windows as places among them, in all some 15 bytes for each byte of text. A larger benchmark is cut into
parts by a hash of the item. TOGETHER parts are searched in one pass over the documents; further ones in further passes,
with a checkpoint between, so that no worker holds more tables than that.

Defined results: a null or empty text has no words and no hits. Items that are null or have no words have no window.
An item id that stands in several rows has the windows of all of them; a null item id is hit as an item without an id:
its words count as hit, but it is not listed. Rows with repeated or null ids are searched each on its own. A text's
length is not limited. Item ids keep their type. Columns of the documents whose names clash with the results are replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import giving_back, prepare, text_bytes
from .textnum import alnum_words, chunks, encode, merge_spans, mix, ragged, window_hashes

PART_BYTES, TOGETHER = 4 << 20, 4
#: words that one lane searches
LANE = 256
#: Results, added to the documents' columns, beside items. spans: words hit, as [from, to) pairs.
RESULT = ["n_words", "n_hit", "items", "spans"]


def _fields(item_type: T.DataType) -> list[T.StructField]:
    span = T.StructType([T.StructField("from", T.LongType()), T.StructField("to", T.LongType())])
    types = [T.LongType(), T.LongType(), T.ArrayType(item_type), T.ArrayType(span)]
    return [T.StructField(n, t) for n, t in zip(RESULT, types, strict=True)]


class Length:
    """Tables for all patterns of m words: places `at` in `words`."""

    def __init__(self, m: int, words: np.ndarray, at: np.ndarray):
        self.m, self.block = m, min(2, m)
        bits = max(8, int(np.ceil(np.log2(max(1, at.size)))) + 3)
        self.mask = np.uint64((1 << bits) - 1)
        self.shift = np.full(1 << bits, min(m - self.block + 1, 255), np.uint8)
        for end in range(m - 1, self.block - 2, -1):
            some = self.slot(words, at + end)
            self.shift[some] = np.minimum(self.shift[some], min(m - 1 - end, 255))
        # buckets by the hash of the last block: patterns in its order
        last = self.slot(words, at + m - 1).astype(np.uint32 if bits <= 32 else np.int64)
        self.order = np.argsort(last, kind="stable").astype(np.int32)
        self.last = last[self.order]

    def slot(self, words: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Slot of the block of words that ends at each place."""
        h = words[end].astype(np.uint64)
        if self.block == 2:
            h += words[end - 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mix(h) & self.mask).astype(np.int64)

    def search(self, words: np.ndarray, patterns: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first word, pattern) of each place where all word numbers agree; patterns stand at `at`."""
        n = len(words)
        if n < self.m:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        # lanes of end positions; each keeps its own place and skips by its own shifts
        place = np.arange(self.m - 1, n, LANE)
        stop = np.minimum(place + LANE, n)
        ends = []
        while len(place):
            shift = self.shift[self.slot(words, place)]
            ends.append(place[shift == 0])
            place = place + np.maximum(shift, 1)
            more = place < stop
            place, stop = place[more], stop[more]
        end = np.concatenate(ends)
        slot = self.slot(words, end).astype(self.last.dtype)
        lo, hi = np.searchsorted(self.last, slot, "left"), np.searchsorted(self.last, slot, "right")
        pattern = self.order[ragged(lo, hi - lo)].astype(np.int64)
        end = np.repeat(end, hi - lo)
        for i in range(self.m):  # the last words, then the one before, ...
            same = words[end - i] == patterns[at[pattern] + self.m - 1 - i]
            end, pattern = end[same], pattern[same]
        return end - self.m + 1, pattern


class Patterns:
    """Windows of a part of the benchmark, as tables by length. Equal windows are one pattern with several items."""

    def __init__(self, rows: list[tuple[object, str]], window: int):
        self.ids = [i for i, _ in rows]
        w = alnum_words(encode([t for _, t in rows]))
        self.text, self.start, self.size = w.joined, w.start.astype(np.uint32 if len(w.joined) < 1 << 32 else np.int64), (w.end - w.start).astype(np.uint32)
        one, two = w.hashes(0), w.hashes(1)
        self.known, number = np.unique(one, return_inverse=True)
        self.words = (number + 1).astype(np.uint32)  # 0: a word of no pattern
        m = np.minimum(w.count, window)
        self.lengths: list[tuple[Length, np.ndarray, np.ndarray, np.ndarray]] = []
        for size in np.unique(m[m > 0]).tolist():
            some = np.flatnonzero(m == size)
            n = w.count[some] - size + 1
            at, item = ragged(w.first[some], n).astype(np.int32), np.repeat(some.astype(np.int32), n)
            # the first of equal windows stands for all; their items follow one another
            order = np.lexsort((item, window_hashes(two, size, 1)[at], window_hashes(one, size, 0)[at]))
            at, item = at[order], item[order]
            a, b = window_hashes(one, size, 0)[at], window_hashes(two, size, 1)[at]
            new = np.ones(len(at), bool)
            new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
            first = np.flatnonzero(new)
            self.lengths.append((Length(size, self.words, at[first]), at[first], np.append(first, len(at)).astype(np.int32), item))

    @property
    def nbytes(self) -> int:
        arrays = [self.start, self.size, self.known, self.words]
        for table, *others in self.lengths:
            arrays += [table.shift, table.order, table.last, *others]
        return len(self.text) + sum(a.nbytes for a in arrays)

    def _same(self, w, f: int, at: int, m: int) -> bool:
        """Are m words of a text and of the benchmark equal, byte by byte?"""
        begin, size = self.start[at : at + m].tolist(), self.size[at : at + m].tolist()
        return all(w.joined[a:b] == self.text[c : c + n] for a, b, c, n in zip(w.start[f : f + m].tolist(), w.end[f : f + m].tolist(), begin, size, strict=True))

    def find(self, texts: list[bytes]):
        """Words of each text; and (text, first word, words, items) of each occurrence."""
        w = alnum_words(texts)
        found = []
        if len(self.known) and len(w.start):
            h = w.hashes()
            at = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
            number = np.where(self.known[at] == h, at + 1, 0).astype(np.uint32)
            # a word of no pattern between texts: no window spans two
            place = np.arange(len(number)) + w.text
            spread = np.zeros(len(number) + len(texts), np.uint32)
            spread[place] = number
            back = np.zeros(len(spread), np.int64)
            back[place] = np.arange(len(number))
            for table, at, items, item in self.lengths:
                first, pattern = table.search(spread, self.words, at)
                for f, p in zip(back[first].tolist(), pattern.tolist(), strict=True):
                    if self._same(w, f, int(at[p]), table.m):
                        found.append((int(w.text[f]), f - int(w.first[w.text[f]]), table.m, item[items[p] : items[p + 1]].tolist()))
        return w.count, found


def _searcher(patterns, text_col: str, names: list[str], schema: pa.Schema):
    """For mapInArrow: search one part's patterns, and add to what earlier parts found."""

    def search(batches):
        p: Patterns = patterns.value
        for batch in batches:
            texts = encode(batch.column(text_col).cast(pa.large_string()).to_pylist())
            before_spans = batch.column("spans").to_pylist()
            before_items = batch.column("items").to_pylist()
            n_words = np.zeros(len(texts), np.int64)
            spans, items = [[] for _ in texts], [set(x or ()) for x in before_items]
            for a, b in chunks([len(t) for t in texts]):
                count, found = p.find(texts[a:b])
                n_words[a:b] = count
                for text, first, m, of in found:
                    spans[a + text].append((first, first + m))
                    items[a + text].update(p.ids[i] for i in of if p.ids[i] is not None)
            out_spans, n_hit = [], []
            for old, new in zip(before_spans, spans, strict=True):
                both = np.array(sorted([*((x["from"], x["to"]) for x in old or ()), *new]), np.int64).reshape(-1, 2)
                s, e = merge_spans(both[:, 0], both[:, 1])
                out_spans.append([{"from": x, "to": y} for x, y in zip(s.tolist(), e.tolist(), strict=True)])
                n_hit.append(int((e - s).sum()))
            result = {"n_words": n_words.tolist(), "n_hit": n_hit, "items": [sorted(x) for x in items], "spans": out_spans}
            yield pa.RecordBatch.from_arrays(
                [pa.array(result[n], schema.field(n).type) if n in result else batch.column(n) for n in names], names=names
            )

    return search


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """docs with n_words, n_hit (words inside any occurrence of a window), items and spans of words hit."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop(*(c for c in docs.columns if c in RESULT and c != text_col))
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("words")).where("words is not null")
    n_parts = 1 + text_bytes(items, "words") // part_bytes
    fields = _fields(items.schema["item"].dataType)
    schema = T.StructType([*docs.schema.fields, *fields])
    arrow = to_arrow_schema(schema)
    out = docs
    for field in fields:
        out = out.withColumn(field.name, F.lit(None).cast(field.dataType))
    sent = []
    for part in range(n_parts):
        if len(sent) == TOGETHER:
            out = out.checkpoint()
            for old in sent:
                old.unpersist()
            sent = []
        rows = items if n_parts == 1 else items.where(F.pmod(F.xxhash64("words"), F.lit(n_parts)) == part)
        sent.append(spark.sparkContext.broadcast(Patterns([(r["item"], r["words"]) for r in rows.collect()], window)))
        out = out.mapInArrow(giving_back(_searcher(sent[-1], text_col, schema.fieldNames(), arrow)), schema)
    return out


def with_digest(found: DataFrame) -> DataFrame:
    """Adds n_items, items_sha256 and contaminated."""
    listed = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.withColumns(
        {"n_items": F.size("items").cast("long"), "items_sha256": F.sha2(listed.cast("binary"), 256), "contaminated": F.col("n_hit") > 0}
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents in which no window of the benchmark occurs, with the columns of docs."""
    return find_contamination(docs, benchmark, **options).where("n_hit = 0").select(*docs.columns)
