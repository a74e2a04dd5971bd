"""Periodic runs of words, found as maximal pairs on each document's LCP-interval tree.

A run is a stretch of words that repeats itself with smallest period q, at least four times, and that no neighbouring word
continues. Let it start at s and be l + q long. Then the suffixes at s and s + q share exactly l words, and the words to
their left differ: they are a maximal pair at distance q. The other way round, a maximal pair at distance q with
l >= max(6 - q, 3 * q) common words is a stretch with period q that nothing continues, so it is a run without any further
extension. A multiple of the smallest period gives the same stretch, and of those the least is kept.

Documents are worked on one by one, many in one call of numpy, and never shuffled:

1. Words become numbers. A pair needs five common words, so only places whose five words stand in their document a second
   time are sorted. Prefix doubling ranks these by 5, 10, 20, ... words until no two agree; the levels are kept.
2. The common prefix of neighbours in that order comes from the levels, by descending powers.
3. The intervals of common prefixes are visited bottom-up. A node has its places in ascending order, with the word to the
   left of each as its class. When a child joins, its places look for their nearest neighbours among those of the other
   children: a pair of different classes, near enough, is emitted. Neighbours are enough. Between the two places of a
   run's pair no third place of the node can lie: it would make the run's period smaller. The smaller child looks into
   the larger one.

Before the visit, an interval of five words goes at once if its places are all too far apart for its longest prefix.

Defined results: a null text has no words, no runs and an empty kept text. Repeated rows and null ids are documents of
their own; ids are of any type. An empty table is fine. The documents' own columns are kept, but for those whose names clash
with the results.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import give_back, giving_back, prepare
from .textnum import U, Words, chunks, encode, mix, ragged, space_words, window_hashes

#: words that any pair has in common
SEED = 5
#: bytes of text that are sorted together; a longer text stands alone
TOGETHER = 4 << 20

RESULT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))),
    T.StructField("kept_text", T.StringType()),
]


def numbers(w: Words) -> np.ndarray:
    """A number for each different word; words are told apart by 128 bits."""
    one, two = w.hashes(0), w.hashes(1)
    _, first, number = np.unique(one, return_index=True, return_inverse=True)
    if (two[first][number] != two).any():  # two words have one hash
        number = np.unique(np.stack([one, two], 1), axis=0, return_inverse=True)[1].reshape(-1)
    return number.astype(np.int64)


def _seeds(word: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Places whose five words begin at a second place of their text, and perhaps a few more: they are found by a hash."""
    n = len(word) - SEED + 1
    if n <= 0:
        return np.empty(0, np.int64)
    salt = mix(word.astype(U) * U(0x9E3779B97F4A7C15) + U(1))
    h = window_hashes(salt, SEED) ^ mix(text[:n].astype(U) + U(0x51ED270B))
    at = np.flatnonzero(text[:n] == text[SEED - 1 :])
    h = h[at]
    order = np.argsort(h)
    same = np.diff(h[order]) == 0
    again = np.zeros(len(at), bool)
    again[1:] |= same
    again[:-1] |= same
    return np.sort(at[order][again])


def _alike(new: np.ndarray) -> np.ndarray:
    """Which items share their group with others; new: where a group begins."""
    out = np.zeros(len(new), bool)
    out[1:] |= ~new[1:]
    out[:-1] |= ~new[1:]
    return out


def sorted_suffixes(word: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in suffix order, words that each has in common with the one before it); places of one seed stand together.

    Words are in the order of their numbers: any order of words gives the same intervals.
    """
    at, n = _seeds(word, text), len(word)
    # what follows a seed's place after 5, 10, 20, ... words is ranked as well, so that neighbours share the most
    need = np.zeros(n, bool)
    need[at], size = True, SEED
    while size < n and len(at):
        need[at[at + size < n] + size] = True
        size *= 2
    place = np.flatnonzero(need)

    def ahead_by(k: int) -> np.ndarray:
        to = np.minimum(place + k, n - 1)
        return np.where((place + k < n) & (text[to] == text[place]), word[to] + 1, 0)  # 0 after a text's end

    keys = [(text[place] << 32) | ahead_by(0), (ahead_by(1) << 32) | ahead_by(2), (ahead_by(3) << 32) | ahead_by(4)]
    order = np.lexsort(keys[::-1])
    new = np.ones(len(place), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= np.diff(k[order]) != 0
    # a group's rank is its first place in the order: its parts can be numbered from there. Other places agree with none.
    rank = -2 - np.arange(n + 1)
    rank[n] = len(place)
    rank[place[order]] = np.maximum.accumulate(np.where(new, np.arange(len(place)), 0))
    levels, size = [(SEED, rank)], SEED
    at = todo = place[order][_alike(new)]
    if not len(at):
        return at, at
    while len(todo):
        follow = rank[np.minimum(todo + size, n)]
        order = np.argsort(rank[todo] * (2 * n + 4) + follow + (n + 2))  # by rank, then by what follows
        todo, follow = todo[order], follow[order]
        base = rank[todo]
        head = np.ones(len(todo), bool)
        head[1:] = np.diff(base) != 0
        new = head.copy()
        new[1:] |= np.diff(follow) != 0
        index = np.arange(len(todo))
        rank = rank.copy()
        rank[todo] = base + np.maximum.accumulate(np.where(new, index, 0)) - np.maximum.accumulate(np.where(head, index, 0))
        size *= 2
        levels.append((size, rank))
        todo = todo[_alike(new)]
    at = at[np.argsort(rank[at])]
    # common prefixes: the largest level at which two places agree is taken off again and again
    common = np.zeros(len(at), np.int64)
    i, j = at[:-1].copy(), at[1:].copy()
    shared = np.zeros(len(i), np.int64)
    for size, rank in reversed(levels):
        same = rank[i] == rank[j]
        shared += size * same
        i, j = np.minimum(i + size * same, n), np.minimum(j + size * same, n)
    going = np.flatnonzero(shared >= SEED)
    for _ in range(SEED - 1):  # fewer than five words are left
        a, b = i[going], j[going]
        inside = np.maximum(a, b) < n
        going, a, b = going[inside], a[inside], b[inside]
        same = (word[a] == word[b]) & (text[a] == text[b])
        going = going[same]
        shared[going] += 1
        i[going] += 1
        j[going] += 1
    common[1:] = shared
    return at, common


def maximal_pairs(places: list[int], common: list[int], left: list[int]) -> list[tuple[int, int, int]]:
    """(first place, distance, common words) of the maximal pairs of one interval of seeds that can be runs.

    places, in suffix order; common: words in common with the one before; left: the class of each place, by place order
    in a dict or list.
    """
    out = []

    def join(a: list[int], b: list[int], size: int) -> list[int]:
        """The node's places: two children's, or those of all children so far and of one more."""
        large, small = (a, b) if len(a) >= len(b) else (b, a)
        most, least = size // 3, 6 - size
        for x in small:
            k = bisect_left(large, x)
            if k:
                y = large[k - 1]
                if least <= x - y <= most and left[x] != left[y]:
                    out.append((y, x - y, size))
            if k < len(large):
                y = large[k]
                if least <= y - x <= most and left[x] != left[y]:
                    out.append((x, y - x, size))
        if len(small) < 32:
            for x in small:
                insort(large, x)
        else:
            large += small
            large.sort()
        return large

    stack: list[tuple[int, list[int]]] = []
    now = [places[0]]
    for t in range(1, len(places) + 1):
        size = common[t] if t < len(places) else 0
        while stack and stack[-1][0] > size:
            top, children = stack.pop()
            now = join(children, now, top)
        if t == len(places):
            break
        if stack and stack[-1][0] == size:
            now = join(stack.pop()[1], now, size)
        stack.append((size, now))
        now = [places[t]]
    return out


def find_runs(word: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period. text: the number of each word's text, ascending."""
    at, common = sorted_suffixes(word, text)
    if not len(at):
        return np.empty((0, 3), np.int64)
    begin = np.flatnonzero(common < SEED)
    stop = np.append(begin[1:], len(at))
    # an interval whose nearest places are further apart than a third of its longest prefix has no run
    longest = np.maximum.reduceat(common, begin)
    which = np.repeat(np.arange(len(begin)), stop - begin)
    order = np.lexsort((at, which))
    gap = np.full(len(at), np.iinfo(np.int64).max)
    gap[1:] = np.where(which[1:] == which[:-1], np.diff(at[order]), gap[1:])
    nearest = np.minimum.reduceat(gap, begin)
    # the word to the left, and the text's start as a class of its own
    left = np.full(len(word), -1, np.int64)
    left[1:] = np.where(text[1:] == text[:-1], word[:-1], -1)
    found = []
    for k in np.flatnonzero(3 * nearest.clip(max=1 << 60) <= longest).tolist():
        a, b = begin[k], stop[k]
        places = at[a:b].tolist()
        found += maximal_pairs(places, common[a:b].tolist(), dict(zip(places, left[at[a:b]].tolist(), strict=True)))
    if not found:
        return np.empty((0, 3), np.int64)
    pairs = np.array(found, np.int64)
    runs = np.stack([pairs[:, 0], pairs[:, 1] + pairs[:, 2], pairs[:, 1]], 1)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    least = np.ones(len(runs), bool)  # of one stretch the smallest period stays
    least[1:] = (runs[1:, :2] != runs[:-1, :2]).any(1)
    runs = runs[least]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _collapse(text_col: str, names: list[str], schema: pa.Schema):
    def run(batches):
        for batch in batches:
            texts = encode(batch.column(text_col).to_pylist())
            n_words, kept = np.zeros(len(texts), np.int64), []
            spans, per = [], np.zeros(len(texts), np.int64)
            for a, b in chunks([len(t) for t in texts], TOGETHER):
                w = space_words(texts[a:b])
                n_words[a:b] = w.count
                runs = find_runs(numbers(w), w.text)
                text = w.text[runs[:, 0]] if len(runs) else np.empty(0, np.int64)
                per[a:b] = np.bincount(text, minlength=b - a)
                # words that a run has after its first period
                cover = np.zeros(len(w.start) + 1, np.int64)
                np.add.at(cover, runs[:, 0] + runs[:, 2], 1)
                np.add.at(cover, runs[:, 0] + runs[:, 1], -1)
                stay = np.cumsum(cover)[:-1] <= 0
                kept += _joined(w, np.flatnonzero(stay), b - a)
                runs[:, 0] -= w.first[text]
                spans.append(runs)
            runs = np.concatenate(spans) if spans else np.empty((0, 3), np.int64)
            items = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in range(3)], names=["start", "length", "period"])
            result = {
                "n_words": pa.array(n_words), "kept_text": pa.array(kept, pa.binary()),
                "runs": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(per)]), pa.int32()), items),
            }
            give_back()
            result["kept_text"] = result["kept_text"].cast(pa.string())
            columns = [result[n] if n in result else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return run


def _joined(w: Words, words: np.ndarray, n: int) -> list[bytes]:
    """The named words of each text, joined by one space."""
    size = w.end[words] - w.start[words]
    take = ragged(w.start[words], size + 1)  # each with the byte after it, which a word's end always has
    out = w.data[take]
    end = np.cumsum(size + 1)
    out[end - 1] = 0x20
    raw, stop = out.tobytes(), np.concatenate([[0], end])
    first = np.searchsorted(w.text[words], np.arange(n + 1))
    return [raw[stop[x] : max(stop[x], stop[y] - 1)] for x, y in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


def collapse_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_words, runs (start, length, period, by start and period) and kept_text: the words that stay when each run
    keeps its first period, joined by one space."""
    from pyspark.sql.pandas.types import to_arrow_schema

    prepare(docs.sparkSession)
    results = {f.name for f in RESULT}
    docs = docs.drop(*(c for c in docs.columns if c.lower() in results and c != text_col)).withColumn(text_col, F.col(text_col).cast("string"))
    schema = T.StructType([*docs.schema.fields, *RESULT])
    return docs.mapInArrow(giving_back(_collapse(text_col, schema.fieldNames(), to_arrow_schema(schema))), schema)


def with_planted_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs in which every tenth document, by the crc32 h of its id, becomes periodic from word a on: with g = floor(h / 10)
    and n words, a = g % n, and from there its first 1 + floor((n - a) / (3 + g % 8)) words are repeated to n words."""
    h = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)
    words = F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), "[ \\t-\\r]+"), "")
    planted = (
        docs.withColumns({"__w": F.when(h % 10 == 0, words), "__g": g}).withColumn("__n", F.size("__w"))
        .withColumn("__a", F.when(F.col("__n") > 0, F.col("__g") % F.col("__n")).cast("int"))
        .withColumn("__p", (1 + F.floor((F.col("__n") - F.col("__a")) / (3 + F.col("__g") % 8))).cast("int"))
    )
    n, a, p = F.col("__n"), F.col("__a"), F.col("__p")
    times = F.ceil((n - a) / p).cast("int")
    cycle = F.slice(F.flatten(F.array_repeat(F.slice("__w", a + 1, p), times)), F.lit(1), n - a)
    changed = F.array_join(F.concat(F.slice("__w", F.lit(1), a), cycle), " ")
    return planted.withColumn(text_col, F.when(n > 0, changed).otherwise(F.col(text_col))).drop("__w", "__g", "__n", "__a", "__p")


def with_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of collapse_runs' result."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return found.withColumn("__b", best).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("__b.before")).alias("start"), F.col("__b.length").alias("length"), (-F.col("__b.shorter")).alias("period"),
        F.floor(1000 * F.col("__b.length") / -F.col("__b.shorter")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("kept_text").cast("binary"), 256).alias("collapsed_sha256"),
    )
