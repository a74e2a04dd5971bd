"""Repeated byte strings: threshold-bounded interval expansion on Burrows-Wheeler transforms.

A byte is removed if a string of ``length`` bytes covers it that also starts earlier: in a smaller document id, or
earlier in the same document. Strings that are equal must meet in one task, so texts are first cut into segments by
content. Of the GRAM-byte strings in a window of ``length`` bytes, the one with the least hash is the window's anchor.
A segment is a run of windows with one anchor; equal windows have equal anchors. Segments are the unit that is sent:

1. Each bucket of documents tells the shard of each anchor which segments it has: a hash of the anchor, 64 more bits of
   the whole segment, and the place of its first copy. A shard answers for each: alone; a later copy of an equal
   segment (all of its windows start earlier, so it is gone); or the first of its kind, beside different segments with
   that anchor, which may share some windows.
2. Only the text of the last kind is sent, to the shard of its anchor. There, in parts of PART_BYTES, segments are
   joined, with separators, to one text and its suffixes are sorted by their first bytes. On its transform, intervals
   are extended backward, breadth first, from the empty string: level l holds intervals of strings of l bytes, and the
   first interval to end at a place of the suffix order fixes the common prefix there to l. An interval that fixes
   nothing new is not followed. Common prefixes come out in increasing order, so the search stops at ``length``:
   places that are not fixed by then join suffixes whose common prefix is long enough. Runs of such places are equal
   strings; all but the first by (id, start) are gone.
3. Each bucket removes the bytes that its gone windows cover.

An anchor whose different segments would pass PART_BYTES is met window by window instead: each bucket sends 128 bits of
hash of each distinct window of such segments, with its first place, to a part that the hash chooses, so that they spread
over all parts; a part answers which windows start earlier elsewhere. Only the hashes of the first pass (28 bytes for each
different segment) meet by anchor.

Defined results: a null text is empty. Of rows that share an id, at one place of both, either
counts as earlier; each string stays once. A null id counts as larger than all others. Removal may cut a character:
kept_bytes is exact, kept_text leaves out what stays of such a one. An empty table is fine. The documents' own columns
are kept, but for those whose names clash with the results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import MESSAGE, Buckets, each_shard, messages, pack, unpack
from .common import prepare
from .substring_dedup import ids_of
from .textnum import GRAM, U, chunks, combined_grams, encode, gram_hashes, merge_spans, mix, ragged

#: bytes of text for each shard of anchors: about 500,000 segments
SHARD_BYTES = 16 << 20
#: bytes of segments that are sorted together, if one anchor has no more
PART_BYTES = 1 << 20
#: bits of a place within a piece of text; pieces are shorter than that
PLACE = 22
PIECE = 1 << 20

#: parts of windows for each part of texts
WINDOW_PARTS = 4

ALONE, COPY, CLOSE, WIDE = 0, 1, 2, 3
FIRST_PASS, TEXT, GONE, WINDOW = 0, 1, 2, 3

RESULT = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("n_spans", T.LongType()),
]
KEPT = {"bytes": T.StructField("kept_bytes", T.BinaryType()), "text": T.StructField("kept_text", T.StringType())}


def _least_in_windows(key: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive keys."""
    out, span = key, 1
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _pieces(texts: list[bytes], length: int):
    """(text, offset, bytes): whole texts together up to PIECE bytes; longer ones cut, with length - 1 bytes of overlap."""
    for a, b in chunks([len(t) for t in texts], PIECE):
        if b - a == 1 and len(texts[a]) > 2 * PIECE:
            for at in range(0, len(texts[a]), PIECE):
                yield a, b, at, [texts[a][at : at + PIECE + length - 1]]
        else:
            yield a, b, 0, texts[a:b]


def segments(texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """Segments in the order of the text: row, start (byte), windows, h (of the anchor), s (of the whole segment)."""
    out: dict[str, list[np.ndarray]] = {k: [] for k in ("row", "start", "windows", "h", "s")}
    width = length - GRAM + 1
    for a, _, offset, part in _pieces(texts, length):
        raw = b"".join(part)
        if len(raw) < length:
            continue
        gram = gram_hashes(raw)
        key = ((gram >> U(PLACE)) << U(PLACE)) | np.arange(len(gram), dtype=U)
        anchor = (_least_in_windows(key, width) & U((1 << PLACE) - 1)).astype(np.int64)
        ends = np.cumsum(np.fromiter((len(t) for t in part), np.int64, len(part)))
        row = np.repeat(np.arange(len(part)), np.diff(ends, prepend=0))
        n = len(anchor)
        inside = row[:n] == row[length - 1 : length - 1 + n]
        new = np.ones(n, bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:n] != row[: n - 1])
        begin = np.flatnonzero(new & inside)
        # a run ends at the next one, or where windows no longer fit in the text
        stop = np.minimum(np.append(np.flatnonzero(new), n)[np.searchsorted(np.flatnonzero(new), begin) + 1], ends[row[begin]] - length + 1)
        windows = stop - begin
        whole = combined_grams(gram, begin, windows + length - 1)
        out["row"].append(row[begin] + a)
        out["start"].append(begin - (ends - np.fromiter((len(t) for t in part), np.int64, len(part)))[row[begin]] + offset)
        out["windows"].append(windows)
        out["h"].append(gram[anchor[begin]])
        # where the anchor stands, and the number of windows, are part of the segment
        out["s"].append(mix(whole + (anchor[begin] - begin).astype(U)))
    return {k: np.concatenate(v) if v else np.empty(0, U if k in "hs" else np.int64) for k, v in out.items()}


def _shard(h: np.ndarray, n: int) -> np.ndarray:
    return ((mix(h ^ U(0xA0761D6478BD642F)) >> U(32)) * U(n) >> U(32)).astype(np.int32)


def _distinct(seg: dict[str, np.ndarray], ids: np.ndarray, n_shards: int):
    """Order of the first copies in the bucket, by shard, anchor and segment; and the place of each segment's copy there."""
    shard = _shard(seg["h"], n_shards)
    doc = ids[seg["row"]]
    order = np.lexsort((seg["start"], doc, seg["s"], seg["h"], shard))
    h, s = seg["h"][order], seg["s"][order]
    new = np.ones(len(order), bool)
    new[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
    where = np.empty(len(order), np.int64)
    where[order] = np.cumsum(new) - 1
    first = order[new]
    return first, where, np.searchsorted(shard[first], np.arange(n_shards + 1)), doc


def _send_segments(id_col: str, text_col: str, length: int, n_shards: int):
    def run(bucket, table):
        seg = segments(encode(table.column(text_col).to_pylist()), length)
        first, _, at, doc = _distinct(seg, ids_of(table, id_col), n_shards)
        out = []
        for s in np.flatnonzero(np.diff(at)).tolist():
            x = first[at[s] : at[s + 1]]
            out.append((FIRST_PASS, bucket, s, pack(h=seg["h"][x], s=seg["s"][x], doc=doc[x], start=seg["start"][x].astype(np.uint32 if len(x) and seg["start"][x].max() < 1 << 32 else np.int64))))
        return messages(out)

    return run


def _compare_segments(wide: int):
    """wide: how many different segments of one anchor are met by their text."""

    def run(shard, sent):
        """Answers with a kind for each segment."""
        parts = [unpack(data) for _, _, data in sent]
        sizes = [len(p["h"]) for p in parts]
        h, s, doc = (np.concatenate([p[k] for p in parts]) for k in ("h", "s", "doc"))
        start = np.concatenate([p["start"].astype(np.int64) for p in parts])
        order = np.lexsort((start, doc, s, h))
        h, s = h[order], s[order]
        same_h = np.zeros(len(h), bool)
        same_h[1:] = h[1:] == h[:-1]
        same = same_h.copy()
        same[1:] &= s[1:] == s[:-1]
        group = np.cumsum(~same_h) - 1
        different = np.bincount(group, weights=~same)[group]
        kind = np.empty(len(h), np.uint8)
        kind[order] = np.where(same, COPY, np.where(different > wide, WIDE, np.where(different > 1, CLOSE, ALONE)))
        return messages([(FIRST_PASS, bucket, shard, pack(kind=k)) for (_, bucket, _), k in zip(sent, np.split(kind, np.cumsum(sizes)[:-1]), strict=True)])

    return run


def _windows(texts: list[bytes], seg: dict[str, np.ndarray], some: np.ndarray, doc: np.ndarray, length: int):
    """All windows of some segments, by hash and then place: 128 bits of hash, doc, row, start; and which are the first of their kind."""
    row, windows = seg["row"][some], seg["windows"][some]
    one, two = [], []
    for a, b in chunks((windows + length - 1).tolist(), PIECE):
        raw = b"".join([texts[r][s : s + w + length - 1] for r, s, w in zip(row[a:b].tolist(), seg["start"][some[a:b]].tolist(), windows[a:b].tolist(), strict=True)])
        sizes = windows[a:b] + length - 1
        place = ragged(np.cumsum(sizes) - sizes, windows[a:b])
        for k, of in enumerate((one, two)):
            of.append(combined_grams(gram_hashes(raw, k), place, np.full(len(place), length), k))
    one, two = np.concatenate(one), np.concatenate(two)
    where = np.repeat(np.arange(len(some)), windows)
    start, doc, row = ragged(seg["start"][some], windows), doc[some][where], row[where]
    order = np.lexsort((start, doc, two, one))
    one, two = one[order], two[order]
    new = np.ones(len(order), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    return {"one": one, "two": two, "doc": doc[order], "row": row[order], "start": start[order]}, new


def _spread_text(id_col: str, text_col: str, length: int, n_shards: int, n_parts: int):
    """Rows of two kinds: to shards, the text of close segments; to the bucket itself, its windows that are gone already."""

    def run(bucket, table, answers):
        texts = encode(table.column(text_col).to_pylist())
        seg = segments(texts, length)
        first, where, at, doc = _distinct(seg, ids_of(table, id_col), n_shards)
        kind = np.zeros(len(first), np.uint8)
        for of, shard, data in answers:
            if of == FIRST_PASS:
                kind[at[shard] : at[shard + 1]] = unpack(data)["kind"]
        later = np.ones(len(where), bool)
        later[first] = False
        gone = later | (kind[where] == COPY)
        out = [(GONE, bucket, 0, pack(row=seg["row"][gone], start=seg["start"][gone], windows=seg["windows"][gone]))]
        close = first[kind == CLOSE]
        part = _shard(seg["h"][close], n_parts)
        order = np.argsort(part, kind="stable")
        close, at = close[order], np.searchsorted(part[order], np.arange(n_parts + 1))
        for p in np.flatnonzero(np.diff(at)).tolist():
            x = close[at[p] : at[p + 1]]
            row, start, windows = seg["row"][x], seg["start"][x], seg["windows"][x]
            text = b"".join([texts[r][s : s + w + length - 1] for r, s, w in zip(row.tolist(), start.tolist(), windows.tolist(), strict=True)])
            out.append((TEXT, bucket, p, pack(h=seg["h"][x], doc=doc[x], row=row, start=start, windows=windows, text=np.frombuffer(text, np.uint8))))
        wide = first[kind == WIDE]
        if len(wide):
            w, new = _windows(texts, seg, wide, doc, length)
            out.append((GONE, bucket, 0, pack(row=w["row"][~new], start=w["start"][~new], windows=np.ones(int((~new).sum()), np.int64))))
            w = {k: v[new] for k, v in w.items()}
            # hashes are in order, so parts, ranges of the hash, are runs
            part = ((w["one"] >> U(32)) * U(WINDOW_PARTS * n_parts) >> U(32)).astype(np.int64)
            at = np.searchsorted(part, np.arange(WINDOW_PARTS * n_parts + 1))
            for p in np.flatnonzero(np.diff(at)).tolist():
                out.append((WINDOW, bucket, n_parts + p, pack(**{k: v[at[p] : at[p + 1]] for k, v in w.items()})))
        return messages(out)

    return run


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of symbols (0: separator, at the end too), sorted by their first `depth` symbols at least."""
    n = len(symbols)
    h = 7
    padded = np.concatenate([symbols.astype(np.int64), np.zeros(h, np.int64)])
    key = np.zeros(n, np.int64)
    for i in range(h):
        key = (key << 9) | padded[i : i + n]
    while True:
        order = np.argsort(key, kind="stable")
        k = key[order]
        step = np.zeros(n, np.int64)
        step[1:] = k[1:] != k[:-1]
        if h >= depth or step.sum() == n - 1:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(step) + 1
        key = rank * (n + 2)
        key[: n - h] += rank[h:]
        h *= 2


def long_prefixes(symbols: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each place i of the suffix order: do suffixes i - 1 and i share `length` symbols or more, without separators?"""
    n = len(symbols)
    bwt = symbols[order - 1]  # the symbol before; before the first stands the last, a separator
    by_symbol = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[by_symbol] = np.arange(n)  # place of the suffix that is longer by the symbol before it
    # the place of the same symbol before and after each place of the transform
    before, after = np.full(n, -1, np.int64), np.full(n, n, np.int64)
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    after[by_symbol[:-1][same]] = by_symbol[1:][same]
    open_ = np.ones(n + 1, bool)  # the common prefix before this place is not fixed yet
    open_[0] = open_[n] = False
    n_separators = int((symbols == 0).sum())
    open_[1:n_separators] = False  # suffixes that start with a separator share nothing
    left, right = np.zeros(1, np.int64), np.full(1, n - 1, np.int64)  # the empty string's interval
    for level in range(length):
        size = right - left + 1
        interval = np.repeat(np.arange(len(left)), size)
        place = ragged(left, size)
        if level:
            ok = bwt[place] != 0
            interval, place = interval[ok], place[ok]
        first = before[place] < left[interval]
        last = after[place] > right[interval]
        # an interval's distinct symbols, in the same order from first and from last places
        a, b = place[first], place[last]
        a = lf[a[np.lexsort((bwt[a], interval[first]))]]
        b = lf[b[np.lexsort((bwt[b], interval[last]))]]
        fresh = open_[b + 1]
        if level == 0:
            fresh |= b + 1 == n
        a, b = a[fresh], b[fresh]
        open_[b + 1] = False
        left, right = a, b
        if not len(left):
            break
    return open_[:n]  # a place between suffixes that reach a separator within `length` symbols may stay open


def repeated_windows(data: np.ndarray, windows: np.ndarray, doc: np.ndarray, start: np.ndarray, length: int):
    """Of joined segments, (segment, window) of each window that equals one that starts earlier by (doc, start)."""
    sizes = windows + length - 1
    ends = np.cumsum(sizes)
    # symbols are bytes + 1, with a separator after each segment
    n_seg = len(windows)
    segment = np.repeat(np.arange(n_seg), sizes)
    symbols = np.zeros(len(data) + n_seg, np.int64)
    symbols[np.arange(len(data)) + segment] = data.astype(np.int64) + 1
    order = suffix_order(symbols, length)
    # only windows count: starts with `length` symbols before the separator
    window_start = np.zeros(len(symbols), bool)
    window_start[: len(symbols) - length] = True
    to_separator = np.repeat(ends + np.arange(n_seg), sizes + 1) - np.arange(len(symbols))
    window_start &= to_separator >= length
    is_window = window_start[order]
    joined = long_prefixes(symbols, order, length) & is_window
    joined[1:] &= is_window[:-1]
    begin = np.concatenate([[0], (ends + np.arange(1, n_seg + 1))[:-1]])  # of each segment among the symbols
    group = np.cumsum(~joined) - 1
    many = np.bincount(group) > 1
    take = many[group]
    at, group = order[take], group[take]
    seg = np.searchsorted(begin, at, side="right") - 1
    window = at - begin[seg]
    rank = np.lexsort((start[seg] + window, doc[seg], group))
    seg, window, group = seg[rank], window[rank], group[rank]
    head = np.ones(len(group), bool)
    head[1:] = group[1:] != group[:-1]
    return seg[~head], window[~head]


def _later_windows(parts: list[tuple[int, dict]]):
    """(bucket, row, start) of each window that starts earlier in another bucket."""
    x = {k: np.concatenate([p[k] for _, p in parts]) for k in ("one", "two", "doc", "row", "start")}
    bucket = np.repeat([b for b, _ in parts], [len(p["one"]) for _, p in parts])
    order = np.lexsort((x["start"], x["doc"], x["two"], x["one"]))
    one, two = x["one"][order], x["two"][order]
    later = np.zeros(len(order), bool)
    later[1:] = (one[1:] == one[:-1]) & (two[1:] == two[:-1])
    some = order[later]
    return bucket[some], x["row"][some], x["start"][some]


def _gone(shard: int, of: np.ndarray, row: np.ndarray, start: np.ndarray):
    """Windows that are gone, to the bucket of each."""
    order = np.lexsort((start, row, of))
    of, row, start = of[order], row[order], start[order]
    out = []
    for b in np.unique(of).tolist():
        lo, hi = np.searchsorted(of, [b, b + 1])
        out.append((GONE, b, shard + 1, pack(row=row[lo:hi], start=start[lo:hi], windows=np.ones(hi - lo, np.int64))))
    return messages(out)


def _expand(length: int):
    def run(shard, sent):
        """Windows of close segments that start earlier in another one, back to the bucket of each."""
        parts = [(bucket, unpack(data)) for _, bucket, data in sent]
        if not parts:
            return messages([])
        if sent[0][0] == WINDOW:
            return _gone(shard, *_later_windows(parts))
        x = {k: np.concatenate([p[k] for _, p in parts]) for k in ("h", "doc", "row", "start", "windows", "text")}
        bucket = np.repeat([b for b, _ in parts], [len(p["h"]) for _, p in parts])
        sizes = x["windows"] + length - 1
        begin = np.cumsum(sizes) - sizes
        by_anchor = np.argsort(x["h"], kind="stable")
        h = x["h"][by_anchor]
        edge = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        group_bytes = np.add.reduceat(sizes[by_anchor], edge)
        found = []
        bounds = np.append(edge, len(h))
        for a, b in chunks(group_bytes.tolist(), PART_BYTES):
            some = by_anchor[bounds[a] : bounds[b]]
            data = x["text"][ragged(begin[some], sizes[some])]
            seg, window = repeated_windows(data, x["windows"][some], x["doc"][some], x["start"][some], length)
            found.append((some[seg], window))
        seg, window = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        start = x["start"][seg] + window
        return _gone(shard, bucket[seg], x["row"][seg], start)

    return run


def _remover(text_col: str, length: int, names: list[str], schema: pa.Schema):
    def run(bucket, table, answers):
        texts = encode(table.column(text_col).to_pylist())
        got = [unpack(data) for _, _, data in answers]
        row, start, windows = (np.concatenate([*(x[k] for x in got), np.empty(0, np.int64)]) for k in ("row", "start", "windows"))
        order = np.lexsort((start, row))
        row, start, end = row[order], start[order], (start + windows + length - 1)[order]
        at = np.searchsorted(row, np.arange(len(texts) + 1))
        n_removed, n_spans, kept = [], [], []
        for i, text in enumerate(texts):
            a, b = merge_spans(start[at[i] : at[i + 1]], end[at[i] : at[i + 1]])
            n_removed.append(int((b - a).sum()))
            n_spans.append(len(a))
            kept.append(b"".join([text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True)]))
        result = {"n_bytes": pa.array([len(t) for t in texts], pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "n_spans": pa.array(n_spans, pa.int64()), "kept_bytes": pa.array(kept, pa.binary())}
        if "kept_text" in names:
            result["kept_text"] = pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string())
        return pa.table([result[n] if n in result else table.column(n) for n in names], names=names).cast(schema)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 100, kept: str = "bytes") -> DataFrame:
    """docs with n_bytes, n_removed, n_spans, and kept_bytes or kept_text, as kept says."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if length <= GRAM:
        raise ValueError(f"length must be over {GRAM}")
    prepare(docs.sparkSession)
    added = [*RESULT, KEPT[kept]]
    results = {f.name for f in added}
    docs = docs.drop(*(c for c in docs.columns if c in results and c not in (id_col, text_col))).withColumn(text_col, F.col(text_col).cast("string"))
    buckets = Buckets(docs, text_col, [id_col, text_col])
    n_shards = n_parts = 1 + buckets.bytes // SHARD_BYTES
    compared = each_shard(buckets.each(_send_segments(id_col, text_col, length, n_shards), MESSAGE), _compare_segments(PART_BYTES // (2 * length))).checkpoint()
    spread = buckets.each_with(compared, _spread_text(id_col, text_col, length, n_shards, n_parts), MESSAGE).checkpoint()
    expanded = each_shard(spread.where(F.col("kind").isin(TEXT, WINDOW)), _expand(length))
    gone = spread.where(F.col("kind") == GONE).union(expanded)
    schema = T.StructType([*docs.schema.fields, *added])
    return buckets.each_with(gone, _remover(text_col, length, schema.fieldNames(), to_arrow_schema(schema)), schema)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs, each text without its repeats, with the same columns (n_chars, if there, is counted again).

    Bytes that stay of a character that was cut are left out of the text.
    """
    out = remove_repeats(docs, id_col, text_col, kept="text", **options).withColumn(text_col, F.when(F.col(text_col).isNotNull(), F.col("kept_text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
