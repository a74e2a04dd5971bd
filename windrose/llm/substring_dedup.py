"""Repeated passages of words: a count-min prefilter, then exact grouping of what may repeat.

A window is ``size`` consecutive words. The first pass counts windows in a count-min sketch of ROWS rows. Each bucket of
documents makes the sketch of its own windows: it is sparse, so its cells are sent as ascending numbers with a count of
one or two. Each shard of the hash space adds the buckets' sketches up. A merged cell counts all windows that fall in
it, so the least of a window's cells is never below its true count: a window that repeats is never missed. The shard
answers with a bit for each cell. The second pass groups only windows that the sketch takes for repeated, exactly, by a
96-bit key, and finds the smallest document id of each.

The sketch has CELLS cells a row for each shard, and the number of shards grows with the input, so its error stays as
it is at any size.

Defined results: a null text has no words. A word is removed if a window covers it whose words also start in a row with
a smaller id; rows that share an id do not remove from each other; a null id counts as larger than all others. Texts
of fewer words than a window keep everything. An empty table is fine. The documents' own columns are kept, but for
those whose names clash with the results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .blocks import MESSAGE, Buckets, each_shard, messages, pack, pack_sorted, unpack, unpack_sorted
from .common import prepare
from .textnum import U, chunks, encode, mix, space_words, window_hashes

ROWS = 2
CELLS = 1 << 24
#: bytes of text for each shard: about 2,700,000 windows
SHARD_BYTES = 16 << 20
LAST = np.iinfo(np.int64).max

RESULT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_text", T.StringType()),
]


def ids_of(table: pa.Table, id_col: str) -> np.ndarray:
    """Ids as numbers; null is the largest."""
    return table.column(id_col).cast(pa.int64()).fill_null(LAST).combine_chunks().to_numpy(zero_copy_only=False)


def _windows(texts: list[bytes], size: int, second: bool):
    """(row, first word, 64-bit hash, 32 more bits) of each window, chunk by chunk joined."""
    rows, firsts, one, two = [], [], [], []
    for a, b in chunks([len(t) for t in texts]):
        w = space_words(texts[a:b])
        h = window_hashes(w.hashes(0), size, 0)
        ok = w.text[: len(h)] == w.text[size - 1 :] if len(h) else np.empty(0, bool)
        at = np.flatnonzero(ok)
        rows.append(w.text[at] + a)
        firsts.append(at - w.first[w.text[at]])
        one.append(h[ok])
        if second:
            two.append((window_hashes(w.hashes(1), size, 1)[ok] >> U(32)).astype(np.uint32))
    join = lambda x, kind: np.concatenate(x) if x else np.empty(0, kind)
    return join(rows, np.int64), join(firsts, np.int64), join(one, U), join(two, np.uint32)


def _shard(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> U(32)) * U(n) >> U(32)).astype(np.int32)


def _cells(h: np.ndarray, row: int) -> np.ndarray:
    return mix(h + U(row * 0x9E3779B97F4A7C15 % (1 << 64))) & U(CELLS - 1)


def _sketch(texts: list[bytes], size: int, n_shards: int):
    """Distinct (shard, cell) of each row of the sketch, ascending, with counts; and the place of each window's cells."""
    _, _, h, _ = windows = _windows(texts, size, False)
    shard = _shard(h, n_shards)
    rows = []
    for row in range(ROWS):
        key = (shard.astype(U) << U(32)) | _cells(h, row)
        rows.append(np.unique(key, return_inverse=True, return_counts=True))
    return windows, rows


def _split(key: np.ndarray, n_shards: int) -> np.ndarray:
    return np.searchsorted(key >> U(32), np.arange(n_shards + 1, dtype=U))


def _send_sketch(text_col: str, size: int, n_shards: int):
    def run(bucket, table):
        _, rows = _sketch(encode(table.column(text_col).to_pylist()), size, n_shards)
        out = []
        for row, (key, _, count) in enumerate(rows):
            at = _split(key, n_shards)
            for shard in np.flatnonzero(np.diff(at)).tolist():
                a, b = at[shard], at[shard + 1]
                cells = pack_sorted(key[a:b] & U(0xFFFFFFFF))
                data = pack(cells=np.frombuffer(cells, np.uint8), many=np.packbits(count[a:b] > 1))
                out.append((row, bucket, shard, data))
        return messages(out)

    return run


def _merge_sketches(shard, sent):
    """Adds the buckets' sketches; answers with a bit for each cell: counted more than once."""
    out = []
    for row in range(ROWS):
        total = np.zeros(CELLS, np.uint8)
        mine = [(bucket, unpack(data)) for kind, bucket, data in sent if kind == row]
        cells = []
        for _, x in mine:
            c = unpack_sorted(x["cells"].tobytes()).astype(np.int64)
            many = np.unpackbits(x["many"], count=len(c))
            total[c] = np.minimum(total[c] + 1 + many, 2)
            cells.append(c)
        out += [(row, bucket, shard, pack(bits=np.packbits(total[c] > 1))) for (bucket, _), c in zip(mine, cells, strict=True)]
    return messages(out)


def _candidates(table: pa.Table, answers, text_col: str, size: int, n_shards: int):
    """Windows that the merged sketch takes for repeated: row, first word, key and shard, in the order of the text."""
    texts = encode(table.column(text_col).to_pylist())
    (row, first, _, _), rows = _sketch(texts, size, n_shards)
    may = np.ones(len(row), bool)
    for i, (key, where, _) in enumerate(rows):
        at = _split(key, n_shards)
        bit = np.zeros(len(key), bool)
        for kind, shard, data in answers:
            if kind == i:
                a, b = at[shard], at[shard + 1]
                bit[a:b] = np.unpackbits(unpack(data)["bits"], count=b - a)
        may &= bit[where]
    _, _, one, two = _windows(texts, size, True)
    return texts, row[may], first[may], one[may], two[may]


def _grouped(one: np.ndarray, two: np.ndarray, ids: np.ndarray):
    """Sorted distinct keys, the least id of each, and the place of each window's key."""
    order = np.lexsort((ids, two, one))
    a, b = one[order], two[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    where = np.empty(len(a), np.int64)
    where[order] = np.cumsum(new) - 1
    return a[new], b[new], ids[order][new], where


def _send_candidates(id_col: str, text_col: str, size: int, n_shards: int):
    def run(bucket, table, answers):
        _, row, _, one, two = _candidates(table, answers, text_col, size, n_shards)
        one, two, least, _ = _grouped(one, two, ids_of(table, id_col)[row])
        at = np.searchsorted(_shard(one, n_shards), np.arange(n_shards + 1))
        return messages(
            [(ROWS, bucket, s, pack(one=one[at[s] : at[s + 1]], two=two[at[s] : at[s + 1]], least=least[at[s] : at[s + 1]])) for s in np.flatnonzero(np.diff(at)).tolist()]
        )

    return run


def _group_exactly(shard, sent):
    """Answers with a bit for each key: it also stands in another bucket, in a document with a smaller id."""
    parts = [unpack(data) for _, _, data in sent]
    sizes = [len(p["one"]) for p in parts]
    one, two, least = (np.concatenate([p[n] for p in parts]) for n in ("one", "two", "least"))
    _, _, smallest, where = _grouped(one, two, least)
    earlier = np.split(smallest[where] < least, np.cumsum(sizes)[:-1])
    return messages([(ROWS, bucket, shard, pack(bits=np.packbits(x))) for (_, bucket, _), x in zip(sent, earlier, strict=True)])


def _remover(id_col: str, text_col: str, size: int, n_shards: int, names: list[str], schema: pa.Schema):
    def run(bucket, table, answers):
        texts, row, first, one, two = _candidates(table, answers, text_col, size, n_shards)
        ids = ids_of(table, id_col)
        key, _, least, where = _grouped(one, two, ids[row])
        at = np.searchsorted(_shard(key, n_shards), np.arange(n_shards + 1))
        elsewhere = np.zeros(len(key), bool)
        for kind, shard, data in answers:
            if kind == ROWS:
                a, b = at[shard], at[shard + 1]
                elsewhere[a:b] = np.unpackbits(unpack(data)["bits"], count=b - a)
        gone = elsewhere[where] | (ids[row] > least[where])
        row, first = row[gone], first[gone]
        n_words, n_removed, kept = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64), []
        for a, b in chunks([len(t) for t in texts]):
            w = space_words(texts[a:b])
            n_words[a:b] = w.count
            cover = np.zeros(len(w.start) + 1, np.int32)
            lo, hi = np.searchsorted(row, [a, b])
            begin = w.first[row[lo:hi] - a] + first[lo:hi]
            np.add.at(cover, begin, 1)
            np.add.at(cover, begin + size, -1)
            removed = np.cumsum(cover)[:-1] > 0
            n_removed[a:b] = np.bincount(w.text[removed], minlength=b - a)
            for i in range(a, b):
                x, y = int(w.first[i - a]), int(w.first[i - a + 1])
                stay = np.flatnonzero(~removed[x:y]) + x
                kept.append(b" ".join([w.joined[s:e] for s, e in zip(w.start[stay].tolist(), w.end[stay].tolist(), strict=True)]))
        result = {"n_words": pa.array(n_words), "n_removed": pa.array(n_removed), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())}
        return pa.table([result[n] if n in result else table.column(n) for n in names], names=names).cast(schema)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 13) -> DataFrame:
    """docs with n_words, n_removed and kept_text (the words that stay, joined by one space)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    prepare(docs.sparkSession)
    results = {f.name for f in RESULT}
    docs = docs.drop(*(c for c in docs.columns if c in results and c not in (id_col, text_col))).withColumn(text_col, F.col(text_col).cast("string"))
    buckets = Buckets(docs, text_col, [id_col, text_col])
    n_shards = 1 + buckets.bytes // SHARD_BYTES
    sketched = each_shard(buckets.each(_send_sketch(text_col, size, n_shards), MESSAGE), _merge_sketches).checkpoint()
    sent = buckets.each_with(sketched, _send_candidates(id_col, text_col, size, n_shards), MESSAGE)
    grouped = each_shard(sent, _group_exactly).checkpoint()
    schema = T.StructType([*docs.schema.fields, *RESULT])
    remover = _remover(id_col, text_col, size, n_shards, schema.fieldNames(), to_arrow_schema(schema))
    return buckets.each_with(sketched.union(grouped), remover, schema)
