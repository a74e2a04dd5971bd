"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are counted over the whole text, in numpy, for many documents at once. Trees are grown on the driver from
the statistics (never the texts) of at most ``max_rows`` labelled documents: features are cut into bins once, a level of
a tree needs one histogram of gradients by node, feature and bin, and leaves take Newton steps on the logistic loss. The
ensemble is flattened into arrays of complete trees; documents walk all trees together, a level at a time.

Defined results: a null text counts as empty; empty texts are scored like others. Labels that are null are left out; of
several labels of one id the largest counts. Rows with repeated or null ids are scored each on its own. Without
labelled rows, or with one class only, every document gets the share of ones, smoothed. An empty table is fine. Columns
of the documents whose names clash with the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, giving_back, prepare
from .textnum import chunks, encode, space_words, span_hashes

#: labelled documents that trees are fitted to, at most
MAX_ROWS = 20_000

_CLASS = np.full(256, 9, np.uint8)
_CLASS[np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)] = 0
_CLASS[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", np.uint8)] = 1
_CLASS[np.frombuffer(b"0123456789", np.uint8)] = 2
_CLASS[np.frombuffer(b" \t", np.uint8)] = 3
_CLASS[np.frombuffer(b"\r\n", np.uint8)] = 4
_CLASS[np.frombuffer(b"!?", np.uint8)] = 5
_CLASS[np.frombuffer(b".,;:'\"-", np.uint8)] = 6
_CLASS[128:192] = 7
_CLASS[192:] = 8
N_CLASS = 10

FEATURES = [
    "log_bytes", "lower", "upper", "digit", "blank", "line_break", "loud", "punctuation", "continuation", "lead", "symbol",
    "log_words", "word_length", "word_length_spread", "distinct_words", "top_word", "repeated_next", "marked_words", "capital_words", "lines", "repeated_lines", "distinct_pairs",
]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _distinct(text: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, and the count of its commonest."""
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    count = np.diff(np.append(at, len(text)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, text[at], count)
    return np.bincount(text[at], minlength=n), most


def statistics(texts: list[bytes]) -> np.ndarray:
    """FEATURES of each text."""
    n = len(texts)
    w = space_words(texts)
    size = np.diff(w.text_at) - 1
    of_byte = np.repeat(np.arange(n), size + 1)
    classes = np.bincount(of_byte * N_CLASS + _CLASS[w.data], minlength=n * N_CLASS).reshape(n, N_CLASS).astype(float)
    classes[:, 4] -= 1  # the line feed between texts
    h = w.hashes()
    length = (w.end - w.start).astype(float)
    words = w.count
    mean = _share(np.bincount(w.text, length, n), words)
    spread = np.sqrt(np.maximum(_share(np.bincount(w.text, length**2, n), words) - mean**2, 0))
    distinct, top = _distinct(w.text, h, n)
    same_text = w.text[1:] == w.text[:-1]
    pairs = h[1:] * np.uint64(0x9E3779B97F4A7C15) + h[:-1]
    n_pairs = np.bincount(w.text[1:][same_text], minlength=n)
    distinct_pairs, _ = _distinct(w.text[1:][same_text], pairs[same_text], n)
    repeated = np.bincount(w.text[1:][same_text & (h[1:] == h[:-1])], minlength=n)
    last, first = _CLASS[w.data[w.end - 1]] if len(w.end) else np.empty(0, np.uint8), _CLASS[w.data[w.start]] if len(w.start) else np.empty(0, np.uint8)
    marked = np.bincount(w.text[(last == 9) | (last == 5)], minlength=n)
    capital = np.bincount(w.text[(first == 1) & (length > 1) & (_CLASS[w.data[np.minimum(w.start + 1, len(w.data) - 1)]] == 1)], minlength=n) if len(w.start) else np.zeros(n)
    breaks = np.flatnonzero(w.data == 10)
    begin = np.concatenate([[0], breaks[:-1] + 1]) if len(breaks) else np.empty(0, np.int64)
    filled = breaks > begin
    begin, end = begin[filled], breaks[filled]
    line_text = of_byte[begin]
    n_lines = np.bincount(line_text, minlength=n)
    distinct_lines, _ = _distinct(line_text, span_hashes(w.joined, begin, end), n)
    columns = [
        np.log1p(size), *(_share(classes[:, i], size) for i in range(N_CLASS)),
        np.log1p(words), mean, spread, _share(distinct, words), _share(top, words), _share(repeated, words), _share(marked, words), _share(capital, words),
        np.log1p(n_lines), 1 - _share(distinct_lines, n_lines), _share(distinct_pairs, n_pairs),
    ]
    return np.column_stack(columns)


@dataclass
class Trees:
    """Complete trees of one depth: a node's children are 2 i + 1 and 2 i + 2; a value for each last node."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    @property
    def depth(self) -> int:
        return int(np.log2(self.value.shape[1])) if len(self.value) else 0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node - (value.size - 1)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, l2: float = 1.0, least: float = 5.0) -> Trees:
    """Histogram gradient boosting of the logistic loss; no split leaves a node with less than `least` hessian."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    n_inner, n_leaf = (1 << depth) - 1, 1 << depth
    out = Trees(np.zeros((0, n_inner), np.int64), np.zeros((0, n_inner)), np.zeros((0, n_leaf)), base)
    if len(np.unique(y)) < 2:
        return out
    n, f = x.shape
    cuts = [np.unique(np.quantile(x[:, i], np.linspace(0, 1, bins + 1)[1:-1])) for i in range(f)]
    binned = np.column_stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)])  # bin b: at most cuts[b]
    flat = binned + np.arange(f) * bins
    total = np.full(n, base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(n_inner, np.int64), np.full(n_inner, np.inf)
        for level in range(depth):
            at, width = (1 << level) - 1, 1 << level
            index = ((node - at)[:, None] * (f * bins) + flat).ravel()
            hist = [np.bincount(index, np.repeat(v, f), width * f * bins).reshape(width, f, bins) for v in (g, h)]
            left_g, left_h = (v.cumsum(axis=2) for v in hist)
            all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + l2) + right_g**2 / (right_h + l2) - all_g**2 / (all_h + l2)
            gain[(left_h < least) | (right_h < least)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            for k in range(width):
                i, b = divmod(int(best[k]), bins)
                if gain[k, i, b] > 1e-6 and b < len(cuts[i]):
                    feature[at + k], threshold[at + k] = i, cuts[i][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        leaf = node - n_inner
        value = -rate * np.bincount(leaf, g, n_leaf) / (np.bincount(leaf, h, n_leaf) + l2)
        total += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(values), base)


def training_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, train: Column, max_rows: int) -> DataFrame:
    """(id, t, y) of at most max_rows labelled ids, the first by a hash of the id, one row for each; few by that bound."""
    some = (
        labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & train)
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("id"), "id").limit(max_rows)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("t")).join(F.broadcast(some), "id")
    # an id may stand in many rows: of each id one row learns, the one whose text has the least hash
    key = F.xxhash64(F.coalesce("t", F.lit("")))
    least = rows.groupBy("id").agg(F.min(key).alias("k"))
    return rows.withColumn("k", key).join(F.broadcast(least), ["id", "k"]).dropDuplicates(["id"]).select("id", "t", "y")


def _measured(batches):
    for batch in batches:
        texts = encode(batch.column("t").to_pylist())
        for a, b in chunks([len(t) for t in texts]):
            x = statistics(texts[a:b])
            yield pa.RecordBatch.from_arrays([batch.column("id").slice(a, b - a), batch.column("y").slice(a, b - a), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "y", "x"])


def train_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text", folds: int = 5, max_rows: int = MAX_ROWS, **options) -> Trees:
    """Trees fitted to labelled documents whose fold, crc32(id as text) mod folds, is not 0."""
    prepare(docs.sparkSession)
    sample = training_sample(docs, labels, label, id_col, text_col, fold(id_col, folds) != 0, max_rows)
    rows = sample.mapInArrow(giving_back(_measured), "id long, y int, x array<double>").toPandas().sort_values("id")
    x = np.array(rows["x"].tolist(), float).reshape(len(rows), len(FEATURES))
    return fit(x, rows["y"].to_numpy(float), **options)


def score_quality(docs: DataFrame, trees: Trees, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with score, the probability that a document's label is 1."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    prepare(spark)
    docs = docs.drop(*([score_col] if score_col in docs.columns and score_col != text_col else []))
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    arrow = to_arrow_schema(schema)
    model = spark.sparkContext.broadcast(trees)  # its size is set by the number of trees and their depth

    def run(batches):
        for batch in batches:
            texts = encode(batch.column(text_col).cast(pa.string()).to_pylist())
            parts = [model.value.score(statistics(texts[a:b])) for a, b in chunks([len(t) for t in texts])]
            score = pa.array(np.concatenate([*parts, np.empty(0)]))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], names=arrow.names)

    return docs.mapInArrow(giving_back(run), schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, **options) -> DataFrame:
    """The documents that score at least threshold, with the columns of docs."""
    score = "__quality"
    return score_quality(docs, train_quality(docs, labels, **options), score_col=score).where(F.col(score) >= threshold).select(*docs.columns)
