"""Boosted regression trees whose predictions never fall (or rise) with chosen features; the histograms are Spark's work.

Training keeps rows as bins: a byte for each feature. A pass over them applies the trees so far, puts each training row into
its open node, and adds up residuals and counts by (node, feature, bin): partial sums in each task, then one Spark
aggregation. The driver sees only these histograms, whose size is nodes x features x bins whatever the rows, and chooses the
splits of a level. So a tree of depth d takes d passes.

Monotone features: a split by one is taken only if the child that gets the larger values also gets the larger (for
-1: smaller) prediction. The middle between both becomes a bound of all that grows below: from above on one side, from below on the
other; bounds are handed down, and predictions are cut to them before gains are compared. Each tree is then monotone, and
so is their sum.

Missing values are less than all others. A category becomes the smoothed mean target of its training rows; unseen ones get the
mean of all. Rows without a target are left out of training.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .analysis import hash_split, regression_metrics
from .shared import cut, ship, stored

#: predictions are written beside the rows again after so many trees, so that a pass does not apply all of them
REFRESH = 16
SPLITS = ("train", "valid", "test")
#: rows' weight of the mean of all in a category's number
SMOOTHING = 10.0
#: rows that a task of a pass has at least
ROWS = 50_000
#: values that quantile edges are taken from are counted up to this accuracy of percentile_approx
ACCURACY = 10_000


@dataclass
class Tree:
    """Node i has children 2i + 1 (bin <= at[i]) and 2i + 2; feature is -1 in leaves."""

    feature: np.ndarray
    at: np.ndarray
    value: np.ndarray

    def leaves(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """Number of the node that each row reaches in depth steps."""
        node = np.zeros(len(bins), np.int64)
        for _ in range(depth):
            f = self.feature[node]
            inner = np.flatnonzero(f >= 0)
            if not len(inner):
                break
            where = node[inner]
            node[inner] = 2 * where + 1 + (bins[inner, f[inner]] > self.at[where])
        return node


@dataclass
class BoostedTrees:
    """A trained model; transform(df) adds a prediction column, as the models of pyspark.ml do."""

    numeric: list[str]
    categorical: list[str]
    codes: dict[str, dict[str, float]]  # of categories; "" is what unseen ones get
    edges: list[np.ndarray]  # of each feature, ascending: bin b holds values <= edges[b]
    depth: int
    base: float
    trees: list[Tree] = field(default_factory=list)
    gains: np.ndarray | None = None

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def bins(self, columns: Sequence[pd.Series]) -> np.ndarray:
        columns = [columns] if isinstance(columns, pd.Series) else columns  # a UDF of one column gets it bare
        out = np.empty((len(columns[0]), len(self.edges)), np.uint8)
        for i, x in zip(range(len(self.edges)), columns, strict=True):
            out[:, i] = self.bins_of(i, x)
        return out

    def bins_of(self, feature: int, x: pd.Series) -> np.ndarray:
        if self.features[feature] in self.codes:
            codes = self.codes[self.features[feature]]
            x = x.map(codes).fillna(codes[""])
        v = x.to_numpy(np.float64, na_value=np.nan)
        # one is for edges[0]; nothing is in bin 0 but what is missing
        return np.where(np.isnan(v), 0, 1 + np.searchsorted(self.edges[feature], v))

    def predict(self, bins: np.ndarray, since: int = 0, start: np.ndarray | float | None = None) -> np.ndarray:
        out = np.full(len(bins), self.base) if start is None else np.array(start, np.float64)
        for t in self.trees[since:]:
            out += t.value[t.leaves(bins, self.depth)]
        return out

    def columns(self) -> list:
        """What the model reads of a table."""
        return [*(F.col(c).cast("double") for c in self.numeric), *(F.col(c).cast("string") for c in self.categorical)]

    def transform(self, df: DataFrame) -> DataFrame:
        model = self
        ship(df.sparkSession)

        @F.pandas_udf("double")
        def predicted(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                yield pd.Series(model.predict(model.bins(columns)))

        return df.withColumn("prediction", predicted(*self.columns()))

    def transform_settings(self, df: DataFrame, settings: dict[str, dict], carried: Sequence) -> DataFrame:
        """(carried, a prediction for each setting, by its name): what settings replace by (column -> value) goes beside a row's own
        values, so that rows are neither repeated nor brought together again."""
        model = self
        ship(df.sparkSession)
        replaced = [(i, self.features.index(c)) for i, s in enumerate(settings.values()) for c in s if c in self.features]
        kinds = ["string" if c in self.codes else "double" for c in self.features]
        values = [s[c] for s in settings.values() for c in s if c in self.features]
        number = len(settings)
        others = [(v if isinstance(v, Column) else F.lit(v)).cast(kinds[f]) for v, (_, f) in zip(values, replaced, strict=True)]

        @F.pandas_udf(", ".join(f"s{i} double" for i in range(len(settings))))
        def predicted(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            for columns in batches:
                own, out = model.bins(columns[: len(kinds)]), {}
                for i in range(number):
                    bins = own.copy()
                    for x, (j, f) in zip(columns[len(kinds) :], replaced, strict=True):
                        if i == j:
                            bins[:, f] = model.bins_of(f, x)
                    out[f"s{i}"] = model.predict(bins)
                yield pd.DataFrame(out)

        scored = df.select(*carried, predicted(*self.columns(), *others).alias("__p"))
        return scored.select(*(c for c in scored.columns if c != "__p"), *(F.col(f"__p.s{i}").alias(n) for i, n in enumerate(settings)))

    def importances(self, spark: SparkSession) -> DataFrame:
        """Each feature's share of all gains, the largest first."""
        total = float(self.gains.sum()) or 1.0
        return spark.createDataFrame([(n, float(g) / total) for n, g in zip(self.features, self.gains, strict=True)], "feature string, importance double").orderBy(F.col("importance").desc(), "feature")

    def thresholds(self, feature: str) -> list[float]:
        """Values at which predictions may change with a numeric feature, ascending."""
        i = self.features.index(feature)
        used = {int(b) for t in self.trees for b in t.at[t.feature == i]}
        return sorted(float(self.edges[i][b - 1]) for b in used if 0 < b <= len(self.edges[i]))

    def save(self, spark: SparkSession, path: str) -> None:
        """Trees as a table with a row for each node, and the rest as a line of JSON."""
        rows = [(i, n, int(t.feature[n]), int(t.at[n]), float(t.value[n])) for i, t in enumerate(self.trees) for n in range(len(t.value))]
        spark.createDataFrame(rows, "tree int, node int, feature int, at int, value double").coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        rest = {"numeric": self.numeric, "categorical": self.categorical, "codes": self.codes, "edges": [e.tolist() for e in self.edges], "depth": self.depth, "base": self.base, "gains": self.gains.tolist()}
        spark.createDataFrame([(json.dumps(rest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        rest = json.loads(spark.read.text(f"{path}/model").first()["value"])
        rest |= {"edges": [np.array(e) for e in rest["edges"]], "gains": np.array(rest["gains"])}
        nodes = spark.read.parquet(f"{path}/trees").toPandas().sort_values(["tree", "node"])
        trees = [Tree(t["feature"].to_numpy(np.int64), t["at"].to_numpy(np.int64), t["value"].to_numpy()) for _, t in nodes.groupby("tree")]
        return cls(**rest, trees=trees)


def _sampled(row: np.ndarray, tree: int, share: float) -> np.ndarray:
    """The same rows of a tree each time: by a hash of the row's number and the tree's."""
    x = row.view(np.uint64) ^ np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (x >> np.uint64(11)) < np.uint64(share * (1 << 53))


def _rows(batch: pa.RecordBatch, features: int) -> tuple[np.ndarray, ...]:
    bins = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(-1, features)
    return bins, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "prediction", "split", "row"))


def _histograms(model: BoostedTrees, since: int, growing: Tree, level: int, width: int, subsample: float):
    """Batches of rows -> sums of this task: kind -1 - split for losses (number, sum of squares), else kind = node's number on
    its level, cell = feature x width + bin."""
    first, nodes, features = (1 << level) - 1, 1 << level, len(model.edges)
    number = len(model.trees)

    def run(batches):
        n, g = np.zeros(nodes * features * width, np.int64), np.zeros(nodes * features * width)
        losses = np.zeros((len(SPLITS), 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            bins, y, before, split, row = _rows(batch, features)
            residual = y - model.predict(bins, since, before)
            if level == 0:
                losses[:, 0] += np.bincount(split, minlength=len(SPLITS))
                losses[:, 1] += np.bincount(split, residual**2, len(SPLITS))
            node = growing.leaves(bins, level) - first
            use = np.flatnonzero((split == 0) & (node >= 0) & _sampled(row, number, subsample))
            cell = ((node[use, None] * features + np.arange(features)) * width + bins[use]).ravel()
            n += np.bincount(cell, minlength=len(n))
            g += np.bincount(cell, np.repeat(residual[use], features), len(n))
        some = np.flatnonzero(n)
        kinds = [some // (features * width), -1 - np.flatnonzero(losses[:, 0])]
        cells = [some % (features * width), np.zeros(len(kinds[1]), np.int64)]
        counts = [n[some], losses[-1 - kinds[1], 0].astype(np.int64)]
        sums = [g[some], losses[-1 - kinds[1], 1]]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (kinds, cells, counts, sums)], names=["kind", "cell", "n", "g"])

    return run


def best_split(n: np.ndarray, g: np.ndarray, low: float, high: float, signs: Sequence[int], l2: float, least: int) -> tuple[float, int, int, float, float] | None:
    """(gain, feature, bin, value of the left child, of the right one) of the best split of a node, or None.

    n, g: rows and sums of residuals by feature and bin. low, high: bounds of the node's values. Ties go to the first feature
    and bin.
    """
    value = lambda total, rows: np.clip(total / (rows + l2), low, high)
    gained = lambda total, rows, v: 2 * total * v - (rows + l2) * v * v
    all_n, all_g = n[0].sum(), g[0].sum()
    left_n, left_g = n.cumsum(1)[:, :-1], g.cumsum(1)[:, :-1]
    right_n, right_g = all_n - left_n, all_g - left_g
    left, right = value(left_g, left_n), value(right_g, right_n)
    gain = gained(left_g, left_n, left) + gained(right_g, right_n, right) - gained(all_g, all_n, value(all_g, all_n))
    sign = np.asarray(signs)[:, None]
    gain = np.where((left_n >= least) & (right_n >= least) & (sign * (right - left) >= 0), np.round(gain, 9), 0.0)
    at = int(gain.argmax())
    f, b = divmod(at, gain.shape[1])
    return (float(gain[f, b]), f, b, float(left[f, b]), float(right[f, b])) if gain[f, b] > 1e-9 else None


def _grow(table: DataFrame, model: BoostedTrees, since: int, signs: Sequence[int], rate: float, l2: float, least: int, width: int, subsample: float) -> tuple[Tree, np.ndarray]:
    """The next tree, and for each split its rows and sum of squares before it."""
    size, features = 2 ** (model.depth + 1) - 1, len(model.edges)
    tree = Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size))
    bounds = {0: (-np.inf, np.inf)}
    losses = np.zeros((len(SPLITS), 2))
    for level in range(model.depth):
        sums = table.mapInArrow(_histograms(model, since, tree, level, width, subsample), "kind long, cell long, n long, g double").groupBy("kind", "cell").agg(F.sum("n").alias("n"), F.sum("g").alias("g")).toPandas()
        for kind, n, g in sums[sums.kind < 0][["kind", "n", "g"]].itertuples(index=False):
            losses[-1 - int(kind)] = n, g
        sums = sums[sums.kind >= 0]
        n, g = np.zeros((1 << level, features * width)), np.zeros((1 << level, features * width))
        n[sums.kind, sums.cell], g[sums.kind, sums.cell] = sums.n, sums.g
        grown = False
        for k in range(1 << level):
            node = (1 << level) - 1 + k
            if node not in bounds:
                continue
            low, high = bounds.pop(node)
            own_n, own_g = n[k].reshape(features, width), g[k].reshape(features, width)
            if node == 0:
                tree.value[0] = np.clip(own_g[0].sum() / (own_n[0].sum() + l2), low, high) if own_n[0].sum() else 0.0
            split = best_split(own_n, own_g, low, high, signs, l2, least)
            if split is None:
                continue
            gain, f, b, left, right = split
            tree.feature[node], tree.at[node] = f, b
            tree.value[2 * node + 1], tree.value[2 * node + 2] = left, right
            model.gains[f] += gain
            middle = (left + right) / 2
            up, down = ((low, middle), (middle, high)), ((middle, high), (low, middle))
            bounds[2 * node + 1], bounds[2 * node + 2] = {1: up, -1: down, 0: ((low, high), (low, high))}[signs[f]]
            grown = True
        if not grown:
            break
    tree.value *= rate
    return tree, losses


def _edges(df: DataFrame, columns: dict[str, object], bins: int) -> list[np.ndarray]:
    """Quantile edges of each column; one pass, with a bounded sketch for each."""
    at = [i / bins for i in range(1, bins)] + [1.0]
    row = df.agg(*(F.percentile_approx(c, at, ACCURACY).alias(n) for n, c in columns.items())).first()
    return [np.unique(np.array(row[n] or [], np.float64)) for n in columns]


def _codes(df: DataFrame, column: str, target: str) -> dict[str, float]:
    """A number for each category: the smoothed mean target of its rows."""
    mean = df.agg(F.avg(target)).first()[0] or 0.0
    rows = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("c")).agg(((F.sum(target) + SMOOTHING * mean) / (F.count("*") + SMOOTHING)).alias("m"))
    return {"": mean} | {r["c"]: r["m"] for r in rows.toLocalIterator()}


def train_monotone(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    target: str,
    signs: dict[str, int],
    key: str = "tourn_id",
    trees: int = 200,
    depth: int = 4,
    rate: float = 0.1,
    l2: float = 10.0,
    bins: int = 64,
    subsample: float = 0.8,
    least: int = 1,
    patience: int = 20,
) -> tuple[BoostedTrees, DataFrame]:
    """(model, metrics by split: rows, mae, rmse, r2). signs: features and the direction, 1 or -1, that predictions keep.

    Whole keys are split 64/16/20. Training ends when the middle part has not improved for `patience` trees, and the trees up
    to its best iteration stay. A tree learns from the share `subsample` of the training rows. Categories' numbers are held on
    the driver and in the model, one for each category.
    """
    if not 2 <= bins <= 254 or not 1 <= depth <= 10:
        raise ValueError("2 to 254 bins and depths of 1 to 10 are possible")
    if unknown := set(signs) - set(numeric):
        raise ValueError(f"only numeric features can be monotone: {sorted(unknown)}")
    ship(df.sparkSession)
    d = hash_split(df.where(F.col(target).isNotNull()), key, {"train": 64, "valid": 16, "test": 20}).withColumn("__y", F.col(target).cast("double"))
    # what is read again and again is made once
    d = stored(d.select(*dict.fromkeys([*numeric, *categorical]), "__y", "split", F.xxhash64(*d.columns).alias("__row")))
    train = d.where("split = 'train'")
    codes = {c: _codes(train, c, "__y") for c in categorical}
    model = BoostedTrees(list(numeric), list(categorical), codes, [], depth, train.agg(F.avg("__y")).first()[0] or 0.0)
    edges = _edges(train, {c: F.col(c).cast("double") for c in numeric}, bins)
    # a category's number is its own edge, unless there are too many
    for c in categorical:
        x = np.unique(list(codes[c].values()))
        edges.append(x if len(x) <= bins else np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:], method="nearest")))
    model.edges, model.gains = edges, np.zeros(len(edges))
    width = 2 + max(len(e) for e in edges)

    @F.pandas_udf("binary")
    def binned(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in batches:
            yield pd.Series([x.tobytes() for x in model.bins(columns)])

    code = F.when(F.col("split") == "train", 0).when(F.col("split") == "valid", 1).otherwise(2)
    # rows are a few bytes each: a pass's task should have many
    table = cut(d.coalesce(1 + d.count() // ROWS).select(binned(*model.columns()).alias("bins"), F.col("__y").alias("y"), F.lit(model.base).alias("prediction"), code.alias("split"), F.col("__row").alias("row")))
    schema, features, since = table.schema, len(edges), 0
    direction = [signs.get(c, 0) for c in model.features]
    best, best_at, stale = np.inf, 0, 0
    gains = model.gains.copy()
    for number in range(trees + 1):  # the pass of a tree measures those before it
        tree, losses = _grow(table, model, since, direction, rate, l2, least, width, subsample)
        measured = losses[1] if losses[1, 0] else losses[0]
        loss = measured[1] / max(1.0, measured[0])
        if loss < best - 1e-12:
            best, best_at, stale, gains_at_best = loss, number, 0, gains
        else:
            stale += 1
        if number == trees or stale >= patience or (tree.feature < 0).all():
            break
        model.trees.append(tree)
        gains = model.gains.copy()
        if len(model.trees) - since >= REFRESH:
            table, since = cut(table.mapInArrow(_refreshed(model, since, features), schema)), len(model.trees)
    model.trees, model.gains = model.trees[:best_at], gains_at_best
    return model, regression_metrics(model.transform(d), ["split"], "__y", "prediction")


def _refreshed(model: BoostedTrees, since: int, features: int):
    """Rows with predictions that take in all trees so far."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                bins, _, before, _, _ = _rows(batch, features)
                at = batch.schema.get_field_index("prediction")
                yield batch.set_column(at, batch.schema.field(at), pa.array(model.predict(bins, since, before)))

    return run
