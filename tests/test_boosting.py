"""Monotone boosted trees against a plain grower, over a fine grid, and against free trees; scenarios against loops."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from windrose.operators import boosting, model, scenarios
from windrose.operators.analysis import hash_split
from windrose.plans.adapter import Tables

KEYS = ["tourn_id", "i"]


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(2)
    rows = []
    for i in range(900):
        wind, gust, rating, kind = rng.randint(0, 9) / 2, rng.randint(0, 6), rng.randint(0, 12) * 10.0, rng.choice("abc")
        y = 50 - rating / 20 + np.sin(wind * 2) * 2 + wind * 0.6 + 0.2 * gust + (kind == "a") + rng.random()
        rows.append((i % 40, i, None if rng.random() < 0.03 else wind, gust, rating, None if rng.random() < 0.03 else kind, None if i == 7 else float(y)))
    return spark.createDataFrame(rows, "tourn_id long, i long, wind double, gust int, rating double, kind string, y double").repartition(5).persist()


def split_of(table):
    return hash_split(table.where("y is not null"), "tourn_id", {"train": 64, "valid": 16, "test": 20}).toPandas()


def plain_tree(x, y, depth, signs, low, high, l2):
    """(prediction function, value) of the best tree on raw values, by trying each feature and value."""
    value = lambda r: float(np.clip(r.sum() / (len(r) + l2), low, high))
    score = lambda r, v: 2 * r.sum() * v - (len(r) + l2) * v * v
    best = None
    if depth:
        for f in range(x.shape[1]):
            for t in np.unique(x[:, f])[:-1]:
                left = x[:, f] <= t
                a, b = value(y[left]), value(y[~left])
                gain = round(score(y[left], a) + score(y[~left], b) - score(y, value(y)), 9)
                if gain > 1e-9 and signs[f] * (b - a) >= 0 and (best is None or gain > best[0]):
                    best = (gain, f, t, a, b)
    if best is None:
        v = value(y)
        return lambda q: np.full(len(q), v)
    _, f, t, a, b = best
    left, middle = x[:, f] <= t, (a + b) / 2
    bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[signs[f]]
    lower = plain_tree(x[left], y[left], depth - 1, signs, *bounds[0], l2)
    upper = plain_tree(x[~left], y[~left], depth - 1, signs, *bounds[1], l2)
    return lambda q: np.where(q[:, f] <= t, lower(q), upper(q))


@pytest.mark.parametrize("signs", [{}, {"wind": 1, "gust": 1}, {"wind": -1, "rating": -1}])
def test_trees_are_those_of_a_plain_grower(table, signs):
    numeric = ["wind", "gust", "rating"]
    m, metrics = boosting.train_monotone(table, numeric, ["kind"], "y", signs, trees=5, depth=3, subsample=1.0, patience=99, rate=0.3, l2=2.0)
    d = split_of(table)
    train = d[d.split == "train"]
    mean = train.y.mean()
    code = {k: (g.y.sum() + 10 * mean) / (len(g) + 10) for k, g in train.groupby("kind")}
    raw = lambda p: np.column_stack([p.wind.fillna(-1e9), p.gust, p.rating, p.kind.map(code).fillna(mean)]).astype(float)
    x, y, all_x = raw(train), train.y.to_numpy(), raw(d)
    now, everywhere = np.full(len(y), mean), np.full(len(d), mean)
    losses = []
    for _ in range(5):
        losses.append(np.mean((d.y - everywhere)[d.split == "valid"] ** 2))
        t = plain_tree(x, y - now, 3, [signs.get(n, 0) for n in (*numeric, "kind")], -np.inf, np.inf, 2.0)
        now, everywhere = now + 0.3 * t(x), everywhere + 0.3 * t(all_x)
    losses.append(np.mean((d.y - everywhere)[d.split == "valid"] ** 2))
    assert len(m.trees) == int(np.argmin(losses))
    got = m.transform(table.where("y is not null")).toPandas().set_index("i").prediction
    if len(m.trees) == 5:
        assert np.allclose(got.loc[d.i], everywhere)
    test = metrics.where("split = 'test'").first()
    assert test["rows"] == (d.split == "test").sum()


def test_best_iteration_and_subsamples(table):
    noise = table.withColumn("y", (F.xxhash64("i") % 1000).cast("double"))
    m, _ = boosting.train_monotone(noise, ["wind", "rating"], [], "y", {"wind": 1}, trees=60, patience=3, rate=0.5)
    assert len(m.trees) < 30  # noise teaches nothing for long
    a, _ = boosting.train_monotone(table, ["wind", "rating"], [], "y", {"wind": 1}, trees=20, patience=50, subsample=0.5, depth=2)
    b, _ = boosting.train_monotone(table.repartition(3), ["wind", "rating"], [], "y", {"wind": 1}, trees=20, patience=50, subsample=0.5, depth=2)
    assert len(a.trees) == len(b.trees) > boosting.REFRESH and all(np.allclose(s.value, t.value) and (s.feature == t.feature).all() for s, t in zip(a.trees, b.trees, strict=True))


def test_save_and_load(spark, table, tmp_path):
    m, _ = boosting.train_monotone(table, ["wind", "gust"], ["kind"], "y", {"wind": 1}, trees=4, depth=2)
    m.save(spark, str(tmp_path / "m"))
    again = boosting.BoostedTrees.load(spark, str(tmp_path / "m"))
    a, b = (x.transform(table).agg(F.sum("prediction")).first()[0] for x in (m, again))
    assert a == b and m.importances(spark).agg(F.sum("importance")).first()[0] == pytest.approx(1.0)
    assert again.thresholds("wind") == m.thresholds("wind") == sorted(m.thresholds("wind"))


def test_odd_inputs(spark, table):
    with pytest.raises(ValueError):
        boosting.train_monotone(table, ["wind"], ["kind"], "y", {"kind": 1})
    m, _ = boosting.train_monotone(table.withColumn("wind", F.lit(None).cast("double")), ["wind"], [], "y", {"wind": 1}, trees=3)
    assert m.trees == [] and m.transform(table).where("prediction is null").count() == 0
    empty, _ = boosting.train_monotone(table.limit(0), ["wind"], ["kind"], "y", {"wind": 1}, trees=3)
    assert empty.trees == [] and empty.base == 0.0
    m, _ = boosting.train_monotone(table, ["wind"], ["kind"], "y", {"wind": 1}, trees=3, depth=2)
    unseen = spark.createDataFrame([(float("nan"), "never"), (None, None), (1e9, "a")], "wind double, kind string")
    assert m.transform(unseen).where("prediction is null").count() == 0


@pytest.fixture(scope="module")
def sample(spark):
    rounds = Tables(spark, "/root/testdata/sf0.01").rounds.dropna(subset=model.NUMERIC).persist()
    signs = {"wind_mean": 1, "gust_mean": 1}
    kept, metrics = boosting.train_monotone(rounds, model.NUMERIC, model.CATEGORICAL, model.TARGET, signs, trees=16, depth=3, rate=0.3)
    free, free_metrics = boosting.train_monotone(rounds, model.NUMERIC, model.CATEGORICAL, model.TARGET, {}, trees=16, depth=3, rate=0.3)
    return rounds, kept, metrics, free, free_metrics


def falls(m, rows: pd.DataFrame, column: str, values) -> int:
    """Rows of which some prediction falls from one value to the next."""
    bins = m.bins([rows[c] for c in m.features])
    at, before, fell = m.features.index(column), None, np.zeros(len(rows), bool)
    for v in values:
        bins[:, at] = 1 + np.searchsorted(m.edges[at], v)
        now = m.predict(bins)
        fell |= before is not None and now < before - 1e-9
        before = now
    return int(fell.sum())


def test_predictions_never_fall_over_a_thousand_winds(sample):
    rounds, kept, metrics, free, free_metrics = sample
    rows = rounds.select(*(F.col(c).cast("double") for c in model.NUMERIC), *model.CATEGORICAL).toPandas()
    wind = np.linspace(rows.wind_mean.min() - 1, rows.wind_mean.max() + 1, 1001)
    assert len(kept.trees) > 10 and set(kept.thresholds("wind_mean"))
    assert falls(kept, rows, "wind_mean", wind) == 0 and falls(kept, rows, "gust_mean", wind) == 0
    assert falls(free, rows, "wind_mean", wind) > 0  # the test can see a fall
    rmse = lambda m: {r["split"]: r["rmse"] for r in m.collect()}["test"]
    assert rmse(metrics) <= 1.05 * rmse(free_metrics)


def test_envelope_of_free_trees_never_falls(spark, sample):
    rounds = sample[0].limit(40).persist()
    free, _ = model.train_rounds(sample[0], trees=6)
    assert len(model.thresholds(free, "wind_mean")) >= 3
    winds = spark.createDataFrame([(float(x),) for x in np.linspace(0, 20, 401)], "w double")
    many = rounds.crossJoin(winds).withColumn("wind_mean", F.col("w"))
    got = model.score_monotone(many, free, "wind_mean", "held", [*model.ROUND_KEYS, "w"]).select(*model.ROUND_KEYS, "w", "held").toPandas().sort_values("w")
    assert len(got) == 40 * 401 or len(got) == many.count()
    assert all((np.diff(g.held) >= -1e-9).all() for _, g in got.groupby(model.ROUND_KEYS))


@pytest.fixture(scope="module")
def small(table):
    m, _ = boosting.train_monotone(table, ["wind", "gust", "rating"], ["kind"], "y", {"wind": 1, "gust": 1}, trees=8, depth=3)
    d = table.where("y is not null").toPandas()
    predict = lambda **change: m.predict(m.bins([pd.Series(change[c], index=d.index) if c in change else d[c] for c in m.features]))
    return m, d, predict


def stats(v):
    return [round(float(x), 4) for x in (np.mean(v), np.std(v), np.quantile(v, 0.5), np.quantile(v, 0.1), np.quantile(v, 0.9))]


def test_curves_against_a_loop_over_the_grid(table, small):
    m, d, predict = small
    grid, rows = [0.0, 0.7, 2.5, 4.0], table.where("y is not null")
    got = {r["grid_value"]: [r[c] for c in ("mean", "std", "median", "p10", "p90")] for r in scenarios.pdp_curve(rows, m, "wind", grid).collect()}
    assert set(got) == set(grid)
    for x in grid:
        assert np.allclose(got[x], stats(predict(wind=x)), atol=2e-4)
    effect = scenarios.effect_pdp(rows, m, grid, lambda x: {"wind": x, "gust": F.greatest(F.col("gust"), F.lit(int(x)))}, lambda x: {"wind": 0.0, "gust": 1}, KEYS)
    got = {r["grid_value"]: (r["n"], [r[c] for c in ("mean", "std", "median", "p10", "p90")]) for r in effect.collect()}
    for x in grid:
        want = predict(wind=x, gust=np.maximum(d.gust, int(x))) - predict(wind=0.0, gust=1)
        assert got[x][0] == len(d) and np.allclose(got[x][1], stats(want), atol=2e-4)


def test_course_response_against_a_loop(table, small):
    m, d, predict = small
    rows = table.where("y is not null")
    got = scenarios.course_response(rows, m, "kind", {"wind": 0.0}, {"windy": {"wind": 4.0}, "gusty": {"gust": 6}}, {"observed_wind": "wind"}, KEYS)
    rows_got = {r["kind"]: r for r in got.collect()}
    base = predict(wind=0.0)
    d = d.assign(windy=predict(wind=4.0) - base, gusty=predict(gust=6) - base)
    assert set(rows_got) == {"a", "b", "c", None}
    for k, g in d.groupby(d.kind.fillna("none")):
        r = rows_got[None if k == "none" else k]
        assert r["n"] == len(g) and np.allclose([r["mean_windy"], r["median_windy"], r["mean_gusty"], r["median_gusty"], r["observed_wind"]], [g.windy.mean(), g.windy.median(), g.gusty.mean(), g.gusty.median(), g.wind.mean()], atol=2e-4)
    assert scenarios.most_and_least(got, "kind", "windy", 1).count() == 2


def test_scenarios_hold_the_model_once(table, small):
    m, d, predict = small
    rows = table.where("y is not null")
    out = scenarios.score_scenarios(rows, m, {"calm": {"wind": 0.0}, "gale": {"wind": 9.0}, "none": {"wind": 0.0, "gust": 0}}, KEYS)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 2  # once in the plan, and once more where it is printed by an adaptive plan
    got = out.toPandas().set_index("i").loc[d.i]
    assert np.allclose(got.predicted_gale_reference, predict(wind=9.0)) and np.allclose(got.none_impact, predict() - predict(wind=0.0, gust=0))
    assert list(got.wind.fillna(-1)) == list(d.wind.fillna(-1))
    with pytest.raises(ValueError):
        scenarios.with_settings(rows, {"a": {"nowhere": 1}})
