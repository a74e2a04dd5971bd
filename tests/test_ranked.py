"""Running totals, ranks and exact quantiles within keys, against plain Python; and their plans."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from windrose.operators import ranked


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    value = lambda: rng.choice([1.5, 2.0, -0.0, 0.0, None, float("nan"), rng.random() * 10, -rng.random()])
    return [(rng.choice([None, "hot", "hot", "hot", "b"]), value(), i) for i in range(900)] + [("none", None, 900), ("one", 3.0, 901)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k string, x double, i long").repartition(3)


def groups(rows):
    out = defaultdict(list)
    for k, x, i in rows:
        out[k].append((i, x))
    return out


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_running(df, rows, partitions):
    got = ranked.running(df, ["k"], [F.col("i").desc()], {"nth": ("sum", F.lit(1)), "total": ("sum", F.col("i")), "mixed": ("xor", F.col("i"))}, partitions).collect()
    assert len(got) == len(rows)
    by = groups(rows)
    for r in got:
        after = [i for i, _ in by[r.k] if i > r.i]
        mixed = 0
        for i in after:
            mixed ^= i
        assert (r.nth, r.total, r.mixed) == (len(after), sum(after), mixed)


def test_a_key_lies_in_several_ranges(df):
    """The window's partitions hold a range of a key, so none holds all rows of the commonest."""
    plan = ranked.running(df, ["k"], ["i"], {"nth": ("sum", F.lit(1))}, 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in plan and "__range" in plan
    dealt = df.repartitionByRange(16, "k", "i").groupBy("k", F.spark_partition_id().alias("p")).count().groupBy("k").agg(F.count("*").alias("n"))
    assert max(r.n for r in dealt.collect()) > 5


def test_quantiles(df, rows):
    at = {"least": 0.0, "p10": 0.1, "mid": 0.5, "p90": 0.9, "top": 1.0}
    got = {r.k: tuple(r)[1:] for r in ranked.exact_quantiles(df, ["k"], "x", at).collect()}
    by = groups(rows)
    assert set(got) == set(by)
    for k, pairs in by.items():
        v = [x for _, x in pairs if x is not None and not math.isnan(x)]
        assert np.allclose(got[k], np.quantile(v, list(at.values()))) if v else got[k] == (None,) * 5
    whole = ranked.exact_quantiles(df, [], "x", at).collect()
    v = [x for _, x, _ in rows if x is not None and not math.isnan(x)]
    assert len(whole) == 1 and np.allclose(tuple(whole[0]), np.quantile(v, list(at.values())))


def test_quantiles_of_odd_tables(spark, df):
    assert ranked.exact_quantiles(df.limit(0), ["k"], "x", {"m": 0.5}).collect() == []
    assert [tuple(r) for r in ranked.exact_quantiles(df.limit(0), [], "x", {"m": 0.5}).collect()] == [(None,)]
    ends = spark.createDataFrame([(math.inf,), (math.inf,), (1.0,)], "x double")
    assert tuple(ranked.exact_quantiles(ends, [], "x", {"a": 0.0, "m": 0.5, "b": 1.0}).first()) == (1.0, math.inf, math.inf)
    assert ranked.exact_quantiles(ends.where("x < 2"), [], "x", {"m": 0.25}, places=2).first().m == 1.0


def test_quantiles_have_no_percentile(df):
    plan = ranked.exact_quantiles(df, ["k"], "x", {"m": 0.5})._jdf.queryExecution().toString().lower()
    assert "percentile" not in plan and "collect_list(x" not in plan
