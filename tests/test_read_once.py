"""Operators that need their rows several times read them once: a long plan before them is not run again."""

import pytest
from pyspark.sql import functions as F

from windrose.operators import analysis as A
from windrose.operators import core as C
from windrose.operators import model as M
from windrose.operators import normalize as N
from windrose.operators import ranked as K
from windrose.operators import scenarios as X
from windrose.operators import selection as P
from windrose.operators.boosting import train_monotone
from windrose.plans import adapter
from windrose.plans.adapter import Tables

ROWS = 400


@pytest.fixture
def counted(spark):
    """(rows, number of rows made so far)."""
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    d = spark.range(ROWS).select(
        "id", (F.col("id") % 3).alias("k"), (F.col("id") % 37).cast("double").alias("x"), (F.col("id") % 11).cast("double").alias("y"), (F.col("id") % 7).alias("wind_mean"), (F.col("id") % 9).alias("gust_mean"),
        (F.col("id") % 5).alias("player_rating"), (F.col("id") % 6).alias("round_total_hole_length"), (F.col("id") % 2).alias("precip_sum"),
    )
    return d.mapInArrow(count, d.schema), made


@pytest.fixture(scope="module")
def trees(spark):
    d = spark.range(600).selectExpr("id", "id % 3 k", "cast(id % 7 as double) wind_mean", "id % 5 player_rating", "cast(id % 7 + id % 5 as double) t")
    return train_monotone(d, ["wind_mean", "player_rating"], [], "t", {"wind_mean": 1}, key="id", trees=4, depth=2)[0]


CASES = {
    "exact_quantiles": lambda d, m: K.exact_quantiles(d, ["k"], "x", {"q": 0.3}),
    "residual_summary": lambda d, m: A.residual_summary(d, ["k"], "x", "y"),
    "stability": lambda d, m: A.stability(d, ["k"], "x"),
    "effect_summary": lambda d, m: A.effect_summary(d, ["x", "y"]),
    "bucket_quantiles": lambda d, m: A.bucket_quantiles(d.withColumn("b", F.col("k").cast("string")), "b", "x", ["0", "1"]),
    "validate_dataset": lambda d, m: A.validate_dataset(d, ["id", "k"], ["y"], "x"),
    "qcut": lambda d, m: A.qcut(d, "x", 4),
    "effect_curve": lambda d, m: M.effect_curve(d, {0.0: F.col("x"), 1.0: F.col("y")}),
    "course_effects": lambda d, m: M.course_response(d, "k", "x", 2),
    "engineered": lambda d, m: P.engineered(d),
    "pdp_curve": lambda d, m: X.pdp_curve(d, m, "wind_mean", [0.0, 3.0]),
    "effect_pdp": lambda d, m: X.effect_pdp(d, m, [0.0, 3.0], lambda x: {"wind_mean": x}, lambda x: {"wind_mean": 0.0}, ["id"]),
    "course_response": lambda d, m: X.course_response(d, m, "k", {"wind_mean": 0.0}, {"a": {"wind_mean": 4.0}, "b": {"wind_mean": 6.0}}, {"seen": "y"}, ["id"]),
    "score_scenarios": lambda d, m: X.score_scenarios(d, m, {"wind": {"wind_mean": 0.0}}, ["id"]),
    "key_differences": lambda d, m: C.key_differences(d.select("k"), d.sparkSession.range(2).toDF("k"), ["k"]),
}


@pytest.mark.parametrize("case", CASES)
def test_rows_are_made_once(counted, trees, case):
    d, made = counted
    CASES[case](d, trees).write.format("noop").mode("overwrite").save()
    assert made.value == ROWS


class Plain:
    """The same model without transform_settings: rows are exploded."""

    def __init__(self, model):
        self.transform = model.transform


def test_settings_beside_rows_match_exploded_rows(counted, trees):
    d = counted[0]
    settings = {"own": {}, "at": {"wind_mean": 2.5}, "by": {"wind_mean": F.greatest("wind_mean", F.lit(3.5)), "player_rating": F.lit(1)}, "none": {"wind_mean": F.lit(None)}}
    fast, slow = (sorted(X.scenario_predictions(d, m, settings, ["id"]).collect()) for m in (trees, Plain(trees)))
    assert fast == slow and len(fast) == ROWS
    for f in (CASES["pdp_curve"], CASES["effect_pdp"], CASES["course_response"], CASES["score_scenarios"]):
        fast, slow = (f(d, m) for m in (trees, Plain(trees)))
        assert fast.schema.simpleString() == slow.schema.simpleString() and sorted(map(str, fast.collect())) == sorted(map(str, slow.collect()))
    with pytest.raises(ValueError):
        X.scenario_predictions(d, trees, {"s": {"nothing": 1.0}}, ["id"])


def test_null_keys_and_groups_without_values(spark):
    d = spark.createDataFrame([(1, 2.0), (1, None), (2, None), (None, 4.0), (None, 6.0), (3, float("nan"))], "k int, x double")
    assert {tuple(r) for r in K.exact_quantiles(d, ["k"], "x", {"q": 0.5}).collect()} == {(1, 2.0), (2, None), (None, 5.0), (3, None)}
    assert [tuple(r) for r in K.exact_quantiles(d.where("k = 2"), [], "x", {"q": 0.5}).collect()] == [(None,)]
    assert [tuple(r) for r in K.exact_quantiles(d.limit(0), [], "x", {"q": 0.5}).collect()] == [(None,)]
    a, b = (spark.createDataFrame(x, "k int") for x in ([(1,), (1,), (None,), (2,)], [(2,), (None,), (3,)]))
    assert {tuple(r) for r in C.key_differences(a, b, ["k"]).collect()} == {(1, "left"), (3, "right")}


def test_scores_of_events_are_not_shuffled(spark):
    """Events are few beside their scores, and go to them."""
    payload = '{"data":{"scores":[{"PDGANum":"7","Round":"2","LayoutID":"1","HoleScores":["3","4"]}],"layouts":[]}}'
    snapshots = spark.createDataFrame([(i % 3, "MPO", 1, payload) for i in range(30)], "event_id long, division string, round_number int, payload string")
    events = spark.createDataFrame([(i, "", "", "2024-05-03", "2024-05-05", "", "", "", {"MPO": 2}) for i in range(3)], "event_id long, name string, status_text string, start_date string, end_date string, city string, state string, country string, division_rounds map<string,int>")
    rounds = N.normalize_rounds(snapshots, events.coalesce(1))
    plan = rounds._jdf.queryExecution().executedPlan().toString()
    most = plan[plan.index("max_round") :]
    assert rounds.count() == 30 and "BroadcastHashJoin" in most


def test_rounds_are_not_shuffled_after_their_players(spark):
    """Lines and orders meet by order, holes and customers by player; events are grouped. Nothing else moves."""
    t = Tables(spark, "/root/testdata/sf0.001")
    for d in (t.rounds, t.rounds.select("hole_count", "wind_mean", "precip_sum", "weather_available")):
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= 5
        # newest holes are sorted once, and their rounds are put together as they come
        assert plan.count("Sort [event_year") == 1


def test_more_lines_are_dealt_to_more_tasks(spark, monkeypatch):
    """What a task sorts does not grow with the tables, whatever the session's number of shuffle partitions."""
    few = Tables(spark, "/root/testdata/sf0.001")
    assert few.tasks == 0  # left to Spark
    monkeypatch.setattr(adapter, "LINES", 100)
    many = Tables(spark, "/root/testdata/sf0.001")
    lines = many.table("lineitem").count()
    assert many.tasks == -(-lines // 100) > spark.sparkContext.defaultParallelism
    parts = many.holes.rdd.getNumPartitions()
    assert parts >= many.tasks > few.holes.rdd.getNumPartitions()
    plan = many.rounds._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 5 and plan.count("Sort [event_year") == 1 and "Sort [o_orderkey" not in plan
    assert sorted(map(str, many.rounds.collect())) == sorted(map(str, few.rounds.collect()))
