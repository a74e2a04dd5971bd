"""Scalars, joins, features and model inputs on literal rows; all queries with SQL agree with DuckDB on the smallest tables."""

import datetime as dt
import itertools

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from windrose.functions import scalars as S
from windrose.operators import analysis as A
from windrose.operators import core as C
from windrose.operators import quality as Q
from windrose.plans import queries as P

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FOLDER = "/root/testdata/sf0.001"


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def values(spark, f, items, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_casts(spark):
    assert values(spark, S.to_int, ["3", " 4 ", "3.0", "", None, "x", "-7", "99999999999999999999"]) == [3, 4, None, None, None, None, -7, None]
    assert values(spark, S.to_double, ["1.5", " ", None, "x"]) == [1.5, None, None, None]
    assert values(spark, S.to_bool, ["1", "Yes", "n", "FALSE", "maybe", None, ""]) == [True, True, False, False, None, None, None]
    assert values(spark, S.collapse_spaces, [" a \n b", None]) == ["a b", ""]


def test_clocks_and_times(spark):
    assert values(spark, S.clock_seconds, ["08:30", "8:05:10", "12:00 AM", "1:15 pm", "13:00 PM", "25:00", "soon", None]) == [30600, 29110, 0, 47700, None, None, None, None]
    t = dt.datetime(2024, 5, 3, 8, 22)
    assert values(spark, S.parse_ts, ["2024-05-03 08:22:00", "2024-05-03T08:22:00Z", "2024-05-03", "2024-13-03 08:22:00"]) == [t, t, None, None]
    assert values(spark, lambda c: S.iso_to_utc(c).cast("string"), ["2024-05-03T08:22:00Z", "2024-05-03T08:22:00+02:00", "bad"]) == ["2024-05-03 08:22:00", "2024-05-03 06:22:00", None]
    assert values(spark, S.parse_date, ["2024-05-03T10", "2024-5-3", "2024-99-03"]) == [dt.date(2024, 5, 3), None, None]


def test_start_and_join_time_steps(spark):
    ntz, date = (lambda x: F.lit(x).cast("timestamp_ntz")), (lambda x: F.lit(x).cast("date"))
    none_t, none_d = F.lit(None).cast("timestamp_ntz"), F.lit(None).cast("date")
    clock = lambda x: S.clock_seconds(F.lit(x))
    start = one(spark, S.estimate_start(clock("10:00"), ntz("2024-05-03 09:00:00"), none_d))[0]
    assert (start["ts"], start["method"], start["lag_minutes"]) == (dt.datetime(2024, 5, 2, 10), "raw_tee_time", 23 * 60)
    assert one(spark, S.estimate_start(clock(None), ntz("2024-05-03 09:00:00"), none_d))[0]["ts"] == dt.datetime(2024, 5, 3, 1, 31)
    assert one(spark, S.estimate_start(clock("10:00"), none_t, date("2024-05-03")))[0]["method"] == "raw_tee_time_no_score_ts"
    assert one(spark, S.estimate_start(clock(None), none_t, none_d))[0]["method"] == "missing_inputs"
    args = (date("2024-05-03"), ntz("2024-05-03 01:00:00"), ntz("2024-05-03 09:00:00"), date("2024-05-01"))
    methods = [one(spark, S.join_time(F.lit(raw), *args))[0]["method"] for raw in ("9:00", "", "unreadable")]
    assert methods == ["round_date_interp_plus_raw_tee", "fallback_score_based", "event_start_noon_fallback"]


def test_round_dates(spark):
    d = lambda x: F.lit(x).cast("date")
    got = [one(spark, S.round_date(d("2024-05-03"), d("2024-05-05"), F.lit(r), F.lit(4)))[0]["date"].day for r in (1, 2, 3, 4)]
    assert got == [3, 3, 4, 5]
    assert one(spark, S.round_date(d(None), d(None), F.lit(1), F.lit(4)))[0]["method"] == "missing_start_date"


def test_buckets_and_states(spark):
    assert values(spark, S.wind_bucket, [1.9, 2.0, 7.9, 11.9, 12.0, None], "double") == ["calm", "light", "moderate", "strong", "very_strong", "unknown"]
    assert values(spark, S.wind_sector, [0, 45, 134, 225, 315, 360, -10, None], "int") == ["N", "E", "E", "W", "N", "N", "N", None]
    assert values(spark, S.state_code, ["tx", "Texas", "new york", "XX", "", None]) == ["TX", "TX", "NY", None, None, None]
    assert values(spark, S.state_name, ["tx", "Ohio"]) == ["Texas", "Ohio"]
    assert values(spark, lambda c: S.cut(c, [0, 1, 2], ["a", "b"]), [0.0, 1.0, 1.5, 2.0, 3.0], "double") == [None, "a", "b", "b", None]


def test_player_keys(spark):
    df = spark.createDataFrame([("12", "5", "Ann"), ("0", "211819644", "Ann"), (None, None, " Ann "), (None, None, "ann")], "n string, r string, name string")
    keys = [r[0] for r in df.select(S.player_key("n", "r", F.lit(9), "name")).collect()]
    assert keys[:2] == ["PDGA#12", "RESULT#211819644"] and keys[2] == keys[3] and keys[2].startswith("NAMEHASH#")


def test_weather_join_takes_the_newest_and_keeps_rows(spark):
    wx = spark.createDataFrame([(1, 8, "2024-01-01", 3.0), (1, 8, "2024-01-02", 5.0), (1, 9, "2024-01-01", 7.0)], "tourn_id int, obs_hour int, fetched string, wind_speed_mps double")
    best = C.latest_by_struct(wx, ["tourn_id", "obs_hour"], ["fetched"])
    play = spark.createDataFrame([(1, 8, "a"), (1, 10, "b")], "tourn_id int, obs_hour int, player string")
    got = {r["player"]: (r["wind_speed_mps"], r["wx_missing"]) for r in C.enrich(play, best, measures=["wind_speed_mps"]).collect()}
    assert got == {"a": (5.0, False), "b": (None, True)}


def test_holes_to_rounds(spark):
    rows = [(2024, 1, 1, n, "p", "MPO", "TX", 7, 8, 950, score, par, length, wind, 2 * wind, 20.0, 1000.0, 50.0, precip, False) for n, score, par, length, wind, precip in ((1, 3, 3, 300.0, 5.0, 1), (2, 4, 3, 330.0, 6.0, 0))]
    schema = "event_year int, tourn_id int, round_number int, hole_number int, player_key string, division string, state string, course_id int, layout_id int, player_rating int, hole_score int, hole_par int, hole_length double, wind_speed_mps double, wind_gust_mps double, temperature_c double, pressure_hpa double, humidity_pct double, precip_mm int, wx_missing boolean"
    r = C.round_model_inputs(spark.createDataFrame(rows, schema)).first()
    assert (r["actual_round_strokes"], r["round_strokes_over_par"], r["hole_count"], r["round_total_hole_length"], r["round_length_over_par"]) == (7, 1, 2, 630.0, 105.0)
    assert (r["wind_mean"], r["wind_max"], r["precip_sum"], r["wind_bucket"], r["weather_available"]) == (5.5, 6.0, 1, "moderate", True)


def test_dedup_and_fingerprint_do_not_depend_on_order(spark):
    rows = [(1, "a", 3), (1, "b", 2), (2, "a", 1), (2, "a", 1)]
    results = set()
    for p in itertools.permutations(rows):
        df = spark.createDataFrame(list(p), "k int, v string, n int").coalesce(1)
        results.add((tuple(sorted(map(tuple, C.dedup_latest(df, ["k"], [F.col("n").desc(), F.col("v").desc()]).collect()))), tuple(sorted(map(tuple, C.event_fingerprint(df, "k", ["v", "n"], "v1").collect())))))
    assert len(results) == 1


def test_merge_state(spark):
    state = spark.createDataFrame([("a", "x", "p", 1, 1, 2), ("b", "y", "q", 1, 1, 0)], "key string, content string, pointer string, first_seen int, last_fetched int, failures long")
    batch = spark.createDataFrame([("a", "x2", "", 5, True), ("b", None, None, 5, False), ("c", "z", "r", 5, True), ("d", None, None, 5, False)], "key string, content string, pointer string, seen_at int, ok boolean")
    got = {r["key"]: tuple(r)[1:] for r in C.merge_state(state, batch).collect()}
    assert got == {"a": ("x2", "p", 1, 5, 0), "b": ("y", "q", 1, 1, 1), "c": ("z", "r", 5, 5, 0)}


def test_pending_rules(spark):
    events = spark.createDataFrame([(i,) for i in range(6)], "event_id int")
    state = spark.createDataFrame([(0, "success", "f"), (1, "success", " "), (2, "failed", "f"), (3, "dq_failed", "f"), (4, "odd", "f")], "event_id int, status string, fingerprint string")
    assert sorted(r[0] for r in C.pending(events, state).collect()) == [1, 2, 4, 5]
    assert sorted(r[0] for r in C.pending(events, state, False, True).collect()) == [1, 3, 4, 5]


def test_quality_rules_quarantine_whole_groups(spark):
    df = spark.createDataFrame([(1, 10.0, "a"), (1, 120.0, "b"), (2, 5.0, "c")], "g int, h double, k string")
    good, errors = Q.validate(df, "g", [Q.rule_range(df, "g", "h", 0, 100, "k"), Q.rule_not_blank(df, "g", ["k"], "k")])
    assert [r["k"] for r in good.collect()] == ["c"]
    assert [tuple(r) for r in errors.collect()] == [(1, "range(h)", 1, "b")]
    assert Q.missing_columns(df, ["g", "z"]) == ["z"]


def test_streak_cut_across_blocks(spark):
    for block in (3, 7, 1000):
        for found in ("1100001001", "1000000000", "1111111111", "0001", "1010000101"):
            df = spark.createDataFrame([(i + 5, c == "1") for i, c in enumerate(found)], "id long, found boolean")
            run, want = 0, []
            for i, c in enumerate(found):
                run = 0 if c == "1" else run + 1
                if run >= 3:
                    break
                want.append(i + 5)
            assert sorted(r["id"] for r in A.streak_cut(df, "id", "found", 3, block).collect()) == want


def test_small_sides_are_broadcast_and_filters_pushed(spark):
    plan = P.QUERIES["f06_distribution"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan
    plan = P.QUERIES["d04_eligible_events"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderstatus)" in plan and "o_totalprice" not in plan


@pytest.mark.parametrize("name", sorted(P.SQL))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    text = lambda v: "~" if v is None or v != v else f"{v:.9g}" if isinstance(v, float) else str(v)
    want = con.sql(P.SQL[name])
    got = P.QUERIES[name](spark, FOLDER)
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    at = [want.columns.index(c) for c in columns]
    assert sorted(tuple(text(r[c]) for c in columns) for r in got.collect()) == sorted(tuple(text(r[i]) for i in at) for r in want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
