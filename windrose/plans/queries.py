"""Registered queries over the sample tables, each beside its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import analysis as A
from ..operators import boosting as B
from ..operators import core as C
from ..operators import ingest as I
from ..operators import model as M
from ..operators import normalize as N
from ..operators import pages as G
from ..operators import quality as Q
from ..operators import ranked as K
from ..operators import reports as R
from ..operators import scenarios as X
from ..operators import selection as P
from ..operators import shared as Z
from ..sources import files as L
from ..sources import staged as Y
from ..streaming import incremental as W
from .adapter import CTE, HOLE_KEYS, Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
ROUND_KEYS = ["tourn_id", "round_number", "player_key"]


def _rounded_exactly(sql: str) -> str:
    """Each round(x, n) on a decimal, as the operators do it."""
    at = sql.rfind("round(")
    while at >= 0:
        if at == 0 or not (sql[at - 1].isalnum() or sql[at - 1] == "_"):
            depth, end, comma = 0, at + 5, None
            while True:
                depth += {"(": 1, "[": 1, ")": -1, "]": -1}.get(sql[end], 0)
                if sql[end] == "," and depth == 1:
                    comma = end
                if depth == 0:
                    break
                end += 1
            x, n = sql[at + 6 : comma], sql[comma + 1 : end].strip()
            sql = f"{sql[:at]}cast(ROUND(cast({x} AS decimal(28,8)), {n}) AS double){sql[end + 1 :]}"
        at = sql.rfind("round(", 0, at)
    return sql


def query(sql: str | None = None, cte: bool = True):
    """Registers a function of Tables under its name, with SQL that may use the adapter's common tables."""

    def register(f):
        name = f.__name__
        QUERIES[name] = lambda spark, folder: f(Tables(spark, folder))
        if sql:
            SQL[name] = (CTE if cte else "") + _rounded_exactly(sql)
        return f

    return register


def m4(c: str, alias: str) -> str:
    return f"round(avg(cast({c} AS decimal(18,6))), 4) AS {alias}"


def r4(*columns: str) -> list:
    return [S.rounded(c).alias(c) for c in columns]


def s4(*columns: str) -> str:
    return ", ".join(f"round({c}, 4) AS {c}" for c in columns)


# --- dedup, joins, features, holes to rounds


@query("SELECT tourn_id, round_number, hole_number, player_key, hole_score, hole_par, hole_length, obs_hour, src FROM holes")
def g01_dedup_latest(t):
    return t.holes.select(*HOLE_KEYS, "hole_score", "hole_par", "hole_length", "obs_hour", "src")


@query("SELECT tourn_id, obs_hour, event_id, round(wind_speed_mps, 4) AS wind_speed_mps FROM wx")
def g02_best_weather(t):
    return t.wx.select("tourn_id", "obs_hour", "event_id", *r4("wind_speed_mps"))


@query("SELECT tourn_id, round_number, hole_number, player_key, round(wind_speed_mps, 4) AS wind_speed_mps, temperature_c, wx_missing FROM enriched")
def e02_enrich_holes(t):
    return t.enriched.select(*HOLE_KEYS, *r4("wind_speed_mps"), "temperature_c", "wx_missing")


@query(
    """, r AS (SELECT tourn_id, round_number, player_key, min(obs_hour) AS obs_hour, count(*) AS n_holes FROM holes GROUP BY ALL)
SELECT r.*, round(wind_speed_mps, 4) AS wind_speed_mps, precip_mm, wx.tourn_id IS NULL AS wx_missing
FROM r LEFT JOIN wx ON r.tourn_id = wx.tourn_id AND r.obs_hour = wx.obs_hour"""
)
def e01_enrich_rounds(t):
    rounds = t.holes.groupBy(*ROUND_KEYS).agg(F.min("obs_hour").alias("obs_hour"), F.count("*").alias("n_holes"))
    return C.enrich(rounds, t.wx).select(*ROUND_KEYS, "obs_hour", "n_holes", *r4("wind_speed_mps"), "precip_mm", "wx_missing")


@query(
    """SELECT tourn_id, round_number, hole_number, player_key, 'hole' AS feature_grain, NOT wx_missing AS weather_available,
  CASE WHEN wind_speed_mps IS NULL THEN 'unknown' WHEN wind_speed_mps < 2 THEN 'calm' WHEN wind_speed_mps < 5 THEN 'light' WHEN wind_speed_mps < 8 THEN 'moderate' WHEN wind_speed_mps < 12 THEN 'strong' ELSE 'very_strong' END AS wind_bucket,
  CASE WHEN wind_gust_mps IS NULL THEN 'unknown' WHEN wind_gust_mps < 3 THEN 'low' WHEN wind_gust_mps < 6 THEN 'mild' WHEN wind_gust_mps < 10 THEN 'high' ELSE 'very_high' END AS gust_bucket,
  CASE WHEN wind_dir_deg IS NULL THEN NULL WHEN wind_dir_deg >= 315 OR wind_dir_deg < 45 THEN 'N' WHEN wind_dir_deg < 135 THEN 'E' WHEN wind_dir_deg < 225 THEN 'S' ELSE 'W' END AS wind_sector,
  hole_score - hole_par AS strokes_over_par FROM enriched"""
)
def l04_hole_features(t):
    """Also B17 to B19, B29 and B30."""
    return C.build_features(t.enriched, "hole").select(*HOLE_KEYS, "feature_grain", "weather_available", "wind_bucket", "gust_bucket", "wind_sector", "strokes_over_par")


_F01 = ["wind_mean", "wind_max", "gust_mean", "gust_max", "temp_mean", "pressure_mean", "humidity_mean", "precip_mean"]


@query(
    f"""SELECT event_year, tourn_id, round_number, player_key, division, state, course_id, layout_id, player_rating, actual_round_strokes,
  round_strokes_over_par, hole_count, round_total_hole_length, round_total_par, precip_sum, weather_available, {s4(*_F01)},
  round(round_total_hole_length / hole_count, 4) AS round_avg_hole_length, round(round_total_par / hole_count, 4) AS round_avg_hole_par,
  round(round_total_hole_length / nullif(round_total_par, 0), 4) AS round_length_over_par FROM rounds"""
)
def f01_round_model_inputs(t):
    exact = ["event_year", *ROUND_KEYS, "division", "state", "course_id", "layout_id", "player_rating", "actual_round_strokes", "round_strokes_over_par", "hole_count", "round_total_hole_length", "round_total_par", "precip_sum", "weather_available"]
    return t.rounds.select(*exact, *r4(*_F01, "round_avg_hole_length", "round_avg_hole_par", "round_length_over_par"))


_VALID = "hole_score BETWEEN 1 AND 15 AND hole_par BETWEEN 2 AND 6 AND hole_length BETWEEN 200 AND 600 AND player_rating BETWEEN 820 AND 1000"


@query(
    f""", v AS (SELECT * FROM enriched WHERE {_VALID})
SELECT tourn_id, round_number, player_key, min(division) AS division, cast(sum(hole_score) AS bigint) AS strokes, {m4('hole_length', 'mean_length')},
  round(max(wind_speed_mps), 4) AS wind_max, cast(sum(hole_score) - sum(hole_par) AS bigint) AS over_par,
  round(sum(hole_length) / nullif(sum(hole_par), 0), 4) AS length_per_par, round(round(avg(cast(wind_speed_mps AS decimal(18,6))), 4) * sum(hole_length), 2) AS wind_x_length
FROM v GROUP BY tourn_id, round_number, player_key"""
)
def f02_round_level_dataset(t):
    """With the validity ranges of D03."""
    v = t.enriched.where("hole_score between 1 and 15 and hole_par between 2 and 6 and hole_length between 200 and 600 and player_rating between 820 and 1000")
    return v.groupBy(*ROUND_KEYS).agg(
        F.min("division").alias("division"), F.sum("hole_score").cast("bigint").alias("strokes"), R.mean4("hole_length").alias("mean_length"),
        S.rounded(F.max("wind_speed_mps"), 4).alias("wind_max"), (F.sum("hole_score") - F.sum("hole_par")).cast("bigint").alias("over_par"),
        S.rounded(F.sum("hole_length") / F.nullif(F.sum("hole_par"), F.lit(0)), 4).alias("length_per_par"),
        S.rounded(S.rounded(C.dmean("wind_speed_mps")) * F.sum("hole_length"), 2).alias("wind_x_length"),
    )


# --- reports

_BASE = ["tourn_id", "round_number", "player_key", "division", "state", "round_month", "round_month_label", "rating_band", "temperature_band_f", "precip_flag", "round_wind_speed_bucket"]
_BASE4 = ["observed_wind_mph", "observed_wind_gust_mph", "observed_temp_f", "wind_impact", "temperature_impact", "total_impact", "predicted_total_reference"]


@query(f"SELECT {', '.join(_BASE)}, {s4(*_BASE4)} FROM base")
def f03_reporting_base(t):
    """Also B22 to B27."""
    return t.base.select(*_BASE, *r4(*_BASE4))


@query(
    f"""SELECT cast(0 AS double) AS reference_wind_mph, cast(1 AS double) AS reference_gust_mph, cast(80 AS double) AS reference_temp_f, 'No Precipitation' AS reference_precipitation,
  count(*) AS rounds_tracked, count(DISTINCT tourn_id) AS events_tracked, {m4('total_impact', 'avg_added_strokes_weather')}, {m4('wind_impact', 'avg_added_strokes_wind')},
  {m4('observed_wind_mph', 'avg_observed_wind_mph')}, {m4('observed_wind_gust_mph', 'avg_observed_wind_gust_mph')}, {m4('observed_temp_f', 'avg_observed_temp_f')} FROM base"""
)
def f04_overview(t):
    return R.overview(t.base)


def _report(keys: list[str], means: dict[str, str], events: bool = False, players: bool = False, name: str = "") -> None:
    parts = [*keys, "count(*) AS rounds_scored"]
    if events:
        parts.append("count(DISTINCT tourn_id) AS events_scored")
    if players:
        parts.append("count(DISTINCT player_key) AS players_scored")
    parts += [m4(c, n) for n, c in means.items()]
    f = lambda t: R.report(t.base, keys, means, events, players)
    f.__name__ = name
    query(f"SELECT {', '.join(parts)} FROM base GROUP BY {', '.join(keys)}")(f)


_report(["round_wind_speed_bucket"], R.WEATHER | R.GUST | {k: v for k, v in R.EFFECTS.items() if "temperature" not in k}, events=True, name="f05_by_wind_bucket")
_report(["event_year", "tourn_id", "state"], R.WEATHER | R.EFFECTS, players=True, name="f08_by_event_geo")
_report(["round_month", "round_month_label", "state"], R.WEATHER | R.EFFECTS, events=True, players=True, name="f09_by_state")
_report(["division"], R.WEATHER | R.EFFECTS, events=True, name="f10_by_division")
_report(["rating_band"], R.WEATHER | R.EFFECTS, events=True, name="f11_by_rating_band")
_report(["course_id", "layout_id", "state"], R.WEATHER | R.EFFECTS, events=True, name="f12_by_course_layout")
_report(["event_year", "tourn_id"], R.WEATHER | R.GUST | R.STROKES | R.EFFECTS, players=True, name="f13_by_event")
_report(["event_year", "tourn_id", "round_number", "division"], R.WEATHER | R.GUST | R.STROKES | R.EFFECTS, players=True, name="f14_by_event_round")
_report(["temperature_band_f"], R.WEATHER | R.EFFECTS, events=True, name="f15_by_temperature_band")
_report(["event_year", "round_month", "round_month_label"], R.WEATHER | R.EFFECTS, events=True, players=True, name="f16_by_month")


def _bins_sql() -> str:
    lit = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return ", ".join(f"({', '.join(lit(x) for x in b)})" for b in R.distribution_bins())


@query(
    f""", bins AS (SELECT metric_name, metric_label, bin_label, cast(bin_start AS double) AS bin_start, cast(bin_end AS double) AS bin_end, category, sort_order
  FROM (VALUES {_bins_sql()}) AS t (metric_name, metric_label, bin_label, bin_start, bin_end, category, sort_order)),
v AS ({' UNION ALL '.join(f"SELECT '{m}' AS metric_name, {c} AS x, NULL AS c FROM base" for m, c in R.METRICS.items())}
  UNION ALL SELECT 'observed_precipitation', NULL, precip_flag FROM base),
n AS (SELECT b.*, count(v.metric_name) AS rounds_tracked FROM bins b LEFT JOIN v ON b.metric_name = v.metric_name AND
  CASE WHEN b.category IS NOT NULL THEN v.c = b.category ELSE v.x IS NOT NULL AND (bin_start IS NULL OR x >= bin_start) AND (bin_end IS NULL OR x < bin_end) END
  GROUP BY ALL)
SELECT metric_name, metric_label, bin_label, bin_start, bin_end, sort_order, rounds_tracked,
  round(rounds_tracked / nullif(sum(rounds_tracked) OVER (PARTITION BY metric_name), 0), 6) AS share_of_rounds FROM n"""
)
def f06_distribution(t):
    """Also E09, G04 and I01."""
    return R.distribution(t.base)


@query(
    f""", p AS (SELECT 'wind_speed' AS bucket_metric, CASE WHEN observed_wind_mph < 3 THEN 0 WHEN observed_wind_mph < 6 THEN 1 WHEN observed_wind_mph < 9 THEN 2 WHEN observed_wind_mph < 12 THEN 3 WHEN observed_wind_mph < 15 THEN 4 ELSE 5 END AS sort_order, wind_impact FROM base
  UNION ALL SELECT 'wind_gust', CASE WHEN observed_wind_gust_mph < 5 THEN 100 WHEN observed_wind_gust_mph < 10 THEN 101 WHEN observed_wind_gust_mph < 15 THEN 102 WHEN observed_wind_gust_mph < 20 THEN 103 WHEN observed_wind_gust_mph < 25 THEN 104 ELSE 105 END, wind_impact FROM base)
SELECT bucket_metric, sort_order, list_extract(CASE WHEN bucket_metric = 'wind_speed' THEN ['0-3 mph', '3-6 mph', '6-9 mph', '9-12 mph', '12-15 mph', '15+ mph'] ELSE ['0-5 mph', '5-10 mph', '10-15 mph', '15-20 mph', '20-25 mph', '25+ mph'] END, sort_order % 100 + 1) AS bucket_label,
  count(*) AS rounds_tracked, {m4('wind_impact', 'avg_added_strokes_from_wind')} FROM p GROUP BY bucket_metric, sort_order"""
)
def f07_wind_points(t):
    return R.wind_points(t.base)


@query(f"SELECT division, count(*) AS rounds, {m4('total_impact', 'avg_total_impact')}, {m4('wind_impact', 'avg_wind_impact')}, count(DISTINCT player_key) AS players, true AS estimate_is_near FROM base GROUP BY division")
def f17_rollup(t):
    """Means from partial sums. The estimate of players, from sketches, is held against their exact number: 5 % and 2 players."""
    parts = R.partial_rollup(t.base, ["tourn_id", "division"], ["total_impact", "wind_impact"])
    exact = t.base.groupBy("division").agg(F.countDistinct("player_key").alias("players"))
    rolled = R.final_rollup(parts, ["division"], ["total_impact", "wind_impact"]).join(exact, "division")
    return rolled.withColumn("estimate_is_near", F.abs(F.col("players_estimate") - F.col("players")) <= 0.05 * F.col("players") + 2).drop("players_estimate")


_STATE = f"SELECT round_month, state, count(*) AS rounds_scored, count(DISTINCT tourn_id) AS events_scored, {m4('total_impact', 'avg_total')}, {m4('observed_wind_mph', 'avg_wind')} FROM base GROUP BY round_month, state"


@query(
    f""", g AS ({_STATE}) SELECT state, cast(sum(rounds_scored) AS bigint) AS rounds_scored, cast(sum(events_scored) AS bigint) AS events_scored,
  round(sum(cast(avg_total AS decimal(18,6)) * rounds_scored) / sum(rounds_scored), 4) AS avg_total,
  round(sum(cast(avg_wind AS decimal(18,6)) * rounds_scored) / sum(rounds_scored), 4) AS avg_wind FROM g GROUP BY state"""
)
def f33_state_rollup(t):
    g = R.report(t.base, ["round_month", "state"], {"avg_total": "total_impact", "avg_wind": "observed_wind_mph"}, events=True)
    return R.weighted_rollup(g, ["state"], ["rounds_scored", "events_scored"], ["avg_total", "avg_wind"])


@query(
    f""", g AS (SELECT tourn_id, round_number, division, count(*) AS rounds_scored, {m4('total_impact', 'avg_total')} FROM base GROUP BY ALL)
SELECT tourn_id, round_number, cast(sum(rounds_scored) AS bigint) AS rounds_scored, round(sum(cast(avg_total AS decimal(18,6)) * rounds_scored) / sum(rounds_scored), 4) AS avg_total FROM g GROUP BY tourn_id, round_number"""
)
def f34_event_round_rollup(t):
    g = R.report(t.base, ["tourn_id", "round_number", "division"], {"avg_total": "total_impact"})
    return R.weighted_rollup(g, ["tourn_id", "round_number"], ["rounds_scored"], ["avg_total"])


@query("SELECT tourn_id, round_number, player_key, division FROM base WHERE event_year IN (2020, 2022) AND division IN ('BUILDING', 'MACHINERY') AND hole_count >= 2")
def d08_filters(t):
    return R.apply_filters(t.base, {"event_year": [2020, 2022], "division": ["BUILDING", "MACHINERY"], "state": []}, {"hole_count": 2}).select(*ROUND_KEYS, "division")


# --- scalars over the tables


@query(
    """SELECT event_id, CASE WHEN regexp_matches(trim(k), '^[+-]?[0-9]+$') THEN try_cast(trim(k) AS bigint) END AS k_int,
  try_cast(nullif(trim(k), '') AS double) AS k_double, CASE WHEN lower(trim(t)) IN ('1', 'true', 'yes', 'y') THEN true WHEN lower(trim(t)) IN ('0', 'false', 'no', 'n') THEN false END AS flag,
  trim(regexp_replace(concat('  ', event_type, '   x '), '\\s+', ' ', 'g')) AS collapsed, cast(trunc(value) AS bigint) AS whole
FROM (SELECT *, json_extract_string(props, '$.k') AS k, list_extract(['1', 'No', 'y', 'maybe'], event_id % 4 + 1) AS t FROM events)""",
    cte=False,
)
def b01_b04_casts(t):
    e = t.table("events").withColumns({"k": F.get_json_object("props", "$.k"), "t": F.element_at(F.array(*(F.lit(x) for x in ("1", "No", "y", "maybe"))), (F.col("event_id") % 4 + 1).cast("int"))})
    return e.select(
        "event_id", S.to_int("k").alias("k_int"), S.to_double("k").alias("k_double"), S.to_bool("t").alias("flag"),
        S.collapse_spaces(F.concat(F.lit("  "), "event_type", F.lit("   x "))).alias("collapsed"), S.to_int_truncated("value").alias("whole"),
    )


@query(
    """SELECT o_orderkey, cast(cast(o_orderdate AS date) AS varchar) AS d, cast(date_trunc('hour', o_orderdate) AS varchar) AS hour, cast(cast(cast(o_orderdate AS date) AS timestamp) + INTERVAL 12 HOUR AS varchar) AS noon,
  cast(extract(year FROM o_orderdate) AS bigint) AS year FROM orders""",
    cte=False,
)
def b07_b11_dates(t):
    o = t.table("orders").withColumn("text", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    d = S.parse_date("text")
    return o.select("o_orderkey", d.cast("string").alias("d"), F.date_trunc("hour", S.parse_ts("text")).cast("timestamp_ntz").cast("string").alias("hour"), S.noon(d).cast("string").alias("noon"), F.substring("text", 1, 4).try_cast("bigint").alias("year"))


@query(
    """SELECT event_id, CASE WHEN mph IS NULL THEN 'unknown' WHEN mph < 3 THEN '0-3' WHEN mph < 6 THEN '3-6' WHEN mph < 9 THEN '6-9' WHEN mph < 12 THEN '9-12' WHEN mph < 15 THEN '12-15' ELSE '15+' END AS mph_bucket,
  CASE WHEN f IS NULL THEN 'unknown' WHEN f < 30 THEN '<30' WHEN f < 40 THEN '30-40' WHEN f < 50 THEN '40-50' WHEN f < 60 THEN '50-60' WHEN f < 70 THEN '60-70' WHEN f < 80 THEN '70-80' ELSE '80+' END AS f_bucket,
  CASE WHEN c > -5 AND c <= 10 THEN 'cold' WHEN c > 10 AND c <= 25 THEN 'mild' WHEN c > 25 AND c <= 38 THEN 'hot' END AS right_closed,
  CASE WHEN c >= -5 AND c < 10 THEN 'cold' WHEN c >= 10 AND c < 25 THEN 'mild' WHEN c >= 25 AND c < 38 THEN 'hot' END AS left_closed
FROM (SELECT event_id, value / 10 * cast(2.23694 AS double) AS mph, event_id % 45 - 5 AS c, (event_id % 45 - 5) * 9.0 / 5.0 + 32.0 AS f FROM events)""",
    cte=False,
)
def b20_b21_buckets(t):
    e = t.table("events").withColumns({"mph": S.mps_to_mph(F.col("value") / 10), "c": F.col("event_id") % 45 - 5})
    edges, labels = [-5, 10, 25, 38], ["cold", "mild", "hot"]
    return e.select(
        "event_id", S.mph_bucket("mph").alias("mph_bucket"), S.f_bucket(S.c_to_f("c")).alias("f_bucket"),
        S.cut("c", edges, labels).alias("right_closed"), S.cut("c", edges, labels, right=False).alias("left_closed"),
    )


_EV = """(SELECT tourn_id, cast('2024-01-01' AS date) + cast(tourn_id AS int) AS start_date, CASE WHEN tourn_id % 9 = 0 THEN NULL ELSE cast('2024-01-01' AS date) + cast(tourn_id + tourn_id % 5 AS int) END AS end_date, round_number FROM (SELECT DISTINCT tourn_id, round_number FROM holes))"""


def _event_rounds(t):
    return t.holes.select("tourn_id", "round_number").distinct().select(
        "tourn_id", "round_number", F.date_add(F.lit("2024-01-01").cast("date"), F.col("tourn_id").cast("int")).alias("start_date"),
        F.when(F.col("tourn_id") % 9 != 0, F.date_add(F.lit("2024-01-01").cast("date"), (F.col("tourn_id") + F.col("tourn_id") % 5).cast("int"))).alias("end_date"),
    )


@query(
    f"""SELECT tourn_id, round_number, cast(CASE WHEN end_date IS NULL OR end_date <= start_date THEN start_date ELSE cast(start_date + cast((round_number - 1) * (end_date - start_date) // 3 AS int) AS date) END AS varchar) AS date,
  CASE WHEN end_date IS NULL THEN 'event_start_fallback_no_end_date' WHEN end_date <= start_date THEN 'event_start_single_day' ELSE 'event_span_linear' END AS method,
  cast(CASE WHEN end_date IS NULL THEN 0.5 WHEN end_date <= start_date THEN 1.0 ELSE 0.7 END AS double) AS confidence FROM {_EV}"""
)
def b31_round_date(t):
    return _event_rounds(t).select("tourn_id", "round_number", S.round_date(F.col("start_date"), F.col("end_date"), F.col("round_number"), F.lit(4)).alias("x")).select("tourn_id", "round_number", F.col("x.date").cast("string").alias("date"), "x.method", "x.confidence")


@query(
    f"""SELECT tourn_id, round_number, cast(CASE WHEN end_date IS NULL THEN start_date + cast(round_number - 1 AS int) ELSE start_date + cast(least(round_number - 1, greatest(end_date - start_date, 0)) AS int) END AS date)::varchar AS date,
  cast(CASE WHEN end_date IS NULL THEN start_date + cast(round_number - 1 AS int) ELSE start_date + cast(least(round_number - 1, greatest(end_date - start_date, 0)) AS int) END - 2 AS date)::varchar AS from_date,
  cast(CASE WHEN end_date IS NULL THEN start_date + cast(round_number - 1 AS int) ELSE start_date + cast(least(round_number - 1, greatest(end_date - start_date, 0)) AS int) END + 2 AS date)::varchar AS to_date FROM {_EV}"""
)
def b36_b37_inferred_dates(t):
    d = S.inferred_round_date(F.lit(None).cast("date"), F.col("start_date"), F.col("end_date"), F.col("round_number"), F.lit(4))
    return _event_rounds(t).select("tourn_id", "round_number", d.cast("string").alias("date"), F.date_sub(d, 2).cast("string").alias("from_date"), F.date_add(d, 2).cast("string").alias("to_date"))


@query(
    """SELECT o_orderkey, cast(CASE WHEN o_orderkey % 3 = 0 THEN d + INTERVAL 9 HOUR + INTERVAL 30 MINUTE ELSE d + INTERVAL 12 HOUR END AS varchar) AS ts,
  CASE WHEN o_orderkey % 3 = 0 THEN 'round_date_interp_plus_raw_tee' WHEN o_orderkey % 3 = 1 THEN 'round_date_interp_noon_fallback' ELSE 'event_start_noon_fallback' END AS method
FROM (SELECT o_orderkey, date_trunc('day', o_orderdate) AS d FROM orders)""",
    cte=False,
)
def b33_join_time(t):
    o = t.table("orders").withColumns({"d": F.col("o_orderdate").cast("date"), "raw": F.when(F.col("o_orderkey") % 3 == 0, "9:30 AM").when(F.col("o_orderkey") % 3 == 1, "").otherwise("soon")})
    none = F.lit(None).cast("timestamp_ntz")
    return o.select("o_orderkey", S.join_time(F.col("raw"), F.col("d"), none, none, F.col("d")).alias("x")).select("o_orderkey", F.col("x.ts").cast("string").alias("ts"), "x.method")


@query(
    """SELECT tourn_id, round_number, player_key, hole_number, row_number() OVER w AS hole_index, (row_number() OVER w - 1) * (14400 // count(*) OVER p) AS start_second,
  CASE WHEN row_number() OVER w = count(*) OVER p THEN 14400 ELSE row_number() OVER w * (14400 // count(*) OVER p) END AS end_second
FROM holes WINDOW w AS (PARTITION BY tourn_id, round_number, player_key ORDER BY hole_number), p AS (PARTITION BY tourn_id, round_number, player_key)"""
)
def b34_hole_times(t):
    """Also G09."""
    from pyspark.sql import Window

    p = Window.partitionBy(*ROUND_KEYS)
    at, n = F.row_number().over(p.orderBy("hole_number")), F.count("*").over(p)
    step = F.floor(F.lit(60 * S.ROUND_MINUTES) / n)
    return t.holes.select(*ROUND_KEYS, "hole_number", at.cast("bigint").alias("hole_index"), ((at - 1) * step).alias("start_second"), F.when(at == n, 60 * S.ROUND_MINUTES).otherwise(at * step).cast("bigint").alias("end_second"))


@query(
    """SELECT o_orderkey, sha256(concat(cast(o_orderkey AS varchar), '|', o_orderstatus, '|', o_orderpriority)) AS obs_pk,
  CASE WHEN o_custkey % 3 = 0 AND o_custkey > 0 THEN concat('PDGA#', o_custkey) WHEN o_custkey % 3 = 1 THEN concat('RESULT#', o_orderkey + 1) ELSE concat('NAMEHASH#', sha256(concat(cast(o_orderkey AS varchar), '|', lower(o_orderpriority)))) END AS player_key,
  format('GRID#{:.4f}_{:.4f}', o_orderkey % 90 + 0.25, -(o_custkey % 180) - 0.5) AS source_id FROM orders""",
    cte=False,
)
def b15_b16_keys(t):
    """Also B38's source id."""
    o = t.table("orders")
    number = F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey").cast("string"))
    result = F.when(F.col("o_custkey") % 3 == 1, (F.col("o_orderkey") + 1).cast("string"))
    return o.select(
        "o_orderkey", S.key_hash("o_orderkey", "o_orderstatus", "o_orderpriority").alias("obs_pk"), S.player_key(number, result, "o_orderkey", "o_orderpriority").alias("player_key"),
        S.grid_source_id(F.col("o_orderkey") % 90 + 0.25, -(F.col("o_custkey") % 180) - 0.5).alias("source_id"),
    )


@query(
    """, g AS (SELECT avg(cast(player_rating AS decimal(18,6))) AS mean_rating, median(round_total_hole_length) AS mid_length FROM rounds)
SELECT tourn_id, round_number, player_key, round(round(wind_mean, 4) * round_total_hole_length, 2) AS wind_x_length, round(round(gust_mean, 4) * round_total_hole_length, 2) AS gust_x_length, round(round(wind_mean, 4) * player_rating, 2) AS wind_x_rating,
  player_rating * player_rating AS rating_squared, round(player_rating - mean_rating, 4) AS rating_centred, round_total_hole_length > mid_length AS long_course, round(ln(1 + greatest(precip_sum, 0)), 4) AS log_precip FROM rounds, g"""
)
def b52_engineered_features(t):
    made = ["wind_x_length", "gust_x_length", "wind_x_rating", "rating_squared", "rating_centred", "long_course", "log_precip"]
    rounds = t.rounds.select(*ROUND_KEYS, "wind_mean", "gust_mean", "round_total_hole_length", "player_rating", "precip_sum")
    return P.engineered(rounds).select(*ROUND_KEYS, *made)


@query(
    """SELECT c_custkey, CASE WHEN c_mktsegment IN (SELECT DISTINCT c_mktsegment FROM customer WHERE c_custkey % 50 = 1) THEN c_mktsegment ELSE '__MISSING__' END AS segment, cast(c_nationkey AS varchar) AS nation_text FROM customer""",
    cte=False,
)
def b53_b54_categories(t):
    c = t.table("customer")
    known = P.known_categories(c, c.where("c_custkey % 50 = 1"), "c_mktsegment", "segment")
    return known.select("c_custkey", "segment", F.col("c_nationkey").cast("string").alias("nation_text"))


# --- scans, states and dates of the incremental run


@query("SELECT tourn_id, round_number, hole_number, player_key, hole_score FROM holes WHERE tourn_id IN (3, 5, 11)")
def a06_event_scan(t):
    """Holes are written by event, and three events are read back: other events' folders are not opened. Also A08 and A10."""
    path = Z.shared_folder(t.spark, "a06")
    L.write_partitions(t.holes.select("event_year", *HOLE_KEYS, "hole_score"), path)
    return L.read_events(t.spark, path, [3, 5, 11]).select(F.col("tourn_id").cast("bigint").alias("tourn_id"), "round_number", "hole_number", "player_key", "hole_score")


@query(
    """SELECT event_year % 100 AS year, count(*) AS holes, cast(sum(hole_score) AS bigint) AS strokes FROM holes WHERE tourn_id % 3 <> 1 GROUP BY 1
UNION ALL SELECT event_year % 100, count(*), cast(sum(hole_score + 1) AS bigint) FROM holes WHERE tourn_id % 3 = 1 GROUP BY 1"""
)
def a10_staged_publish(t):
    """Holes are published by event, then a third of the events again with other scores; the last version is read."""
    table = Y.Table(t.spark, Z.shared_folder(t.spark, "a10"), ["event_year", "tourn_id"])
    holes = t.holes.select("event_year", *HOLE_KEYS, "hole_score")
    table.publish(holes)
    table.publish(holes.where("tourn_id % 3 = 1").withColumn("hole_score", F.col("hole_score") + 1))
    now = table.read().withColumn("again", F.col("tourn_id") % 3 == 1)
    return now.groupBy((F.col("event_year") % 100).cast("bigint").alias("year"), "again").agg(F.count("*").alias("holes"), F.sum("hole_score").cast("bigint").alias("strokes")).drop("again")


@query(
    """WITH s AS (SELECT c_custkey AS k, 'c' || c_custkey % 5 AS content, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'p' END AS pointer, date '2024-01-01' AS first_seen, date '2024-01-02' AS last_fetched, c_custkey % 3 AS failures FROM customer WHERE c_custkey % 3 <> 0),
b AS (SELECT c_custkey AS k, 'n' || c_custkey % 2 AS content, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE 'q' END AS pointer, c_custkey % 5 <> 0 AS ok FROM customer WHERE c_custkey % 2 = 0)
SELECT k AS key, CASE WHEN ok THEN b.content ELSE s.content END AS content, CASE WHEN ok AND b.pointer <> '' THEN b.pointer ELSE s.pointer END AS pointer,
  cast(coalesce(s.first_seen, CASE WHEN ok THEN date '2024-02-01' END) AS varchar) AS first_seen, cast(CASE WHEN ok THEN date '2024-02-01' ELSE s.last_fetched END AS varchar) AS last_fetched,
  CASE WHEN ok THEN 0 WHEN b.k IS NOT NULL THEN coalesce(s.failures, 0) + 1 ELSE s.failures END AS failures
FROM s FULL JOIN b USING (k) WHERE s.k IS NOT NULL OR ok""",
    cte=False,
)
def a21_merge_state(t):
    """Customers as known pages, and a batch of fetches, some failed."""
    k, c = F.col("c_custkey"), t.table("customer")
    day = lambda x: F.lit(x).cast("date")
    state = c.where("c_custkey % 3 != 0").select(
        k.alias("key"), F.concat(F.lit("c"), (k % 5).cast("string")).alias("content"), F.when(k % 4 == 0, "").otherwise("p").alias("pointer"), day("2024-01-01").alias("first_seen"), day("2024-01-02").alias("last_fetched"), (k % 3).alias("failures")
    )
    batch = c.where("c_custkey % 2 = 0").select(k.alias("key"), F.concat(F.lit("n"), (k % 2).cast("string")).alias("content"), F.when(k % 7 == 0, "").otherwise("q").alias("pointer"), day("2024-02-01").alias("seen_at"), (k % 5 != 0).alias("ok"))
    return C.merge_state(state, batch).withColumns({c: F.col(c).cast("string") for c in ("first_seen", "last_fetched")})


@query(
    """SELECT event_id, cast(date_trunc('hour', coalesce(CASE WHEN event_id % 3 = 0 THEN ts END, CASE WHEN event_id % 5 = 0 THEN ts + INTERVAL 2 HOUR END, CASE WHEN event_id % 7 <> 0 THEN cast(cast(ts AS date) AS timestamp) + INTERVAL 12 HOUR END)) AS varchar) AS hour FROM events""",
    cte=False,
)
def b12_hour_cascade(t):
    """Hour of the hole's time, else of the start, else noon of the day."""
    i, ts = F.col("event_id"), F.col("ts").cast("timestamp_ntz")
    d = t.table("events").select(i, F.when(i % 3 == 0, ts).alias("hole_time"), F.when(i % 5 == 0, ts + F.expr("interval 2 hours")).alias("start_time"), F.when(i % 7 != 0, F.date_format(ts, "yyyy-MM-dd")).alias("day"))
    return d.select("event_id", C.resolve_obs_hour(d.columns, ["hole_time", "start_time"], "day").cast("string").alias("hour"))


@query(
    """SELECT o_orderkey, cast(try_strptime(x, '%Y-%m-%d')::date AS varchar) AS round_dt, year(try_strptime(x, '%Y-%m-%d')) AS round_year, month(try_strptime(x, '%Y-%m-%d')) AS round_month,
  CASE WHEN o_orderkey % 4 = 0 THEN year(o_orderdate) WHEN o_orderkey % 4 = 2 THEN year(o_orderdate) WHEN o_orderkey % 2 = 1 AND o_orderkey % 3 = 0 THEN 2001 END AS event_year
FROM (SELECT *, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'soon' WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d 08:00') END AS x FROM orders)""",
    cte=False,
)
def b28_b35_dates(t):
    """Dates that are just dates, and the year of an event: of its end, else of its start."""
    k = F.col("o_orderkey")
    text = F.when(k % 4 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 4 == 1, "soon").when(k % 4 == 2, F.date_format("o_orderdate", "yyyy-MM-dd' 08:00'"))
    d = t.table("orders").select(k, text.alias("x"), F.when(k % 3 == 0, "2001-02-03").otherwise("").alias("start"))
    day = S.round_dt("x")
    return d.select("o_orderkey", day.cast("string").alias("round_dt"), F.year(day).cast("bigint").alias("round_year"), F.month(day).cast("bigint").alias("round_month"), S.event_year("x", "start").cast("bigint").alias("event_year"))


@query("SELECT event_id, try_cast(nullif(trim(x), '') AS double) AS x, try_cast(nullif(trim(y), '') AS double) AS y FROM (SELECT event_id, list_extract([' 1.5 ', 'bad', '', '-2e3'], event_id % 4 + 1) AS x, CASE WHEN event_id % 3 = 0 THEN event_type ELSE cast(user_id AS varchar) END AS y FROM events)", cte=False)
def b51_coerce_numeric(t):
    i = F.col("event_id")
    d = t.table("events").select(i, F.element_at(F.array(*(F.lit(v) for v in (" 1.5 ", "bad", "", "-2e3"))), (i % 4 + 1).cast("int")).alias("x"), F.when(i % 3 == 0, F.col("event_type")).otherwise(F.col("user_id").cast("string")).alias("y"))
    return P.coerce_numeric(d, ["x", "y"])


# --- filters


@query("SELECT count(*) AS rows, count(*) FILTER (weather_available) AS with_weather, count(*) FILTER (weather_available AND hole_count >= 3) AS enough_holes, count(*) FILTER (weather_available AND hole_count >= 3 AND wind_mean IS NOT NULL AND temp_mean IS NOT NULL AND precip_sum IS NOT NULL) AS kept FROM rounds")
def d01_training_filter(t):
    """Counts after each step, in one pass."""
    return P.steps(t.rounds, P.training_conditions(["wind_mean", "temp_mean", "precip_sum"], 3))


@query("SELECT tourn_id, round_number, player_key, hole_count FROM rounds WHERE weather_available AND hole_count >= 3 AND wind_mean IS NOT NULL AND player_rating IS NOT NULL")
def d02_scoring_filter(t):
    return P.usable_rounds(t.rounds, ["wind_mean", "player_rating"], 3).select(*ROUND_KEYS, "hole_count")


@query("SELECT tourn_id, round_number, hole_number, player_key FROM holes WHERE hole_score BETWEEN 1 AND 5 AND hole_par BETWEEN 2 AND 4 AND hole_length BETWEEN 200 AND 600 AND player_rating BETWEEN 850 AND 1000")
def d03_valid_holes(t):
    return P.in_ranges(t.holes, {"hole_score": (1, 5), "hole_par": (2, 4), "hole_length": (200, 600), "player_rating": (850, 1000)}).select(*HOLE_KEYS)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '1996-01-01' AND o_custkey % 2 = 0", cte=False)
def d04_eligible_events(t):
    before = F.lit("1996-01-01").cast("timestamp_ntz")
    return P.eligible_events(t.table("orders"), "o_orderstatus", ["F"], "o_orderdate", before, F.col("o_custkey") % 2 == 0).select("o_orderkey", "o_orderstatus")


@query(
    """SELECT o_orderkey FROM (SELECT *, CASE WHEN o_custkey % 4 <> 0 THEN o_orderdate + INTERVAL 3 DAY END AS fetched FROM orders)
WHERE o_orderstatus IN ('F', 'P') AND o_orderdate BETWEEN TIMESTAMP '1994-01-01' AND TIMESTAMP '1995-12-31' AND (fetched IS NULL OR fetched < TIMESTAMP '1995-06-01')""",
    cte=False,
)
def d05_refetch_window(t):
    o = t.table("orders").withColumn("fetched", F.when(F.col("o_custkey") % 4 != 0, F.col("o_orderdate") + F.expr("interval 3 days")))
    ntz = lambda x: F.lit(x).cast("timestamp_ntz")
    return P.to_refetch(o, "o_orderstatus", ["F", "P"], "o_orderdate", ntz("1994-01-01"), ntz("1995-12-31"), "fetched", ntz("1995-06-01")).select("o_orderkey")


_LEDGER = "(SELECT o_custkey AS event_id, list_extract(['success', 'failed', 'dq_failed', ''], o_orderkey % 4 + 1) AS status, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority ELSE '' END AS fingerprint, o_orderdate AS updated_at, o_orderkey FROM orders)"


def _ledger(t):
    pick = F.element_at(F.array(*(F.lit(x) for x in ("success", "failed", "dq_failed", ""))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.table("orders").select(F.lit("layer").alias("pipeline"), F.col("o_custkey").alias("event_id"), pick.alias("status"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).otherwise("").alias("fingerprint"), F.col("o_orderdate").alias("updated_at"), "o_orderkey")


_STATE_SQL = f"(SELECT event_id, status, fingerprint, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY updated_at DESC, o_orderkey DESC) AS rn FROM {_LEDGER}) WHERE rn = 1)"


def _state(t):
    return C.latest_by_struct(_ledger(t), ["pipeline", "event_id"], ["updated_at", "o_orderkey"])


@query(f"SELECT event_id, status, fingerprint FROM {_STATE_SQL}", cte=False)
def a20_ledger_state(t):
    return _state(t).select("event_id", "status", "fingerprint")


@query(
    f"SELECT c_custkey AS event_id FROM customer LEFT JOIN {_STATE_SQL} s ON c_custkey = event_id WHERE status IS NULL OR status NOT IN ('success', 'failed', 'dq_failed') OR (status = 'success' AND fingerprint = '') OR status = 'failed'",
    cte=False,
)
def d06_pending(t):
    return C.pending(t.table("customer").select(F.col("c_custkey").alias("event_id")), _state(t))


@query(f"SELECT c_custkey AS event_id, list_extract(['1-URGENT', '2-HIGH', '5-LOW'], c_custkey % 3 + 1) AS fingerprint FROM customer EXCEPT SELECT event_id, fingerprint FROM {_STATE_SQL} WHERE status = 'success'", cte=False)
def d07_changed_only(t):
    pick = F.element_at(F.array(*(F.lit(x) for x in ("1-URGENT", "2-HIGH", "5-LOW"))), (F.col("c_custkey") % 3 + 1).cast("int"))
    return C.changed_only(t.table("customer").select(F.col("c_custkey").alias("event_id"), pick.alias("fingerprint")), _state(t))


@query("SELECT tourn_id, round_number, player_key, course_id FROM base WHERE course_id IN (SELECT course_id FROM base GROUP BY course_id HAVING count(*) >= 5 ORDER BY count(*) DESC, course_id LIMIT 5)")
def d09_top_groups(t):
    return A.top_groups(t.base, "course_id", 5, 5).select(*ROUND_KEYS, "course_id")


@query("SELECT event_id FROM events WHERE cast(ts AS date) IN (SELECT DISTINCT cast('2024-01-01' AS date) + c_nationkey FROM customer WHERE c_custkey % 40 = 0)", cte=False)
def d10_on_dates(t):
    dates = t.table("customer").where("c_custkey % 40 = 0").select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey")).alias("date"))
    return P.on_dates(t.table("events"), "ts", dates).select("event_id")


# --- joins and sets


@query("SELECT DISTINCT o_custkey AS event_id FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'O'", cte=False)
def e04_ready_events(t):
    o = t.table("orders").select(F.col("o_custkey").alias("event_id"), "o_orderstatus")
    return C.common_keys(o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'"), ["event_id"])


@query("SELECT o_orderkey, c_name, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey", cte=False)
def e05_with_metadata(t):
    c = t.table("customer").join(t.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return t.table("orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "n_name", "r_name")


@query("SELECT c_custkey AS event_id FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)", cte=False)
def e06_missing_sources(t):
    return C.missing_keys(t.table("customer").select(F.col("c_custkey").alias("event_id")), t.table("orders").select(F.col("o_custkey").alias("event_id")), ["event_id"])


@query("SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')", cte=False)
def e07_orphans(t):
    return C.orphans(t.table("lineitem"), t.table("orders").where("o_orderstatus != 'P'").select(F.col("o_orderkey").alias("l_orderkey")), ["l_orderkey"]).select("l_orderkey", "l_linenumber", "l_suppkey")


@query("SELECT c_custkey AS event_id, c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000) AS live_results_ingested FROM customer", cte=False)
def e08_mark_present(t):
    return C.mark_present(t.table("customer").select(F.col("c_custkey").alias("event_id")), t.table("orders").where("o_totalprice > 100000").select(F.col("o_custkey").alias("event_id")), ["event_id"], "live_results_ingested")


@query(
    """, d AS (SELECT DISTINCT cast(ts AS date) AS date FROM events), s AS (SELECT date, date + INTERVAL 6 HOUR + to_minutes(cast(extract(day FROM date) AS int)) AS sunrise, date + INTERVAL 18 HOUR - to_minutes(cast(extract(day FROM date) AS int)) AS sunset FROM d)
SELECT event_id, cast(s.date AS varchar) AS date FROM events JOIN s ON cast(ts AS date) = s.date WHERE date_trunc('hour', ts) < sunset AND date_trunc('hour', ts) + INTERVAL 1 HOUR > sunrise"""
)
def e10_daylight_hours(t):
    hourly = t.table("events").select("event_id", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("t"))
    days = t.table("events").select(F.col("ts").cast("date").alias("date")).distinct()
    clock = lambda h, sign: S.at_clock(F.col("date"), F.lit(h * 3600) + sign * 60 * F.day("date"))
    return A.daylight_hours(hourly, days.withColumns({"sunrise": clock(6, 1), "sunset": clock(18, -1)})).select("event_id", F.col("date").cast("string").alias("date"))


@query(
    f""", c AS (SELECT division, cast(floor(observed_wind_mph / 3) AS bigint) AS wind_bin, {m4('total_impact', 'y')} FROM base GROUP BY ALL)
SELECT c.*, round(c.y - b.y, 4) AS vs_baseline FROM c LEFT JOIN c b ON c.division = b.division AND b.wind_bin = 0"""
)
def e11_vs_baseline(t):
    c = t.base.groupBy("division", F.floor(F.col("observed_wind_mph") / 3).alias("wind_bin")).agg(R.mean4("total_impact").alias("y"))
    return A.vs_baseline(c, ["division"], "wind_bin", "y", 0)


@query("SELECT tourn_id, round_number, player_key, count(*) OVER (PARTITION BY division) AS division_rounds FROM base")
def e12_group_total(t):
    """A join with counts: a window would bring a large division's rows together in one task."""
    n = t.base.groupBy("division").agg(F.count("*").alias("division_rounds"))
    return t.base.join(n, "division").select(*ROUND_KEYS, "division_rounds")


@query(
    """SELECT tourn_id, round_number, player_key, w.wind, g.gust, round(0.15 * w.wind + 0.05 * g.gust, 4) AS impact FROM base, (VALUES (0), (5), (10)) w (wind), (VALUES (1), (8)) g (gust) WHERE g.gust >= w.wind"""
)
def e13_scenario_grid(t):
    grid = t.spark.createDataFrame([(w, g) for w in (0, 5, 10) for g in (1, 8)], "wind int, gust int")
    return A.scenario_grid(t.base.select(*ROUND_KEYS), grid).withColumn("impact", S.rounded(0.15 * F.col("wind") + 0.05 * F.col("gust"), 4))


@query("SELECT tourn_id, round_number, player_key, 'left' AS side FROM (SELECT DISTINCT tourn_id, round_number, player_key FROM holes EXCEPT SELECT tourn_id, round_number, player_key FROM base) UNION ALL SELECT tourn_id, round_number, player_key, 'right' FROM (SELECT tourn_id, round_number, player_key FROM base EXCEPT SELECT tourn_id, round_number, player_key FROM holes)")
def i02_key_differences(t):
    return C.key_differences(t.holes, t.base, ROUND_KEYS)


@query("SELECT o_custkey FROM orders EXCEPT ALL SELECT c_custkey FROM customer", cte=False)
def i03_except_all(t):
    return t.table("orders").select("o_custkey").exceptAll(t.table("customer").select("c_custkey"))


# --- analytics


@query("SELECT tourn_id, round_number, cast(mode AS varchar) AS mode, rows FROM (SELECT tourn_id, round_number, d AS mode, sum(n) OVER (PARTITION BY tourn_id, round_number)::bigint AS rows, row_number() OVER (PARTITION BY tourn_id, round_number ORDER BY n DESC, d) AS rn FROM (SELECT tourn_id, round_number, cast(fetched_at AS date) AS d, count(*) AS n FROM holes GROUP BY ALL)) WHERE rn = 1")
def f18_mode_date(t):
    return A.mode_date(t.holes.withColumn("d", F.col("fetched_at").cast("date")), ["tourn_id", "round_number"], "d").withColumn("mode", F.col("mode").cast("string"))


@query("SELECT tourn_id, count(DISTINCT d) AS n_dates, cast(min(d) - 2 AS date)::varchar AS from_date, cast(max(d) + 2 AS date)::varchar AS to_date FROM (SELECT tourn_id, cast(fetched_at AS date) AS d FROM holes) GROUP BY tourn_id")
def f19_play_span(t):
    return A.play_span(t.holes.withColumn("d", F.col("fetched_at").cast("date")), "tourn_id", "d", 2).select("tourn_id", "n_dates", F.col("from_date").cast("string").alias("from_date"), F.col("to_date").cast("string").alias("to_date"))


@query(
    f"""SELECT division, count(*) AS rows, {m4('actual_round_strokes', 'mean_actual')}, {m4('round_total_par', 'mean_expected')}, {m4('x', 'residual_mean')}, round(quantile_cont(x, 0.5), 4) AS residual_median,
  round(stddev_samp(x), 4) AS residual_std, {m4('abs(x)', 'mae')} FROM (SELECT *, actual_round_strokes - round_total_par AS x FROM rounds) GROUP BY division"""
)
def f21_residual_summary(t):
    return A.residual_summary(t.rounds, ["division"], "actual_round_strokes", "round_total_par")


_METRICS_SQL = "count(*) AS rows, round(avg(cast(abs(a - p) AS decimal(18,6))), 4) AS mae, round(sqrt(avg((a - p) * (a - p))), 4) AS rmse, round(CASE WHEN count(*) > 1 AND var_pop(a) * count(a) > 1e-9 THEN 1 - sum((a - p) * (a - p)) / (var_pop(a) * count(a)) END, 4) AS r2"


@query(f"SELECT tourn_id, {_METRICS_SQL} FROM (SELECT tourn_id, actual_round_strokes AS a, round_total_par AS p FROM rounds) GROUP BY tourn_id")
def f22_event_metrics(t):
    return A.regression_metrics(t.rounds, ["tourn_id"], "actual_round_strokes", "round_total_par")


@query(f"SELECT {_METRICS_SQL} FROM (SELECT actual_round_strokes AS a, round_total_par AS p FROM rounds)")
def f23_regression_metrics(t):
    return A.regression_metrics(t.rounds, [], "actual_round_strokes", "round_total_par")


@query(f"SELECT tourn_id, round_number, count(*) AS rows, {m4('actual_round_strokes', 'mean_actual_round_strokes')}, {m4('predicted', 'mean_predicted')}, {m4('wind_impact', 'mean_wind_impact')}, {m4('wind_mean', 'mean_wind_mean')} FROM scored GROUP BY tourn_id, round_number")
def f24_round_summary(t):
    return A.means(t.scored, ["tourn_id", "round_number"], ["actual_round_strokes", "predicted", "wind_impact", "wind_mean"])


@query(
    f""", l AS (UNPIVOT (SELECT wind_impact, temperature_impact, total_impact FROM base) ON wind_impact, temperature_impact, total_impact INTO NAME effect VALUE v)
SELECT effect, count(v) AS n, {m4('v', 'mean')}, round(quantile_cont(v, 0.5), 4) AS median, round(stddev_samp(v), 4) AS std, round(quantile_cont(v, 0.1), 4) AS p10, round(quantile_cont(v, 0.9), 4) AS p90, round(min(v), 4) AS low, round(max(v), 4) AS high FROM l GROUP BY effect"""
)
def f25_effect_summary(t):
    return A.effect_summary(t.base.select("wind_impact", "temperature_impact", "total_impact"), ["wind_impact", "temperature_impact", "total_impact"])


_ORDER = ["calm", "light", "moderate", "strong", "very_strong", "unknown"]


@query(
    f"""SELECT round_wind_speed_bucket, count(total_impact) AS n, {m4('total_impact', 'mean')}, {', '.join(f"round(quantile_cont(total_impact, {q}), 4) AS p{int(100 * q)}" for q in (0.1, 0.25, 0.5, 0.75, 0.9))},
  cast(list_position({_ORDER}, round_wind_speed_bucket) AS int) AS place FROM base GROUP BY round_wind_speed_bucket"""
)
def f26_bucket_quantiles(t):
    """Also H02."""
    return A.bucket_quantiles(t.base, "round_wind_speed_bucket", "total_impact", _ORDER)


@query(f"SELECT precip_flag, rating_band, count(*) AS rows, {m4('total_impact', 'mean_total_impact')}, {m4('observed_wind_mph', 'mean_observed_wind_mph')} FROM base GROUP BY precip_flag, rating_band")
def f27_condition_summary(t):
    return A.means(t.base, ["precip_flag", "rating_band"], ["total_impact", "observed_wind_mph"])


@query(
    """, g AS (SELECT division, count(*) AS rows, count(*) FILTER (observed_wind_mph < 6) AS calm_rows, avg(cast(total_impact AS decimal(18,6))) AS m, avg(cast(observed_wind_mph AS decimal(18,6))) AS w,
  avg(cast(total_impact AS decimal(18,6))) FILTER (observed_wind_mph < 6) AS cm, avg(cast(observed_wind_mph AS decimal(18,6))) FILTER (observed_wind_mph < 6) AS cw FROM base GROUP BY division)
SELECT division, rows, calm_rows, round(m - cm, 4) AS vs_calm, round(CASE WHEN abs(w - cw) > 1e-9 THEN 5 * (m - cm) / (w - cw) END, 3) AS per_5_mph FROM g WHERE rows >= 20 AND calm_rows >= 10"""
)
def f28_relative_to_calm(t):
    return A.relative_to_calm(t.base, ["division"], "total_impact", "observed_wind_mph", 6.0, 20)


@query(
    """, c AS (SELECT cast(floor(observed_wind_mph / 3) * 3 AS double) AS bin, count(*) AS rows, avg(cast(wind_impact AS decimal(18,6))) AS m FROM base WHERE observed_wind_mph IS NOT NULL GROUP BY 1)
SELECT bin, rows, round(m - (SELECT m FROM c WHERE bin = 3), 4) AS vs_reference FROM c WHERE rows >= 10"""
)
def f29_effect_curve(t):
    return A.effect_curve(t.base, "wind_impact", "observed_wind_mph", 3.0, 4.0, 10)


_SLOPE = "count(*) AS rows, round(regr_slope(y, x), 4) AS slope, round(5 * regr_slope(y, x), 4) AS slope_5, round(regr_intercept(y, x), 3) AS intercept, round(regr_r2(y, x), 4) AS r2"


@query(f"SELECT {_SLOPE} FROM (SELECT cast(round_strokes_over_par AS double) AS y, observed_wind_mph AS x FROM base)")
def f30_slope(t):
    return A.slope(t.base.withColumn("y", F.col("round_strokes_over_par").cast("double")), [], "y", "observed_wind_mph")


@query(f"SELECT division, {_SLOPE} FROM (SELECT division, cast(round_strokes_over_par AS double) AS y, observed_wind_mph AS x FROM base) GROUP BY division")
def f31_slope_by_division(t):
    return A.slope(t.base.withColumn("y", F.col("round_strokes_over_par").cast("double")), ["division"], "y", "observed_wind_mph")


@query(f"SELECT course_id, {_SLOPE} FROM (SELECT course_id, cast(round_strokes_over_par AS double) AS y, observed_wind_mph AS x FROM base) GROUP BY course_id HAVING count(*) >= 10 AND stddev_samp(x) >= 2")
def f32_course_slopes(t):
    return A.slope(t.base.withColumn("y", F.col("round_strokes_over_par").cast("double")), ["course_id"], "y", "observed_wind_mph", 10, 2.0)


@query("SELECT o_orderstatus AS status, count(*) AS total, count(*) FILTER (o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS with_rounds, count(*) FILTER (o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) AS without_rounds FROM orders GROUP BY o_orderstatus", cte=False)
def f35_status_audit(t):
    o = C.mark_present(t.table("orders"), t.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), ["o_orderkey"], "has")
    return A.status_audit(o, "o_orderstatus", "has")


@query(f"SELECT count(*) AS events, count(*) FILTER (status = 'success') AS ok, count(*) FILTER (status = 'failed') AS failed, round(count(*) FILTER (status = 'failed') / count(*), 6) AS failure_rate, count(*) FILTER (status = 'failed') / count(*) >= 0.25 AS exceeds FROM {_STATE_SQL}", cte=False)
def f36_run_summary(t):
    return A.run_summary(_state(t), 0.25)


@query(
    """, h AS (SELECT tourn_id, sha256(concat_ws('|', cast(round_number AS varchar), cast(hole_number AS varchar), player_key, cast(hole_score AS varchar))) AS h FROM holes)
SELECT tourn_id, sha256(concat('v1|', cast(count(*) AS varchar), '|', cast(sum(cast(cast(concat('0x', substr(h, 1, 15)) AS bigint) AS hugeint)) AS varchar), '|', cast(sum(cast(cast(concat('0x', substr(h, 16, 15)) AS bigint) AS hugeint)) AS varchar), '|', cast(sum(cast(cast(concat('0x', substr(h, 31, 15)) AS bigint) AS hugeint)) AS varchar), '|', cast(sum(cast(cast(concat('0x', substr(h, 46, 15)) AS bigint) AS hugeint)) AS varchar))) AS fingerprint FROM h GROUP BY tourn_id"""
)
def f37_event_fingerprint(t):
    return C.event_fingerprint(t.holes, "tourn_id", ["round_number", "hole_number", "player_key", "hole_score"], "v1")


@query(
    """, w AS (SELECT unnest([0.0, 5.0, 10.0, 15.0])::double AS wind), p AS (SELECT wind, avg(cast(0.15 * wind + 0.01 * (player_rating - 900) AS decimal(18,6))) AS y FROM rounds, w GROUP BY wind)
SELECT wind, round(y, 4) AS mean_prediction, round(y - (SELECT y FROM p WHERE wind = 0), 4) AS vs_zero FROM p"""
)
def f39_pdp_curve(t):
    grid = t.spark.createDataFrame([(float(w),) for w in (0, 5, 10, 15)], "wind double")
    y = 0.15 * F.col("wind") + 0.01 * (F.col("player_rating") - 900)
    p = t.rounds.select("player_rating").crossJoin(F.broadcast(grid)).groupBy("wind").agg(C.dmean(y).alias("y"))
    zero = p.where("wind = 0").select(F.col("y").alias("y0"))
    return p.join(F.broadcast(zero)).select("wind", S.rounded("y", 4).alias("mean_prediction"), S.rounded(F.col("y") - F.col("y0"), 4).alias("vs_zero"))


@query("SELECT division, round(stddev_samp(total_impact), 4) AS std, round(quantile_cont(abs(total_impact), 0.95), 4) AS p95_abs FROM base GROUP BY division")
def f41_stability(t):
    return A.stability(t.base, ["division"], "total_impact")


@query(f"SELECT division, count(*) AS rows, {', '.join(m4(c, 'mean_' + c) for c in ('wind_impact', 'temperature_impact', 'precip_impact', 'total_impact'))} FROM base GROUP BY division")
def f42_robustness(t):
    return A.means(t.base, ["division"], ["wind_impact", "temperature_impact", "precip_impact", "total_impact"])


@query("SELECT course_id, count(*) AS rows, count(DISTINCT layout_id) AS layouts, round(min(observed_wind_mph), 4) AS wind_min, round(max(observed_wind_mph), 4) AS wind_max, round(stddev_samp(observed_wind_mph), 4) AS wind_std, round(max(observed_temp_f) - min(observed_temp_f), 4) AS temp_range FROM base GROUP BY course_id")
def f43_course_support(t):
    return A.course_support(t.base, "course_id", "layout_id", "observed_wind_mph", "observed_temp_f")


@query(f"SELECT cast(floor(temp_mean / 5) AS bigint) AS temp_bin, round(min(predicted_total_reference), 4) AS best, {m4('predicted_total_reference', 'mean')} FROM scored WHERE temp_mean IS NOT NULL GROUP BY 1")
def f45_temperature_slice(t):
    return A.temperature_slice(t.scored, "temp_mean", "predicted_total_reference")


@query("SELECT tourn_id, round_number, player_key, cast(sum(hole_score - hole_par) AS bigint) AS residual, arg_min(division, cast(hole_number AS varchar)) AS division FROM enriched WHERE NOT wx_missing GROUP BY ALL")
def f46_round_residuals(t):
    return A.round_residuals(t.enriched, ROUND_KEYS, "hole_score", "hole_par", ["division"], "hole_number")


@query(
    f"""SELECT count(*) AS rows, count(DISTINCT (tourn_id, round_number, player_key)) AS keys, count(*) FILTER (wind_mean IS NULL) AS null_wind, {m4('actual_round_strokes', 'mean')}, round(stddev_samp(actual_round_strokes), 4) AS std,
  round(quantile_cont(actual_round_strokes, 0.25), 4) AS q1, round(quantile_cont(actual_round_strokes, 0.5), 4) AS q2, round(quantile_cont(actual_round_strokes, 0.75), 4) AS q3 FROM rounds"""
)
def f47_validate_dataset(t):
    d = A.validate_dataset(t.rounds, ROUND_KEYS, ["wind_mean"], "actual_round_strokes")
    return d.withColumnRenamed("null_wind_mean", "null_wind")


@query("SELECT cast(least(floor((total_impact - lo) / (hi - lo) * 30) + 1, 30) AS int) AS bin, count(*) AS rows FROM base, (SELECT min(total_impact) AS lo, max(total_impact) AS hi FROM base) GROUP BY 1")
def f48_histogram(t):
    return A.histogram(t.base, "total_impact", 30)


@query("SELECT max(o_orderkey) AS max_id FROM orders", cte=False)
def f49_max_id(t):
    return t.table("orders").agg(F.max("o_orderkey").alias("max_id"))


@query("SELECT 'division' AS grouping, round(max(abs(m)), 4) AS max_abs_bias FROM (SELECT avg(cast(round_strokes_over_par AS decimal(18,6))) AS m FROM rounds GROUP BY division) UNION ALL SELECT 'course', round(max(abs(m)), 4) FROM (SELECT avg(cast(round_strokes_over_par AS decimal(18,6))) AS m FROM rounds GROUP BY course_id HAVING count(*) >= 100)")
def f50_f51_bias(t):
    return A.worst_bias(t.rounds, {"division": ("division", 0), "course": ("course_id", 100)}, "round_strokes_over_par")


@query(
    """, e AS (SELECT list_distinct(quantile_cont(hole_length, [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])) AS edges FROM holes)
SELECT tourn_id, round_number, hole_number, player_key, cast(greatest(len(list_filter(edges, lambda x: x < hole_length)), 1) AS int) AS bin FROM holes, e"""
)
def g05_qcut(t):
    return A.qcut(t.holes.select(*HOLE_KEYS, "hole_length"), "hole_length", 10).select(*HOLE_KEYS, "bin")


@query("SELECT n_name, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY n_name ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer JOIN nation ON c_nationkey = n_nationkey) WHERE rn = 1", cte=False)
def g06_best_candidate(t):
    c = t.table("customer").join(t.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.groupBy("n_name").agg(F.max_by(F.struct("c_custkey", "c_acctbal"), F.struct("c_acctbal", -F.col("c_custkey"))).alias("b")).select("n_name", "b.*")


@query(
    f""", c AS (SELECT division, cast(floor(observed_wind_mph / 2) AS bigint) AS x, {m4('wind_impact', 'y')} FROM base GROUP BY ALL),
d AS (SELECT division, y - lag(y) OVER w AS d1, y - 2 * lag(y) OVER w + lag(y, 2) OVER w AS d2 FROM c WINDOW w AS (PARTITION BY division ORDER BY x))
SELECT division, round(sum(abs(d1)), 4) AS variation, round(sum(abs(d2)), 4) AS roughness, count(*) FILTER (d1 < -0.1) AS falls FROM d GROUP BY division"""
)
def g07_curve_shape(t):
    c = t.base.groupBy("division", F.floor(F.col("observed_wind_mph") / 2).alias("x")).agg(R.mean4("wind_impact").alias("y"))
    return A.curve_shape(c, ["division"], "x", "y")


@query(
    """, d AS (SELECT o_orderkey AS id, o_custkey % 3 = 0 AS found FROM orders), a AS (SELECT *, id - coalesce(max(CASE WHEN found THEN id END) OVER (ORDER BY id), (SELECT min(id) FROM d) - 1) AS run FROM d)
SELECT id, found FROM d WHERE id < coalesce((SELECT min(id) FROM a WHERE run >= 25), 9223372036854775807)"""
)
def g08_streak_cut(t):
    d = t.table("orders").select(F.col("o_orderkey").alias("id"), (F.col("o_custkey") % 3 == 0).alias("found"))
    return A.streak_cut(d, "id", "found", 25)


@query(
    f""", g AS (SELECT course_id, count(*) AS rounds, {m4('total_impact', 'impact')} FROM base GROUP BY course_id)
SELECT *, 'top' AS side FROM (SELECT * FROM g ORDER BY impact DESC, course_id LIMIT 5) UNION ALL SELECT *, 'bottom' FROM (SELECT * FROM g ORDER BY impact, course_id LIMIT 5)"""
)
def h01_top_bottom(t):
    g = t.base.groupBy("course_id").agg(F.count("*").alias("rounds"), R.mean4("total_impact").alias("impact"))
    return A.top_bottom(g, "impact", ["course_id"], 5)


@query("SELECT DISTINCT round_month, round_month_label FROM base WHERE state <> 'UNKNOWN'")
def h03_options(t):
    return P.options(t.base, ["round_month", "round_month_label"], {"state": "UNKNOWN"})


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY md5(concat_ws('|', cast(o_orderkey AS varchar), '42')), o_orderkey LIMIT 500", cte=False)
def h04_sample(t):
    return A.sample_n(t.table("orders"), "o_orderkey", 500, 42).select("o_orderkey", "o_custkey")


# --- quality


@query("SELECT l_orderkey % 37 AS \"group\", 'unique(g,l_orderkey,l_linenumber)' AS rule, count(*) AS failures FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1) GROUP BY 1", cte=False)
def k01_unique(t):
    return Q.rule_unique(t.table("lineitem").withColumn("g", F.col("l_orderkey") % 37), "g", ["g", "l_orderkey", "l_linenumber"]).drop("sample")


@query("SELECT tourn_id AS \"group\", 'not_blank(' || c || ')' AS rule, n AS failures FROM (SELECT tourn_id, 'wind_speed_mps' AS c, count(*) FILTER (wind_speed_mps IS NULL) AS n FROM enriched GROUP BY 1 UNION ALL SELECT tourn_id, 'division', count(*) FILTER (trim(division) = '') FROM enriched GROUP BY 1) WHERE n > 0")
def k02_not_blank(t):
    return Q.rule_not_blank(t.enriched, "tourn_id", ["wind_speed_mps", "division"], "player_key").drop("sample")


@query("SELECT tourn_id AS \"group\", 'range(humidity_pct)' AS rule, count(*) AS failures FROM wx WHERE humidity_pct > 90 GROUP BY 1 UNION ALL SELECT tourn_id, 'range(wind_gust_mps)', count(*) FROM wx WHERE wind_gust_mps < wind_speed_mps GROUP BY 1")
def k03_range(t):
    return Q.rule_range(t.wx, "tourn_id", "humidity_pct", 0, 90, "event_id").unionByName(Q.rule_range(t.wx, "tourn_id", "wind_gust_mps", "wind_speed_mps", None, "event_id")).drop("sample")


@query("SELECT tourn_id AS \"group\", 'in(division)' AS rule, count(*) AS failures FROM holes WHERE division NOT IN ('BUILDING', 'MACHINERY', 'AUTOMOBILE') GROUP BY 1")
def k04_accepted_values(t):
    return Q.rule_in(t.holes, "tourn_id", "division", ["BUILDING", "MACHINERY", "AUTOMOBILE"], "player_key").drop("sample")


@query("SELECT a.tourn_id AS \"group\", 'same_count' AS rule, a.n - b.n AS failures FROM (SELECT tourn_id, count(*) AS n FROM holes_raw GROUP BY 1) a JOIN (SELECT tourn_id, count(*) AS n FROM holes GROUP BY 1) b USING (tourn_id) WHERE a.n <> b.n")
def k05_same_count(t):
    return Q.rule_same_count(t.holes_raw, t.holes, "tourn_id").drop("sample")


@query("SELECT tourn_id AS \"group\", 'fd(player_key->layout_id)' AS rule, count(*) AS failures FROM (SELECT tourn_id, player_key FROM holes GROUP BY 1, 2 HAVING count(DISTINCT obs_hour) > 1) GROUP BY 1")
def k07_functional_dependency(t):
    return Q.rule_fd(t.holes.drop("layout_id").withColumnRenamed("obs_hour", "layout_id"), "tourn_id", "player_key", "layout_id").drop("sample")


@query("SELECT tourn_id AS \"group\", 'complete(tourn_id,obs_hour)' AS rule, count(*) AS failures FROM (SELECT DISTINCT tourn_id, obs_hour FROM holes EXCEPT SELECT tourn_id, obs_hour FROM wx) GROUP BY 1")
def k08_complete(t):
    return Q.rule_complete(t.holes, t.wx, "tourn_id", ["tourn_id", "obs_hour"]).drop("sample")


@query("SELECT tourn_id, obs_hour, event_id FROM wx WHERE tourn_id NOT IN (SELECT tourn_id FROM wx WHERE humidity_pct > 99 OR wind_gust_mps > 25)")
def k09_validated_rows(t):
    good, _ = Q.validate(t.wx, "tourn_id", [Q.rule_range(t.wx, "tourn_id", "humidity_pct", 0, 99, "event_id"), Q.rule_range(t.wx, "tourn_id", "wind_gust_mps", 0, 25, "event_id")])
    return good.select("tourn_id", "obs_hour", "event_id")


@query(
    """SELECT p.page_id, CASE WHEN q.h IS NULL THEN 'new' WHEN q.h <> sha256(p.html) THEN 'updated' ELSE 'unchanged' END AS change FROM pages p
LEFT JOIN (SELECT page_id, sha256(CASE WHEN page_id % 7 = 0 THEN url ELSE html END) AS h FROM pages WHERE page_id % 3 <> 0) q ON p.page_id = q.page_id""",
    cte=False,
)
def b47_l05_changes(t):
    p = t.table("pages")
    new = p.select("page_id", F.sha2("html", 256).alias("h"))
    old = p.where("page_id % 3 != 0").select("page_id", F.sha2(F.when(F.col("page_id") % 7 == 0, F.col("url")).otherwise(F.col("html")), 256).alias("h"))
    return C.change_type(new, old, "page_id", "h").select("page_id", "change")


@query("SELECT o_orderkey, CASE WHEN b < 80 THEN 'train' ELSE 'test' END AS split FROM (SELECT o_orderkey, cast(concat('0x', substr(md5(cast(o_orderkey AS varchar)), 1, 8)) AS bigint) % 100 AS b FROM orders)", cte=False)
def j01_hash_split(t):
    return A.hash_split(t.table("orders"), "o_orderkey", {"train": 80, "test": 20}).select("o_orderkey", "split")


@query("SELECT tourn_id, round_number, player_key, CASE WHEN b < 64 THEN 'train' WHEN b < 80 THEN 'valid' ELSE 'test' END AS split FROM (SELECT *, cast(concat('0x', substr(md5(cast(tourn_id AS varchar)), 1, 8)) AS bigint) % 100 AS b FROM rounds)")
def j02_group_split(t):
    return A.hash_split(t.rounds, "tourn_id", {"train": 64, "valid": 16, "test": 20}).select(*ROUND_KEYS, "split")


@query(f"SELECT tourn_id, round_number, player_key, {s4('predicted', 'predicted_wind_reference', 'predicted_temperature_reference', 'predicted_total_reference', 'total_impact')} FROM scored")
def j07_counterfactual(t):
    return t.scored.select(*ROUND_KEYS, *r4("predicted", "predicted_wind_reference", "predicted_temperature_reference", "predicted_total_reference", "total_impact"))


@query("SELECT cast(date_trunc('hour', ts) AS varchar) AS hour, count(*) AS n, round(avg(cast(value AS decimal(18,6))), 4) AS mean_value FROM events GROUP BY 1", cte=False)
def s04_hourly(t):
    hour = F.window(F.col("ts").cast("timestamp"), "1 hour")
    return t.table("events").groupBy(hour.alias("w")).agg(F.count("*").alias("n"), R.mean4("value").alias("mean_value")).select(F.col("w.start").cast("string").alias("hour"), "n", "mean_value")


def _events_stream(t):
    """The events as a stream of files."""
    kinds = ", ".join(f"{n} {k}" for n, k in t.table("events").dtypes if n in ("ts", "value", "user_id", "event_id", "event_type"))
    stream = W.new_files(t.spark, f"{t.folder}/events.parque[t]", kinds)  # a pattern, as the table may be a file or a folder
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT cast(date_trunc('hour', ts) AS varchar) AS hour, count(*) AS n, round(avg(cast(value AS decimal(18,6))), 4) AS mean_value FROM events GROUP BY 1", cte=False)
def s04_hourly_stream(t):
    """The streaming form: windows of all files' events, in complete mode."""
    stream = W.hourly(_events_stream(t), "ts", "value", None, R.mean4)
    return W.run_now(stream, Z.shared_folder(t.spark, "s04"), "complete").select(F.col("hour").cast("string").alias("hour"), "n", "mean_value")


@query("SELECT event_id, user_id, event_type, round(value, 6) AS value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1", cte=False)
def s02_newest_wins_stream(t):
    """Each user's newest event, by keyed state, merged into a table by type."""
    out = Z.shared_folder(t.spark, "s02")
    stream = _events_stream(t).select("event_id", "ts", "user_id", "event_type", "value")
    W.newest_wins(stream, f"{out}/table", ["user_id"], ["ts", "event_id"], "event_type", f"{out}/state").awaitTermination()
    return t.spark.read.parquet(f"{out}/table").select("event_id", "user_id", "event_type", S.rounded("value", 6).alias("value"))


@query("SELECT DISTINCT event_type, user_id % 50 AS bucket FROM events", cte=False)
def s03_drop_repeats_stream(t):
    """Contents, here type and bucket of users, that a stream passes on once."""
    stream = _events_stream(t).withColumns({"bucket": F.col("user_id") % 50}).withColumn("content", F.concat_ws("|", "event_type", "bucket"))
    once = W.drop_repeats(stream, "content", "ts", "400 days")
    return W.run_now(once, Z.shared_folder(t.spark, "s03")).select("event_type", "bucket")


# --- places, responses, repairs


_COUNTRIES = ["united states", " USA", "U.S.", "Canada", "MEXICO", "Australia", "new  zealand", "United Kingdom", "uk", "fr", "Finland", ""]
_NORMAL = [" ".join(x.split()) for x in _COUNTRIES]
_CODES = ["US", "US", "US", "CA", "MX", "AU", "NZ", "GB", "UK", "FR", None, None]
_PAIRS = [*I.POINT_KEYS, ("location.latitude", "location.longitude"), ("location.lat", "location.lon")]


def _listed(values: list, index: str) -> str:
    return f"list_extract([{', '.join('NULL' if v is None else repr(v) for v in values)}], {index} + 1)"


# which pair of columns holds a place goes by the customer's number; a balance over 9,000 is no latitude in hundreds
_PLACES_SQL = f"""(SELECT c_custkey AS event_id, c_custkey AS k, c_custkey % 8 < 7 AND c_acctbal <= 9000 AS own, c_acctbal, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE '' END AS city,
  CASE WHEN c_custkey % 2 = 0 THEN 'ST' ELSE '' END AS state, {_listed(_NORMAL, 'c_custkey % 12')} AS country, {_listed(_CODES, 'c_custkey % 12')} AS code,
  CASE WHEN c_custkey % 7 = 0 THEN 'raw text' WHEN c_custkey % 11 = 0 THEN 'old text' ELSE '' END AS raw FROM customer)"""


def _places(t):
    """Customers as events: each holds its place in one of all pairs of columns, and is in one of several countries."""
    k, number = F.col("c_custkey"), lambda n: (F.col("c_acctbal") / n).cast("double").cast("string")
    m = {}
    for i, (lat, lon) in enumerate(_PAIRS):  # the first whose turn it is; course_lat and course_lon also stand in where the first pair is wrong
        for name, n in ((lat, 100), (lon, 50)):
            m[name] = F.when(k % 8 == i, number(n)) if name not in m else F.coalesce(m[name], F.when(k % 8 == i, number(n)))
    m |= {c: F.when(k % 16 == 0, v).otherwise(m[c]) for c, v in (("course_lat", "1.0"), ("course_lon", "2.0"))}
    nested = F.struct(*(c.alias(n.split(".")[1]) for n, c in m.items() if "." in n))
    return t.table("customer").select(
        k.alias("event_id"), *(c.alias(n) for n, c in m.items() if "." not in n), nested.alias("location"), F.when(k % 4 == 0, F.col("c_mktsegment")).otherwise("").alias("city"),
        F.when(k % 2 == 0, "ST").otherwise("").alias("state"), F.element_at(F.array(*(F.lit(x) for x in _COUNTRIES)), (k % 12 + 1).cast("int")).alias("country"),
        F.when(k % 7 == 0, " raw   text ").otherwise("").alias("location_raw"), F.when(k % 11 == 0, "old text ").alias("raw_location"),
    )


@query(
    f"""SELECT event_id, round(CASE WHEN own THEN cast(c_acctbal AS double) / 100 WHEN k % 16 = 0 THEN 1.0 END, 6) AS latitude,
  round(CASE WHEN own THEN cast(c_acctbal AS double) / 50 WHEN k % 16 = 0 THEN 2.0 END, 6) AS longitude FROM {_PLACES_SQL}""",
    cte=False,
)
def b39_geopoint(t):
    d = _places(t)
    p = d.withColumn("p", I.geopoint(d))
    return p.select("event_id", S.rounded("p.latitude", 6).alias("latitude"), S.rounded("p.longitude", 6).alias("longitude"))


_GEOCODE_SQL = f"""(SELECT *, nullif(CASE WHEN city = '' AND state = '' AND country = '' THEN raw ELSE array_to_string(list_filter([city, state, country], lambda x: x != ''), ', ') END, '') AS query_text,
  sha256(cast(to_json(struct_pack(city := lower(city), country := lower(country), location_raw := lower(raw), state := lower(state))) AS varchar)) AS fingerprint FROM {_PLACES_SQL})"""


@query(
    f"""SELECT event_id, query_text, code AS query_code, fingerprint, CASE WHEN query_text IS NULL THEN 0 ELSE len(list_distinct(list_filter([CASE WHEN city != '' AND state != '' THEN concat(city, ', ', state) END, nullif(city, ''), query_text], lambda x: x IS NOT NULL))) * CASE WHEN code IS NULL THEN 1 ELSE 2 END END AS n_candidates FROM {_GEOCODE_SQL}""",
    cte=False,
)
def b40_geocode_query(t):
    return I.geocode_query(_places(t)).select("event_id", "query_text", "query_code", "fingerprint", F.size("candidates").cast("bigint").alias("n_candidates"))


@query(
    f"""WITH g AS {_GEOCODE_SQL}, cache AS (SELECT DISTINCT fingerprint FROM g WHERE state = 'ST' AND query_text IS NOT NULL)
SELECT event_id, CASE WHEN own OR k % 16 = 0 THEN 'metadata' WHEN c.fingerprint IS NOT NULL THEN 'cache' ELSE 'missing' END AS point_source FROM g LEFT JOIN cache c USING (fingerprint)""",
    cte=False,
)
def e14_resolve_points(t):
    g = I.geocode_query(_places(t))
    cache = g.where("state = 'ST' and query_text is not null").select("fingerprint", F.lit(1.5).alias("latitude"), F.lit(2.5).alias("longitude"))
    return I.resolve_points(g, cache).select("event_id", "point_source")


@query(
    f"""SELECT o_orderkey, sha256(concat('{{"params":{{"end_date":"', cast(o_orderdate + INTERVAL 1 DAY AS date), '","hourly":"{I.ARCHIVE_PARAMETERS['hourly']}","latitude":"', printf('%.5f', la), '","longitude":"', printf('%.5f', lo),
  '","precipitation_unit":"mm","start_date":"', cast(o_orderdate - INTERVAL 1 DAY AS date), '","temperature_unit":"celsius","timezone":"UTC","wind_speed_unit":"ms"}},"url":"{I.ARCHIVE_URL}"}}')) AS request_fingerprint
FROM (SELECT o_orderkey, cast(o_orderdate AS date) AS o_orderdate, cast(o_orderkey % 90 AS double) + 0.5 AS la, cast(o_orderkey % 180 AS double) - 0.25 AS lo FROM orders)""",
    cte=False,
)
def b38_weather_request(t):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    d = t.table("orders").select(k, (k % 90 + 0.5).cast("double").alias("latitude"), (k % 180 - 0.25).cast("double").alias("longitude"), F.date_sub(day, 1).alias("from_date"), F.date_add(day, 1).alias("to_date"))
    return I.weather_request(d).select("o_orderkey", "request_fingerprint")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN 'failed' WHEN o_orderkey % 5 = 1 THEN 'not_found' WHEN o_orderkey % 5 = 2 THEN 'failed' WHEN o_orderkey % 3 != 2 THEN 'empty' ELSE 'success' END AS outcome FROM orders""",
    cte=False,
)
def b48_classify_response(t):
    k = F.col("o_orderkey")
    d = t.table("orders").select(
        k, F.when(k % 11 == 0, F.col("o_orderpriority")).alias("error"), F.when(k % 5 == 1, 404).when(k % 5 == 2, 500).otherwise(200).alias("status"),
        F.when(k % 3 == 0, ' { } ').when(k % 3 == 1, '{"players": [], "n": 1}').otherwise(F.to_json(F.struct(F.array("o_custkey").alias("players")))).alias("payload"),
    )
    return d.select("o_orderkey", I.classify_response("error", "status", "payload").alias("outcome"))


@query(
    """SELECT tourn_id AS event_id, round_number, cast(d AS date) AS round_date, CASE WHEN played IS NULL THEN 'inferred' ELSE 'played' END AS date_source, cast(d - INTERVAL 1 DAY AS date) AS from_date, cast(d + INTERVAL 1 DAY AS date) AS to_date
FROM (SELECT e.tourn_id, e.round_number, played, coalesce(played, date '2024-05-03' + cast(floor((e.round_number - 1) * 2 / 4) AS integer)) AS d
  FROM (SELECT DISTINCT tourn_id, unnest(range(1, 6)) AS round_number FROM holes) e
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY tourn_id, round_number ORDER BY n DESC, played) AS rn FROM (SELECT tourn_id, round_number, cast(fetched_at AS date) AS played, count(*) AS n FROM holes WHERE round_number != 3 GROUP BY ALL)) p
    ON e.tourn_id = p.tourn_id AND e.round_number = p.round_number AND rn = 1)"""
)
def f20_fetch_tasks(t):
    rounds = t.holes.where("round_number != 3").select(F.col("tourn_id").alias("event_id"), "round_number", F.col("fetched_at").cast("date").alias("play_date"))
    day = lambda x: F.lit(x).cast("date")
    events = t.holes.select(F.col("tourn_id").alias("event_id")).distinct().select("event_id", day("2024-05-03").alias("start_date"), day("2024-05-05").alias("end_date"), F.lit(5).alias("max_round"))
    return I.fetch_tasks(events, rounds).select("event_id", F.col("round_number").cast("bigint").alias("round_number"), "round_date", "date_source", "from_date", "to_date")


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN strftime(d, '%Y-%m-%d') ELSE strftime(d + CASE WHEN o_orderkey % 2 = 0 THEN 5 ELSE 0 END, '%Y-%m-%d') END AS start_date,
  CASE WHEN o_orderkey % 4 = 0 THEN strftime(d + 2, '%Y-%m-%d') ELSE strftime(d + 2, '%Y-%m-%d') END AS end_date, o_orderkey % 4 = 0 AS date_repaired FROM (SELECT o_orderkey, cast(o_orderdate AS date) AS d FROM orders)""",
    cte=False,
)
def k10_repair_dates(t):
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    text = lambda x: F.date_format(x, "d-MMM-yyyy")
    raw = F.when(k % 4 == 0, F.concat(text(d), F.lit(" to "), text(F.date_add(d, 2)))).otherwise("to be announced")
    start = F.when(k % 2 == 0, F.date_add(d, 5)).otherwise(d)
    events = t.table("orders").select(k, start.cast("string").alias("start_date"), F.date_add(d, 2).cast("string").alias("end_date"), raw.alias("raw_date_str"))
    return I.repair_dates(events).select("o_orderkey", "start_date", "end_date", "date_repaired")


@query(
    """SELECT event_id, CASE WHEN outcome = 'updated' THEN new_raw ELSE raw END AS location_raw, CASE WHEN outcome = 'updated' THEN new_city ELSE city END AS city, CASE WHEN outcome = 'updated' THEN 'A' ELSE state END AS state, CASE WHEN outcome = 'updated' THEN 'US' ELSE country END AS country, outcome
FROM (SELECT *, CASE WHEN k % 5 = 0 THEN 'missing_page' WHEN new_raw = '' THEN 'missing_location' WHEN raw = new_raw AND city = new_city AND state = 'A' AND country = 'US' THEN 'unchanged' ELSE 'updated' END AS outcome
  FROM (SELECT c_custkey AS event_id, c_custkey AS k, c_mktsegment AS city, CASE WHEN c_custkey % 6 = 0 THEN '' ELSE 'A' END AS state, CASE WHEN c_custkey % 13 = 0 THEN '' ELSE 'US' END AS country, concat(c_mktsegment, ', A') AS raw,
    CASE WHEN c_custkey % 2 = 0 THEN 'X' ELSE c_mktsegment END AS new_city, CASE WHEN c_custkey % 5 = 1 THEN '' WHEN c_custkey % 3 = 0 THEN concat(c_mktsegment, ',  A') ELSE concat(c_mktsegment, ', A') END AS new_raw FROM customer))""",
    cte=False,
)
def k11_backfill_locations(t):
    k, c, town = F.col("c_custkey"), t.table("customer"), F.col("c_mktsegment")
    raw = F.concat(town, F.lit(", A"))
    events = c.select(k.alias("event_id"), raw.alias("location_raw"), town.alias("city"), F.when(k % 6 != 0, "A").alias("state"), F.when(k % 13 != 0, "US").alias("country"))
    parsed = c.where("c_custkey % 5 != 0").select(
        k.alias("event_id"), F.when(k % 5 == 1, "").when(k % 3 == 0, F.concat(town, F.lit(",  A"))).otherwise(raw).alias("location_raw"), F.when(k % 2 == 0, "X").otherwise(town).alias("city"), F.lit("A").alias("state"), F.lit("US").alias("country")
    )
    return I.backfill_locations(events, parsed)


@query("SELECT tourn_id, count(*) AS rounds, round(avg(cast(actual_round_strokes AS decimal(18,6))), 2) AS mean_strokes, CASE WHEN max(CASE WHEN precip_sum > 0 THEN 1 ELSE 0 END) = 1 THEN 'Yes' ELSE 'No' END AS wet, cast(cast(min(round_number) AS bigint) AS varchar) AS start_date, cast(cast(max(round_number) AS bigint) AS varchar) AS end_date FROM rounds GROUP BY tourn_id")
def b55_event_detail_view(t):
    d = t.rounds.withColumn("wet", F.coalesce(F.col("precip_sum") > 0, F.lit(False)))
    return I.event_detail_view(d, ["tourn_id"], {"actual_round_strokes": "mean_strokes"}, "wet", "round_number")


def _unescaped_sql(text: str) -> str:
    """pages.unescaped: entities by number, then by name in the same order, & last. Halves of surrogate pairs are question marks, as Spark writes them."""
    for pattern, before, code in ((r"&#(\d{1,6});", "&#", "cast(x AS int)"), (r"&#x([0-9A-Fa-f]{1,5});", "&#x", "cast(concat('0x', x) AS int)")):
        char = f"CASE WHEN {code} BETWEEN 55296 AND 57343 THEN chr(63) ELSE chr({code}) END"
        text = f"list_reduce(list_prepend({text}, list_distinct(regexp_extract_all({text}, '{pattern}', 1))), lambda t, x: replace(t, concat('{before}', x, ';'), {char}))"
    for name, char in G.ENTITIES.items():
        text = f"replace({text}, '&{name};', '{char.replace(chr(39), chr(39) * 2)}')"
    return text


@query(
    f"""SELECT page_id, trim(regexp_replace({_unescaped_sql("regexp_replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '<[/!?A-Za-z][^>]*>', ' ', 'g')")}, '[\\t\\n\\x0B\\f\\r ]+', ' ', 'g')) AS name, cast(date '2025-04-01' + cast(page_id % 30 AS integer) AS varchar) AS start_date, 1 + page_id % 4 AS rounds,
  CASE WHEN page_id % 5 = 0 THEN NULL ELSE 2 + page_id % 3 END AS women_rounds, CASE WHEN page_id % 7 = 0 THEN '' ELSE 'Official' END AS status_text, CASE WHEN page_id % 2 = 0 THEN 'TX' ELSE '' END AS state FROM pages""",
    cte=False,
)
def b43_b44_event_pages(t):
    """Pages with an event's elements before their own: headings, tables after them, items and lines. Also B46."""
    k = F.col("page_id")
    n = lambda c: c.cast("string")
    table = lambda last: F.concat(F.lit("<table class=r><tr><th>Player</th><th>Rd1</th><th>Rd"), n(last), F.lit("</th></tr><tr><td>Rd9</td></tr></table>"))
    event = F.concat(
        F.when(k % 3 == 0, "<p>Dates: ").otherwise("<li class='tournament-date'>Dates: "), F.date_format(F.date_add(F.lit("2025-04-01").cast("date"), (k % 30).cast("int")), "dd-MMM-yyyy"), F.when(k % 3 == 0, "</p>").otherwise("</li>"),
        F.when(k % 7 == 0, "").otherwise("<table><tr><td class='status'>Official</td></tr></table>"), F.when(k % 2 == 0, "<p>Location: Austin, TX, United States</p>").otherwise("<p>Location</p><p>Paris, France</p>"),
        F.lit("<h2>MPO · Open</h2>"), table(1 + k % 4), F.lit("<h2>FPO &middot; Women</h2>"), F.when(k % 5 == 0, "<table><tr><th>none</th></tr></table>").otherwise(table(2 + k % 3)),
    )
    got = G.parse_pages(t.table("pages").select("page_id", F.concat(event, "html").alias("html")))
    rounds = lambda code: F.try_element_at("division_rounds", F.lit(code)).cast("bigint")
    return got.select("page_id", "name", "start_date", rounds("MPO").alias("rounds"), rounds("FPO").alias("women_rounds"), "status_text", "state")


@query("SELECT tourn_id, round_number, hole_number, player_key FROM holes")
def g03_sorted_outputs(t):
    return I.sort_keys(t.holes.select(*HOLE_KEYS), HOLE_KEYS)


# --- snapshots, scans and the layer run


@query("SELECT c_custkey AS event_id, max(o_orderkey) AS key FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey", cte=False)
def a02_latest_snapshots(t):
    from ..sources.files import latest_snapshots

    d = t.table("orders").select(F.col("o_custkey").alias("event_id"), F.col("o_orderkey").alias("key"))
    return latest_snapshots(d.join(t.table("customer").select(F.col("c_custkey").alias("event_id")), "event_id"), ["event_id"]).select("event_id", "key")


@query("SELECT o_orderkey, make_timestamp(CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE cast(epoch_us(cast(o_orderdate AS timestamp)) + 3661000000 AS bigint) END) AS ts, CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 12) * 3600 + 43200 + 300 ELSE (o_orderkey % 24) * 3600 + 300 END AS seconds FROM orders", cte=False)
def b05_b06_times(t):
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(k % 3 == 0, F.concat(day, F.lit(" soon"))).when(k % 3 == 1, F.concat(day, F.lit("T01:01:01Z"))).otherwise(F.concat(day, F.lit(" 01:01:01")))
    hour = F.when(k % 12 == 0, 12).otherwise(k % 12)
    clock = F.when(k % 2 == 0, F.concat(hour.cast("string"), F.lit(":05 pm"))).otherwise(F.concat((k % 24).cast("string"), F.lit(":05")))
    d = t.table("orders").select(k, text.alias("text"), clock.alias("clock"))
    return d.select("o_orderkey", S.parse_ts("text").alias("ts"), S.clock_seconds("clock").cast("bigint").alias("seconds"))


@query("SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END, CASE WHEN c_custkey % 2 = 0 THEN c_name END) AS picked FROM customer", cte=False)
def b50_alias_coalesce(t):
    k = F.col("c_custkey")
    d = t.table("customer").select(k, F.when(k % 3 == 0, F.col("c_mktsegment")).alias("segment"), F.when(k % 2 == 0, F.col("c_name")).alias("name"))
    return d.select("c_custkey", S.first_present(d.columns, ["absent", "segment", "name"]).alias("picked"))


@query("SELECT s_suppkey, city, CASE WHEN s_suppkey % 3 = 0 THEN 'ST' WHEN s_suppkey % 3 = 1 THEN 'CA' ELSE '' END AS state, CASE WHEN s_suppkey % 3 = 0 THEN n_name WHEN s_suppkey % 3 = 1 THEN '' ELSE n_name END AS country FROM (SELECT s_suppkey, replace(s_name, '#', ' ') AS city, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)", cte=False)
def b45_split_location(t):
    k, city = F.col("s_suppkey"), F.regexp_replace("s_name", "#", "  ")
    text = F.when(k % 3 == 0, F.concat_ws(" , ", city, F.lit("ST"), "n_name")).when(k % 3 == 1, F.concat(city, F.lit(",CA"))).otherwise(F.concat_ws(", ", city, "n_name"))
    d = t.table("supplier").join(t.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(k, N.split_location(text).alias("l"))
    return d.select("s_suppkey", "l.city", "l.state", "l.country")


@query("SELECT o_orderkey, cast(d AS date) AS start_date, cast(d + 2 AS date) AS end_date FROM (SELECT o_orderkey, cast(o_orderdate AS date) AS d FROM orders)", cte=False)
def b42_date_range(t):
    d, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey")
    end = F.date_add(d, 2)
    first = F.when(k % 2 == 0, F.date_format(d, "dd-MMM")).otherwise(F.date_format(d, "d-MMM-yyyy"))
    x = t.table("orders").select(k, N.parse_date_range(F.concat(first, F.lit("  to "), F.date_format(end, "dd-MMM-yyyy"))).alias("r"))
    return x.select("o_orderkey", "r.start_date", "r.end_date")


@query("SELECT o_orderkey, l_linenumber AS hole_number, cast(l_quantity AS integer) AS hole_score FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderkey % 5 != 0", cte=False)
def c01_c04_explode_scores(t):
    line = F.struct(F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("int").alias("q"))
    per = t.table("lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["q"].cast("string")).alias("q"), F.array_sort(F.collect_list("l_linenumber")).alias("lines"))
    payload = F.when(F.col("l_orderkey") % 5 == 0, "no json").otherwise(F.to_json(F.struct(F.struct(F.array(F.struct(F.lit("A").alias("Name"), F.array_join("q", ",").alias("Scores"))).alias("scores")).alias("data"))))
    snaps = per.select(F.col("l_orderkey").alias("event_id"), "lines", payload.alias("payload"))
    d = N.explode_scores(snaps).select(F.col("event_id").alias("o_orderkey"), "lines", F.posexplode(N.hole_scores(F.col("s"), F.lit(None).cast("int"))).alias("i", "hole_score"))
    return d.select("o_orderkey", F.element_at("lines", F.col("i") + 1).alias("hole_number"), "hole_score")


@query("SELECT tourn_id, hour, count(*) AS n, round(avg(cast(v AS decimal(18,6))), 4) AS mean_wind FROM (SELECT user_id % 37 AS tourn_id, cast(date_trunc('hour', ts) AS varchar) AS hour, round(value, 3) AS v FROM events) GROUP BY ALL", cte=False)
def c06_l03_hourly_arrays(t):
    e = t.table("events").select((F.col("user_id") % 37).alias("event_id"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm").alias("time"), F.round("value", 3).cast("string").alias("v"), F.col("event_id").alias("k"))
    hours = e.groupBy("event_id", F.pmod("k", F.lit(50)).alias("part")).agg(F.sort_array(F.collect_list(F.struct("k", "time", "v"))).alias("x"))
    hourly = F.struct(F.col("x.time").alias("time"), F.col("x.v").alias("wind_speed_10m"))
    snaps = hours.select("event_id", F.lit(1).alias("round_number"), F.lit("p").alias("provider"), F.lit("s").alias("source_id"), F.to_json(F.struct(F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), hourly.alias("hourly"))).alias("payload"))
    w = N.normalize_weather(snaps).withColumn("hour", F.date_trunc("hour", "observation_hour").cast("string"))
    return w.groupBy(F.col("event_id").alias("tourn_id"), "hour").agg(F.count("*").alias("n"), R.mean4("wind_speed_mps").alias("mean_wind"))


_PLAYER = "cast(substr(player_key, 6) AS bigint)"


@query(
    f"""SELECT tourn_id, round_number, CASE WHEN k % 7 = 0 THEN concat('RESULT#', k + 1) ELSE concat('PDGA#', k + 1) END AS player_key, hole_number, cast(hole_score AS bigint) AS hole_score, 3 + hole_number % 3 AS hole_par, 100 + 10 * hole_number AS hole_length,
  cast(hole_score - 3 - hole_number % 3 AS bigint) AS hole_to_par, division, concat('Course ', course_id) AS course_name, cast(2024 AS bigint) AS event_year, cast(date '2024-05-03' + cast(tourn_id % 5 AS integer) + cast((round_number - 1) * 2 // 3 AS integer) AS varchar) AS round_date,
  CASE WHEN k % 3 = 0 THEN 'raw_tee_time_no_score_ts' ELSE 'missing_inputs' END AS start_method, CASE WHEN k % 3 = 0 THEN 'round_date_interp_plus_raw_tee' ELSE 'round_date_interp_noon_fallback' END AS join_method
FROM (SELECT *, {_PLAYER} AS k FROM holes)"""
)
def l02_scores_layer(t):
    """Rounds are written as live-score payloads, one for each, and read back to rounds and holes. Also B31 to B33, B35, C01 to C05,
    C08 and E03."""
    k = F.expr(_PLAYER)
    text = lambda c: c.cast("string")
    scores = F.map_from_entries(F.collect_list(F.struct("hole_number", "hole_score")))
    d = t.holes.groupBy(*ROUND_KEYS, "division", "course_id", "layout_id").agg(scores.alias("by_hole"), F.max("hole_number").alias("last"))
    holes = F.transform(F.sequence(F.lit(1), F.col("last").cast("int")), lambda i: i.cast("bigint"))
    score = F.struct(
        F.when(k % 7 == 0, "").otherwise(text(k + 1)).alias("PDGANum"), text(k + 1).alias("ResultID"), text(F.col("round_number")).alias("Round"), text(F.col("layout_id")).alias("LayoutID"), F.lit("Player").alias("Name"),
        F.when(k % 3 == 0, "9:30 AM").otherwise("").alias("TeeTime"), F.transform(holes, lambda i: F.coalesce(text(F.try_element_at("by_hole", i)), F.lit(""))).alias("HoleScores"),
    )
    detail = F.transform(holes, lambda i: F.struct(text(i).alias("Ordinal"), text(3 + i % 3).alias("Par"), text(100 + 10 * i).alias("Length")))
    layout = F.struct(text(F.col("layout_id")).alias("LayoutID"), F.concat(F.lit("Course "), text(F.col("course_id"))).alias("CourseName"), detail.alias("Detail"))
    payload = F.to_json(F.struct(F.struct(F.array(score).alias("scores"), F.array(layout).alias("layouts")).alias("data")))
    snapshots = Z.stored(d.select(F.col("tourn_id").alias("event_id"), "division", F.col("round_number").cast("int").alias("round_number"), payload.alias("payload")))
    start = F.date_add(F.lit("2024-05-03").cast("date"), (F.col("event_id") % 5).cast("int"))
    none = F.lit("")
    events = snapshots.select("event_id").distinct().select(
        "event_id", none.alias("name"), none.alias("status_text"), start.cast("string").alias("start_date"), F.date_add(start, 2).cast("string").alias("end_date"), none.alias("city"), none.alias("state"), none.alias("country"), F.create_map(F.lit("all"), F.lit(4)).alias("division_rounds")
    )
    out = N.normalize_holes(N.normalize_rounds(snapshots, Z.stored(events)))
    whole = lambda *names: [F.col(c).cast("bigint").alias(c) for c in names]
    return out.select(
        "tourn_id", *whole("round_number", "hole_number", "hole_score", "hole_par", "hole_length", "hole_to_par", "event_year"), "player_key", "division", "course_name", F.col("round_date").cast("string").alias("round_date"),
        F.col("tee_time_est_method").alias("start_method"), F.col("tee_time_join_method").alias("join_method"),
    )


@query("SELECT o_custkey AS event_id, CASE WHEN o_orderstatus = 'F' THEN 'FINAL' ELSE 'OPEN' END AS division, unnest(range(1, 1 + greatest(1, max(o_orderkey % 4)))) AS round_number FROM orders GROUP BY 1, 2", cte=False)
def c07_expand_tasks(t):
    d = t.table("orders").select(F.col("o_custkey").alias("event_id"), F.when(F.col("o_orderstatus") == "F", "FINAL").otherwise("OPEN").alias("division"), (F.col("o_orderkey") % 4).cast("int").alias("n"))
    per = d.groupBy("event_id", "division").agg(F.max("n").alias("n")).groupBy("event_id").agg(F.map_from_entries(F.collect_list(F.struct("division", "n"))).alias("division_rounds"))
    return N.expand_tasks(per).select("event_id", "division", F.col("round_number").cast("bigint").alias("round_number"))


# --- effects of a model


@query(
    """, w AS (SELECT unnest([0.0, 5.0, 10.0, 15.0])::double AS x), d AS (SELECT x, 0.15 * x + 0.002 * x * (player_rating - 900) - 0.0 AS e FROM rounds, w)
SELECT x, count(*) AS n, round(avg(cast(e AS decimal(18,6))), 4) AS mean, round(quantile_cont(e, 0.5), 4) AS median, round(stddev_pop(e), 4) AS std, round(quantile_cont(e, 0.1), 4) AS p10, round(quantile_cont(e, 0.9), 4) AS p90 FROM d GROUP BY x"""
)
def f40_effect_curve(t):
    y = lambda wind: 0.15 * wind + 0.002 * wind * (F.col("player_rating") - 900)
    return M.effect_curve(t.rounds, {float(x): y(F.lit(float(x))) - y(F.lit(0.0)) for x in (0, 5, 10, 15)})


@query(
    """, p AS (SELECT course_id, 0.15 * 10.5 + 0.002 * 10.5 * (player_rating - 900) AS e FROM rounds), c AS (SELECT course_id, count(*) AS n, avg(cast(e AS decimal(18,6))) AS m, quantile_cont(e, 0.5) AS q FROM p GROUP BY course_id)
SELECT course_id, n, round(m, 4) AS mean_effect, round(q, 4) AS median_effect FROM c QUALIFY row_number() OVER (ORDER BY round(m, 4) DESC, course_id) <= 5 OR row_number() OVER (ORDER BY round(m, 4), course_id) <= 5"""
)
def f44_course_response(t):
    return M.course_response(t.rounds.withColumn("e", 0.15 * 10.5 + 0.002 * 10.5 * (F.col("player_rating") - 900)), "course_id", "e", 5).select("course_id", "n", "mean_effect", "median_effect")


def _trees(t):
    """Rounds, and trees fitted to them that never fall with wind and gust."""
    rounds = Z.stored(t.rounds.dropna(subset=M.NUMERIC).select(*dict.fromkeys([*ROUND_KEYS, "course_id", *M.NUMERIC, *M.CATEGORICAL, M.TARGET])))
    model, _ = B.train_monotone(rounds, M.NUMERIC, M.CATEGORICAL, M.TARGET, {"wind_mean": 1, "gust_mean": 1}, trees=12, depth=3, rate=0.3)
    return rounds, model


def j07_round_model(t):
    """Counterfactual scores of monotone trees that are fitted here; no SQL trains trees."""
    rounds, model = _trees(t)
    scored = M.score_rounds(rounds, model)
    return scored.select(*ROUND_KEYS, *r4("predicted", "predicted_wind_reference", "wind_impact", "total_impact"))


def f40_model_effect_pdp(t):
    """Wind's effect against no wind over a grid, by the fitted trees; gusts are not below the wind."""
    rounds, model = _trees(t)
    actual = lambda x: {"wind_mean": x, "gust_mean": F.greatest(F.col("gust_mean"), F.lit(x))}
    return X.effect_pdp(rounds, model, [0.0, 1.5, 3.0, 4.5, 6.0, 9.0, 12.0], actual, lambda x: {"wind_mean": 0.0, "gust_mean": 0.447}, ROUND_KEYS)


def f39_model_pdp(t):
    """Mean predictions of the fitted trees over a grid of winds."""
    rounds, model = _trees(t)
    return X.pdp_curve(rounds, model, "wind_mean", [0.0, 1.5, 3.0, 4.5, 6.0, 9.0, 12.0])


def f44_model_course_response(t):
    """Each course's response to 10.5 mph of wind and to 60 F, by the fitted trees, against no wind and 80 F."""
    rounds, model = _trees(t)
    reference = {"wind_mean": 0.0, "temp_mean": 26.6667}
    shifts = {"wind_10_5_mph": reference | {"wind_mean": 10.5 / 2.23694}, "temp_60_f": reference | {"temp_mean": 15.5556}}
    return X.course_response(rounds, model, "course_id", reference, shifts, {"observed_wind": "wind_mean", "observed_temp": "temp_mean"}, ROUND_KEYS)


for _f in (f39_model_pdp, f40_model_effect_pdp, f44_model_course_response):
    query()(_f)
query()(j07_round_model)
