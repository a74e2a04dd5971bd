"""The sample tables, shaped like scored play and hourly weather: line items are holes, orders rounds, customers players,
events hourly weather. Hours are numbers from 0 to 719."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import core, reports

HOLE_KEYS = ["tourn_id", "round_number", "hole_number", "player_key"]
#: the same keys, in the order in which rounds are put together; an event has one year
SORTED_KEYS = ["event_year", "tourn_id", "round_number", "player_key", "hole_number"]
#: lines that one task joins, sorts and groups
LINES = 500_000


class Tables:
    """DataFrames over one folder of tables; each is a plan, read when an action runs. Only the number of lines is asked for
    before: files' footers tell it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def tasks(self) -> int:
        """Tasks that lines are dealt to: as many more as there are more lines. 0: they are few, and Spark deals them."""
        tasks = -(-self.table("lineitem").count() // LINES)
        return tasks if tasks > self.spark.sparkContext.defaultParallelism else 0

    def dealt(self, df: DataFrame, key: str) -> DataFrame:
        return df.repartition(self.tasks, key) if self.tasks else df

    @property
    def holes_raw(self) -> DataFrame:
        """Players are joined last, by their key: all that holes and rounds are grouped by later lies with its player, so neither
        the newest holes nor the rounds are shuffled again. Many lines are dealt to so many tasks that what one of them sorts
        does not grow with the tables."""
        key = lambda c: F.concat(F.lit("PDGA#"), F.col(c).cast("string")).alias("player_key")
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("hole_number"), (3 + F.col("l_partkey") % 3).alias("hole_par"),
            (2 + F.col("l_quantity").cast("bigint") % 5).alias("hole_score"), (150 + F.col("l_partkey") % 600).cast("double").alias("hole_length"),
            F.col("l_shipdate").alias("fetched_at"), F.col("l_suppkey").alias("src"), F.col("l_extendedprice").alias("px"),
        )
        players = self.table("customer").join(F.broadcast(self.table("nation")), F.col("c_nationkey") == F.col("n_nationkey"))
        players = players.select(key("c_custkey"), F.col("c_mktsegment").alias("division"), F.col("n_name").alias("state"), (800 + F.col("c_custkey") % 250).alias("player_rating"))
        orders = self.dealt(self.table("orders").select("o_orderkey", "o_custkey"), "o_orderkey")
        if self.tasks:
            orders = orders.hint("shuffle_hash")
        played = self.dealt(lines, "o_orderkey").join(orders, "o_orderkey").select(key("o_custkey"), *lines.columns)
        tourn = F.col("o_orderkey") % 37
        # a task's players are few beside their holes: the holes need no sorting for this join
        return self.dealt(played, "player_key").join(self.dealt(players, "player_key").hint("shuffle_hash"), "player_key").select(
            tourn.alias("tourn_id"), (1 + F.col("o_orderkey") % 4).alias("round_number"), "hole_number", "player_key", "division", "state",
            (2020 + tourn % 5).alias("event_year"), (tourn % 25).alias("course_id"), (tourn % 11).alias("layout_id"),
            "hole_par", "hole_score", "hole_length", "player_rating", (F.col("o_orderkey") % 720).alias("obs_hour"), "fetched_at", "src", "px",
        )

    @property
    def holes(self) -> DataFrame:
        return core.dedup_latest(self.holes_raw, SORTED_KEYS, [F.col(c).desc() for c in ("fetched_at", "src", "px", "obs_hour")])

    @property
    def wx_raw(self) -> DataFrame:
        e, i = self.table("events"), F.col("event_id")
        return e.select(
            (F.col("user_id") % 37).alias("tourn_id"), (24 * (F.day("ts") - 1) + F.hour("ts")).cast("bigint").alias("obs_hour"),
            (F.col("value") / 10).alias("wind_speed_mps"), (F.col("value") / 7).alias("wind_gust_mps"), (i % 360).alias("wind_dir_deg"),
            (i % 45 - 5).alias("temperature_c"), (990 + i % 40).alias("pressure_hpa"), (i % 101).alias("humidity_pct"),
            F.when(i % 4 == 0, i % 10).otherwise(0).alias("precip_mm"), "ts", "event_id",
        )

    @property
    def wx(self) -> DataFrame:
        return core.latest_by_struct(self.wx_raw, ["tourn_id", "obs_hour"], ["ts", "event_id"])

    @property
    def enriched(self) -> DataFrame:
        """The weather has at most 37 events x 744 hours, whatever the tables' size, and goes to the holes."""
        return core.enrich(self.holes, F.broadcast(self.wx))

    @property
    def rounds(self) -> DataFrame:
        return core.round_model_inputs(self.enriched)

    @property
    def scored(self) -> DataFrame:
        return reports.with_impacts(self.rounds)

    @property
    def base(self) -> DataFrame:
        return reports.reporting_base(self.scored)


#: The same in DuckDB's SQL.
CTE = """
WITH holes_raw AS (
  SELECT o_orderkey % 37 AS tourn_id, 1 + o_orderkey % 4 AS round_number, l_linenumber AS hole_number,
         concat('PDGA#', cast(o_custkey AS string)) AS player_key, c_mktsegment AS division, n_name AS state,
         2020 + o_orderkey % 37 % 5 AS event_year, o_orderkey % 37 % 25 AS course_id, o_orderkey % 37 % 11 AS layout_id,
         3 + l_partkey % 3 AS hole_par, 2 + cast(l_quantity AS bigint) % 5 AS hole_score,
         cast(150 + l_partkey % 600 AS double) AS hole_length, 800 + o_custkey % 250 AS player_rating,
         o_orderkey % 720 AS obs_hour, l_shipdate AS fetched_at, l_suppkey AS src, l_extendedprice AS px
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey),
holes AS (
  SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY tourn_id, round_number, hole_number, player_key
    ORDER BY fetched_at DESC, src DESC, px DESC, obs_hour DESC) AS rn FROM holes_raw) t WHERE rn = 1),
wx_raw AS (
  SELECT user_id % 37 AS tourn_id, 24 * (extract(day FROM ts) - 1) + extract(hour FROM ts) AS obs_hour,
         value / 10 AS wind_speed_mps, value / 7 AS wind_gust_mps, event_id % 360 AS wind_dir_deg,
         event_id % 45 - 5 AS temperature_c, 990 + event_id % 40 AS pressure_hpa, event_id % 101 AS humidity_pct,
         CASE WHEN event_id % 4 = 0 THEN event_id % 10 ELSE 0 END AS precip_mm, ts, event_id
  FROM events),
wx AS (
  SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY tourn_id, obs_hour ORDER BY ts DESC, event_id DESC) AS rn
    FROM wx_raw) t WHERE rn = 1),
enriched AS (
  SELECT h.*, w.wind_speed_mps, w.wind_gust_mps, w.wind_dir_deg, w.temperature_c, w.pressure_hpa, w.humidity_pct,
         w.precip_mm, w.tourn_id IS NULL AS wx_missing
  FROM holes h LEFT JOIN wx w ON h.tourn_id = w.tourn_id AND h.obs_hour = w.obs_hour),
rounds AS (
  SELECT event_year, tourn_id, round_number, player_key,
         arg_min(division, cast(hole_number AS varchar)) AS division, arg_min(state, cast(hole_number AS varchar)) AS state,
         arg_min(course_id, cast(hole_number AS varchar)) AS course_id, arg_min(layout_id, cast(hole_number AS varchar)) AS layout_id,
         arg_min(player_rating, cast(hole_number AS varchar)) AS player_rating,
         cast(sum(hole_score) AS bigint) AS actual_round_strokes, cast(sum(hole_score - hole_par) AS bigint) AS round_strokes_over_par,
         count(DISTINCT hole_number) AS hole_count, sum(hole_length) AS round_total_hole_length,
         cast(sum(hole_par) AS bigint) AS round_total_par,
         avg(cast(wind_speed_mps AS decimal(18,6))) AS wind_mean, max(wind_speed_mps) AS wind_max,
         avg(cast(wind_gust_mps AS decimal(18,6))) AS gust_mean, max(wind_gust_mps) AS gust_max,
         avg(cast(temperature_c AS decimal(18,6))) AS temp_mean, avg(cast(pressure_hpa AS decimal(18,6))) AS pressure_mean,
         avg(cast(humidity_pct AS decimal(18,6))) AS humidity_mean, cast(sum(precip_mm) AS bigint) AS precip_sum,
         avg(cast(precip_mm AS decimal(18,6))) AS precip_mean, bool_and(NOT wx_missing) AS weather_available
  FROM enriched GROUP BY event_year, tourn_id, round_number, player_key),
scored AS (
  SELECT *, predicted - wind_impact AS predicted_wind_reference, predicted - temperature_impact AS predicted_temperature_reference,
         predicted - total_impact AS predicted_total_reference
  FROM (SELECT *, wind_impact + temperature_impact + precip_impact AS total_impact
        FROM (SELECT *, cast(actual_round_strokes AS double) AS predicted,
                     cast(0.15 AS double) * wind_mean + cast(0.05 AS double) * gust_mean AS wind_impact,
                     cast(0.02 AS double) * (cast(26.6667 AS double) - temp_mean) AS temperature_impact,
                     cast(CASE WHEN precip_sum > 0 THEN 0.3 ELSE 0.0 END AS double) AS precip_impact
              FROM rounds))),
base AS (
  SELECT * REPLACE (coalesce(nullif(trim(division), ''), 'Unknown') AS division, upper(coalesce(nullif(trim(state), ''), 'UNKNOWN')) AS state),
         CASE round_month WHEN 1 THEN 'Jan' WHEN 2 THEN 'Feb' WHEN 3 THEN 'Mar' WHEN 4 THEN 'Apr' WHEN 5 THEN 'May' WHEN 6 THEN 'Jun'
              WHEN 7 THEN 'Jul' WHEN 8 THEN 'Aug' WHEN 9 THEN 'Sep' WHEN 10 THEN 'Oct' WHEN 11 THEN 'Nov' WHEN 12 THEN 'Dec'
              ELSE 'Unknown' END AS round_month_label,
         CASE WHEN observed_temp_f IS NULL THEN 'Unknown' WHEN observed_temp_f < 41 THEN '<41F' WHEN observed_temp_f < 50 THEN '41-49F'
              WHEN observed_temp_f < 60 THEN '50-59F' WHEN observed_temp_f < 70 THEN '60-69F' WHEN observed_temp_f < 80 THEN '70-79F'
              ELSE '80F+' END AS temperature_band_f
  FROM (SELECT *, wind_mean * cast(2.23694 AS double) AS observed_wind_mph, gust_mean * cast(2.23694 AS double) AS observed_wind_gust_mph,
               temp_mean * 9.0 / 5.0 + 32.0 AS observed_temp_f, 1 + tourn_id % 12 AS round_month,
               CASE WHEN player_rating IS NULL THEN 'Unknown' WHEN player_rating < 900 THEN '<900' WHEN player_rating < 940 THEN '900-939'
                    WHEN player_rating < 970 THEN '940-969' ELSE '970+' END AS rating_band,
               CASE WHEN coalesce(precip_sum, 0) > 0 THEN 'Precipitation' ELSE 'No Precipitation' END AS precip_flag,
               CASE WHEN wind_mean IS NULL THEN 'unknown' WHEN wind_mean < 2 THEN 'calm' WHEN wind_mean < 5 THEN 'light'
                    WHEN wind_mean < 8 THEN 'moderate' WHEN wind_mean < 12 THEN 'strong' ELSE 'very_strong' END AS round_wind_speed_bucket
        FROM scored WHERE total_impact IS NOT NULL))
"""
