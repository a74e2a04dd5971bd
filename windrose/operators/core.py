"""Relational operators: newest-wins dedup, weather joins, features, holes to rounds, set checks, state and ledgers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

#: weather measures that are joined to play
MEASURES = ["wind_speed_mps", "wind_gust_mps", "wind_dir_deg", "temperature_c", "pressure_hpa", "humidity_pct", "precip_mm"]


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key: the first in order. Ties are broken by the order given, so make it total."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def latest_by_struct(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: the largest by a tuple of columns. Partial aggregation keeps hot keys small before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, "__best.*")


def enrich(play: DataFrame, weather: DataFrame, keys: Sequence[str] = ("tourn_id", "obs_hour"), measures: Sequence[str] = tuple(MEASURES)) -> DataFrame:
    """Play with the weather of its hour; every row of play stays, with wx_missing. weather has one row for each key."""
    right = weather.select(*keys, *measures, F.lit(True).alias("__found"))
    return play.join(right, list(keys), "left").withColumn("wx_missing", F.col("__found").isNull()).drop("__found")


def resolve_obs_hour(columns: Sequence[str], candidates: Sequence[str], date: str | None = None) -> Column:
    """Hour of the first candidate time that is there, else noon of the date."""
    hours = [S.floor_hour(F.col(c).cast("timestamp")) for c in candidates if c in columns]
    if date and date in columns:
        hours.append(S.noon(S.parse_date(date)).cast("timestamp"))
    return F.coalesce(*hours) if hours else F.lit(None).cast("timestamp")


def build_features(df: DataFrame, grain: str, version: str = "v1") -> DataFrame:
    """Adds grain, version, availability, buckets and strokes over par."""
    out = df.withColumns(
        {
            "feature_grain": F.lit(grain),
            "feature_version": F.lit(version),
            "weather_available": S.weather_available("wx_missing"),
            "wind_bucket": S.wind_bucket("wind_speed_mps"),
            "gust_bucket": S.gust_bucket("wind_gust_mps"),
            "wind_sector": S.wind_sector("wind_dir_deg"),
        }
    )
    return out.withColumn("strokes_over_par", F.col("hole_score") - F.col("hole_par")) if grain == "hole" else out


def dmean(c) -> Column:
    """Mean through decimals, which does not depend on the order of rows."""
    return F.avg(S.col(c).cast("decimal(18,6)")).cast("double")


def round_model_inputs(holes: DataFrame, keys: Sequence[str] = ("event_year", "tourn_id", "round_number", "player_key"), attributes: Sequence[str] = ("division", "state", "course_id", "layout_id", "player_rating")) -> DataFrame:
    """Holes to rounds: sums, means per distinct hole, weather means and maxima. An attribute is the first non-null by
    hole number read as text."""
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("hole_number").cast("string"))).alias(c)
    # different holes are counted where their first rows are: rows that lie in order by round are aggregated as they come
    before = F.lag("hole_number").over(Window.partitionBy(*keys).orderBy("hole_number"))
    holes = holes.withColumn("__new", F.col("hole_number").isNotNull() & ~F.col("hole_number").eqNullSafe(before))
    out = holes.groupBy(*keys).agg(
        *(first(a) for a in attributes),
        F.sum("hole_score").cast("bigint").alias("actual_round_strokes"),
        F.sum(F.col("hole_score") - F.col("hole_par")).cast("bigint").alias("round_strokes_over_par"),
        F.count_if("__new").alias("hole_count"),
        F.sum("hole_length").alias("round_total_hole_length"),
        F.sum("hole_par").cast("bigint").alias("round_total_par"),
        dmean("wind_speed_mps").alias("wind_mean"),
        F.max("wind_speed_mps").alias("wind_max"),
        dmean("wind_gust_mps").alias("gust_mean"),
        F.max("wind_gust_mps").alias("gust_max"),
        dmean("temperature_c").alias("temp_mean"),
        dmean("pressure_hpa").alias("pressure_mean"),
        dmean("humidity_pct").alias("humidity_mean"),
        F.sum("precip_mm").cast("bigint").alias("precip_sum"),
        dmean("precip_mm").alias("precip_mean"),
        F.coalesce(F.bool_and(S.weather_available("wx_missing")), F.lit(False)).alias("weather_available"),
    )
    length, par, n = F.col("round_total_hole_length"), F.col("round_total_par"), F.col("hole_count")
    return out.withColumns(
        {
            "round_avg_hole_length": length / F.nullif(n, F.lit(0)),
            "round_avg_hole_par": par / F.nullif(n, F.lit(0)),
            "round_length_over_par": length / F.nullif(par, F.lit(0)),
            "wind_bucket": S.wind_bucket("wind_mean"),
            "gust_bucket": S.gust_bucket("gust_mean"),
        }
    )


# --- set operations on keys


def missing_keys(expected: DataFrame, got: DataFrame, keys: Sequence[str]) -> DataFrame:
    return expected.select(*keys).distinct().join(got.select(*keys).distinct(), list(keys), "left_anti")


def common_keys(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


def key_differences(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of either side only, with the side; none if both sets are equal. Each side is read once; null is a key like others."""
    # each side is dealt by itself: no task holds what makes both
    left, right = (d.select(*keys, F.lit(is_left).alias("__left")).repartition(*keys) for d, is_left in ((a, True), (b, False)))
    both = left.unionByName(right)
    sides = both.groupBy(*keys).agg(F.bool_or("__left").alias("__l"), F.bool_or(~F.col("__left")).alias("__r"))
    return sides.where("__l != __r").select(*keys, F.when(F.col("__l"), "left").otherwise("right").alias("side"))


def orphans(children: DataFrame, parents: DataFrame, keys: Sequence[str]) -> DataFrame:
    return children.join(parents.select(*keys), list(keys), "left_anti")


def mark_present(df: DataFrame, state: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """df with a flag: state has a row for the key."""
    seen = state.select(*keys).distinct().withColumn("__seen", F.lit(True))
    return df.join(seen, list(keys), "left").withColumn(flag, F.coalesce("__seen", F.lit(False))).drop("__seen")


# --- incremental runs


def ledger_state(ledger: DataFrame) -> DataFrame:
    """The newest row of each (pipeline, event) of an append-only ledger."""
    return latest_by_struct(ledger, ["pipeline", "event_id"], ["updated_at", "status"])


def pending(events: DataFrame, state: DataFrame, retry_failed: bool = True, retry_quarantined: bool = False) -> DataFrame:
    """Events to run: without a row, with a blank or unknown status, successes without fingerprint, failures by flags."""
    known = state.select("event_id", F.lower(S.norm_text("status")).alias("__status"), S.norm_text("fingerprint").alias("__print"))
    status, blank = F.coalesce("__status", F.lit("")), F.coalesce("__print", F.lit("")) == ""
    run = (
        F.when(status == "success", blank)
        .when(status == "failed", F.lit(retry_failed))
        .when(status == "dq_failed", F.lit(retry_quarantined))
        .otherwise(F.lit(True))
    )
    return events.join(known, "event_id", "left").where(run).drop("__status", "__print")


def changed_only(events: DataFrame, state: DataFrame) -> DataFrame:
    """Events (event_id, fingerprint) that were not run successfully with this fingerprint."""
    done = state.where(F.lower("status") == "success").select("event_id", "fingerprint")
    return events.join(done, ["event_id", "fingerprint"], "left_anti")


def change_type(new: DataFrame, old: DataFrame, key: str, hash_col: str) -> DataFrame:
    """new with change: new, updated or unchanged."""
    before = old.select(key, F.col(hash_col).alias("__before"))
    change = F.when(F.col("__before").isNull(), "new").when(F.col("__before") != F.col(hash_col), "updated").otherwise("unchanged")
    return new.join(before, key, "left").withColumn("change", change).drop("__before")


def merge_state(state: DataFrame, batch: DataFrame) -> DataFrame:
    """State (key, content, pointer, first_seen, last_fetched, failures) after a batch (key, content, pointer, seen_at, ok).

    New content wins; a blank pointer keeps the old one; first_seen stays; a failure only adds to the count of a key that
    is known, and a success resets it.
    """
    b = batch.select("key", *(F.col(c).alias(f"b_{c}") for c in ("content", "pointer", "seen_at", "ok")))
    joined = state.join(b, "key", "full")
    ok, known = F.coalesce("b_ok", F.lit(False)), F.col("first_seen").isNotNull()
    return joined.where(known | ok).select(
        "key",
        F.when(ok, F.coalesce("b_content", "content")).otherwise(F.col("content")).alias("content"),
        F.when(ok & (S.norm_text("b_pointer") != ""), F.col("b_pointer")).otherwise(F.col("pointer")).alias("pointer"),
        F.least("first_seen", F.when(ok, F.col("b_seen_at"))).alias("first_seen"),
        F.when(ok, F.col("b_seen_at")).otherwise(F.col("last_fetched")).alias("last_fetched"),
        F.when(ok, 0).when(F.col("b_ok").isNotNull(), F.coalesce("failures", F.lit(0)) + 1).otherwise(F.coalesce("failures", F.lit(0))).cast("bigint").alias("failures"),
    )


def event_fingerprint(df: DataFrame, key: str, columns: Sequence[str], version: str) -> DataFrame:
    """A sha256 for each key over the rows, whatever their order: of their number and of sums of parts of each row's own
    hash, so no task holds the rows of a key."""
    row = F.sha2(F.concat_ws("|", *(S.norm_text(c) for c in columns)), 256)
    sums = [F.sum(F.conv(F.substring("__h", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).cast("string") for i in range(4)]
    return df.withColumn("__h", row).groupBy(key).agg(F.sha2(F.concat_ws("|", F.lit(version), F.count("*").cast("string"), *sums), 256).alias("fingerprint"))
