"""Raw snapshots to typed tables: live scores to rounds and holes, hourly weather arrays to observations.

Payloads are JSON text. All leaves are read as text and converted by tolerant casts, so a bad value is null and never an
error; text that is no JSON gives no rows. Everything is native: from_json, explode and joins on the snapshot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .shared import stored

HOLE = "struct<Ordinal:string,HoleOrdinal:string,Hole:string,Label:string,Par:string,Length:string>"
LAYOUT = f"struct<LayoutID:string,CourseID:string,CourseName:string,Name:string,Holes:string,Par:string,Length:string,Units:string,Detail:array<{HOLE}>>"
#: Text fields of a score, and the columns that they become.
TEXTS = {
    "Name": "player_name", "FirstName": "first_name", "LastName": "last_name", "ShortName": "short_name", "ProfileURL": "profile_url",
    "City": "player_city", "StateProv": "player_state_prov", "Country": "player_country", "FullLocation": "player_full_location",
    "Pool": "pool", "RoundPool": "round_pool", "TeeStart": "tee_start", "TeeTimeSort": "tee_time_sort", "RoundStatus": "round_status",
}
#: Whole-number fields.
INTS = {
    "ScoreID": "score_id", "RoundID": "round_id", "Rating": "player_rating", "CardNum": "card_num", "Played": "played_holes", "RoundScore": "round_score",
    "RoundtoPar": "round_to_par", "RoundRating": "round_rating", "GrandTotal": "grand_total", "ToPar": "to_par_total", "PrevRndTotal": "prev_rnd_total",
    "PrevRounds": "prev_rounds", "RunningPlace": "running_place", "PreviousPlace": "previous_place",
}
#: Flags.
FLAGS = {
    "Completed": "completed_flag", "RoundStarted": "round_started_flag", "HasRoundScore": "has_round_score_flag",
    "Authoritative": "authoritative_flag", "Tied": "tied_flag", "WonPlayoff": "won_playoff_flag",
}
_OTHER = ["Division", "Round", "LayoutID", "PDGANum", "ResultID", "Scores", "Holes", "TeeTime", "ScorecardUpdatedAt", "UpdateDate"]
SCORE = "struct<" + ",".join(f"{n}:string" for n in [*_OTHER, *TEXTS, *INTS, *FLAGS]) + ",HoleScores:array<string>>"
PAYLOAD = f"struct<data:struct<scores:array<{SCORE}>,layouts:array<{LAYOUT}>,holes:array<{HOLE}>>>"


def explode_scores(snapshots: DataFrame) -> DataFrame:
    """A row for each score object of a snapshot (payload: text), with its layouts and holes still nested.

    Empty arrays go by a filter after an outer explode: before a plain one Spark puts a filter of its own, which works out the
    array once more, from the payload on.
    """
    data = F.from_json("payload", PAYLOAD).getField("data")
    rows = snapshots.withColumn("d", data).drop("payload")
    return rows.select(*[c for c in rows.columns if c != "d"], F.col("d.layouts").alias("layouts"), F.col("d.holes").alias("spare_holes"), F.explode_outer("d.scores").alias("s")).where("s is not null")


def _last(items: Column, match) -> Column:
    """The last item of an array that matches; null if none."""
    return F.try_element_at(F.filter(items, match), F.lit(-1))


def _ordinal(hole: Column) -> Column:
    return F.coalesce(S.to_int(hole["Ordinal"]), S.to_int(hole["HoleOrdinal"]))


def hole_scores(score: Column, layout_holes: Column) -> Column:
    """Scores by hole: the list, else the comma-separated text; cut to the layout, nulls at the end trimmed."""
    text = S.norm_text(score["Scores"])
    listed = F.when(F.size(score["HoleScores"]) > 0, score["HoleScores"]).when(text != "", F.split(text, ",")).otherwise(F.array().cast("array<string>"))
    parsed = F.transform(listed, S.to_int)
    cut = F.when((layout_holes > 0) & (F.size(parsed) > layout_holes), F.slice(parsed, 1, layout_holes.cast("int"))).otherwise(parsed)
    filled = F.array_max(F.transform(cut, lambda x, i: F.when(x.isNotNull(), i + 1)))
    return F.slice(cut, 1, F.coalesce(filled, F.lit(0)))


def max_rounds(scores: DataFrame, events: DataFrame) -> DataFrame:
    """(event_id, max_round): the largest round of an event's map of divisions, of its sources and of its scores; 1 at least.

    scores: explode_scores' rows, with event_id and round_number. Events with neither scores nor a map have 1.
    """
    seen = scores.groupBy("event_id").agg(F.greatest(F.max("round_number"), F.max(S.to_int("s.Round"))).alias("__seen"))
    mapped = events.select("event_id", F.array_max(F.map_values("division_rounds")).alias("__mapped"))
    return seen.join(mapped, "event_id", "full").select("event_id", F.greatest("__seen", "__mapped", F.lit(1)).cast("int").alias("max_round"))


def normalize_rounds(snapshots: DataFrame, events: DataFrame) -> DataFrame:
    """A row for each player and round. snapshots: event_id, division, round_number, payload and lineage. events:
    event_id, name, status_text, start_date, end_date, city, state, country, division_rounds (map)."""
    scores = explode_scores(snapshots)
    number = F.coalesce(F.nullif(S.to_int("s.Round"), F.lit(0)), F.col("round_number"))
    scores = scores.withColumn("__round", number)
    # the largest round of an event: of its map, its sources and its scores
    most = stored(max_rounds(scores, events).select("event_id", "max_round"))  # a row for each event: few are sent to the scores
    meta = events.select(
        "event_id", S.norm_text("name").alias("event_name"), S.norm_text("status_text").alias("event_status_text"), S.norm_text("start_date").alias("event_start_date"),
        S.norm_text("end_date").alias("event_end_date"), S.norm_text("city").alias("event_city"), S.norm_text("state").alias("event_state"), S.norm_text("country").alias("event_country"),
    )
    d = scores.where("__round > 0").join(most, "event_id").join(meta, "event_id")
    start, end = S.parse_date("event_start_date"), S.parse_date("event_end_date")
    d = d.withColumns(
        {
            "__date": S.round_date(start, end, F.col("__round"), F.col("max_round")),
            "__layout": _last(F.col("layouts"), lambda x: S.to_int(x["LayoutID"]) == S.to_int("s.LayoutID")),
            "__scored_at": S.parse_ts("s.ScorecardUpdatedAt"),
        }
    )
    d = d.withColumn("__start", S.estimate_start(S.clock_seconds("s.TeeTime"), F.col("__scored_at"), F.col("__date.date")))
    d = d.withColumn("__join", S.join_time(F.col("s.TeeTime"), F.col("__date.date"), F.col("__start.ts"), F.col("__scored_at"), start))
    layout_holes = F.coalesce(F.nullif(S.to_int("s.Holes"), F.lit(0)), S.to_int("__layout.Holes"))
    year = S.event_year(*(c for c in ("event_end_date", "event_start_date", "fetched_at") if c in d.columns))
    key = S.player_key("s.PDGANum", "s.ResultID", "event_id", *(f"s.{n}" for n in ("Name", "FirstName", "LastName", "City", "StateProv", "Country")))
    lineage = [c for c in snapshots.columns if c not in ("event_id", "division", "round_number", "payload")]
    return d.select(
        year.alias("event_year"), F.col("event_id").alias("tourn_id"), F.col("__round").cast("int").alias("round_number"), key.alias("player_key"),
        S.player_key_type("s.PDGANum", "s.ResultID").alias("player_key_type"), F.coalesce(F.nullif(S.norm_text("s.Division"), F.lit("")), F.col("division")).alias("division"),
        *(S.norm_text(f"s.{k}").alias(v) for k, v in TEXTS.items()), *(S.to_int(f"s.{k}").alias(v) for k, v in INTS.items()), *(S.to_bool(f"s.{k}").alias(v) for k, v in FLAGS.items()),
        "event_name", "event_status_text", "event_start_date", "event_end_date", "event_city", "event_state", "event_country",
        F.col("__date.date").alias("round_date"), F.col("__date.method").alias("round_date_method"), F.col("__date.confidence").alias("round_date_confidence"),
        S.to_int("s.LayoutID").alias("layout_id"), S.norm_text("__layout.Name").alias("layout_name"), S.to_int("__layout.CourseID").alias("course_id"),
        S.norm_text("__layout.CourseName").alias("course_name"), layout_holes.alias("layout_holes"), S.to_int("__layout.Par").alias("layout_par"),
        S.to_int("__layout.Length").alias("layout_length"), S.norm_text("__layout.Units").alias("layout_units"), S.norm_text("s.TeeTime").alias("tee_time_raw"),
        F.col("__start.ts").alias("tee_time_est_ts"), F.col("__start.method").alias("tee_time_est_method"), F.col("__start.confidence").alias("tee_time_est_confidence"), F.col("__start.lag_minutes").alias("lag_minutes_used"),
        F.col("__join.ts").alias("tee_time_join_ts"), F.col("__join.method").alias("tee_time_join_method"), F.col("__join.confidence").alias("tee_time_join_confidence"),
        F.col("__scored_at").alias("scorecard_updated_at_ts"), S.parse_ts("s.UpdateDate").alias("update_date_ts"), *lineage,
        hole_scores(F.col("s"), layout_holes).alias("hole_scores"), F.coalesce(F.nullif(F.col("__layout.Detail"), F.array()), F.col("spare_holes")).alias("hole_specs"),
    )


def normalize_holes(rounds: DataFrame) -> DataFrame:
    """A row for each scored hole of normalized rounds; a round's length is split evenly over its scored holes."""
    seconds = 60 * S.ROUND_MINUTES
    scored = F.filter(F.transform("hole_scores", lambda x, i: F.struct((i + 1).alias("hole_number"), x.alias("hole_score"))), lambda x: x["hole_score"].isNotNull())
    d = rounds.withColumn("__scored", scored).withColumn("__n", F.size("__scored"))
    d = d.select("*", F.posexplode_outer("__scored").alias("__at", "h")).where("__at is not null")
    spec = _last(F.col("hole_specs"), lambda x: _ordinal(x) == F.col("h.hole_number"))
    step = F.greatest(F.floor(F.lit(seconds) / F.col("__n")), F.lit(1))
    after = lambda n: F.timestamp_add("SECOND", n.cast("int"), F.col("tee_time_est_ts"))
    d = d.withColumn("__spec", spec).withColumns(
        {
            "hole_number": F.col("h.hole_number"), "hole_score": F.col("h.hole_score"), "hole_par": S.to_int("__spec.Par"), "hole_length": S.to_int("__spec.Length"),
            "hole_label": S.norm_text("__spec.Label"), "hole_code": F.coalesce(F.nullif(S.norm_text("__spec.Hole"), F.lit("")), F.concat(F.lit("H"), F.col("h.hole_number").cast("string"))),
            "hole_start_est_ts": after(F.col("__at") * step),
            "hole_end_est_ts": after(F.when(F.col("__at") == F.col("__n") - 1, seconds).otherwise((F.col("__at") + 1) * step)),
        }
    )
    out = d.withColumns({"hole_to_par": F.col("hole_score") - F.col("hole_par"), "played_holes": F.coalesce("played_holes", "__n")})
    return out.drop("__scored", "__n", "__at", "h", "__spec", "hole_scores", "hole_specs")


#: Hourly arrays of a weather payload, and the columns that they become.
HOURLY = {
    "wind_speed_10m": "wind_speed_mps", "wind_gusts_10m": "wind_gust_mps", "wind_direction_10m": "wind_dir_deg", "temperature_2m": "temperature_c",
    "pressure_msl": "pressure_hpa", "relative_humidity_2m": "relative_humidity_pct", "precipitation": "precip_mm",
}
WEATHER = "struct<latitude:double,longitude:double,hourly:struct<time:array<string>," + ",".join(f"{k}:array<string>" for k in HOURLY) + ">>"


def normalize_weather(snapshots: DataFrame) -> DataFrame:
    """A row for each hour. snapshots: event_id, round_number, provider, source_id, payload and lineage. Arrays that are
    shorter than time give nulls; hours that cannot be read are dropped."""
    d = snapshots.withColumn("w", F.from_json("payload", WEATHER)).drop("payload")
    zipped = F.arrays_zip(F.col("w.hourly.time").alias("time"), *(F.coalesce(f"w.hourly.{k}", F.array().cast("array<string>")).alias(k) for k in HOURLY))
    keep = [c for c in d.columns if c != "w"]
    rows = d.select(*keep, F.col("w.latitude").alias("latitude"), F.col("w.longitude").alias("longitude"), F.explode(zipped).alias("x"))
    hour = S.iso_to_utc("x.time")
    out = rows.select(*keep, "latitude", "longitude", hour.alias("observation_hour"), *(S.to_double(f"x.{k}").alias(v) for k, v in HOURLY.items())).where("observation_hour is not null")
    hour_text = F.date_format("observation_hour", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return out.withColumn("weather_obs_pk", S.key_hash("event_id", "round_number", "provider", "source_id", hour_text))


def expand_tasks(events: DataFrame) -> DataFrame:
    """(event_id, division, round_number) for each round of each division of a map."""
    return events.select("event_id", F.explode("division_rounds").alias("division", "__n")).select("event_id", "division", F.explode(F.sequence(F.lit(1), F.greatest(F.col("__n"), F.lit(1)))).alias("round_number"))


def parse_date_range(c) -> Column:
    """struct(start_date, end_date) of text like '03-May-2024 to 05-May-2024' or '30-Dec to 02-Jan-2025'; nulls if it
    cannot be read. A start without a year takes the end's, or the year before if it would come after the end."""
    text = F.regexp_replace(S.collapse_spaces(c), r"(?i)\s*(?:–|—|→|->| - |\bto\b)\s*", "~")
    day = lambda x: F.try_to_timestamp(x, F.lit("d-MMM-yyyy")).cast("date")
    parts = F.split(text, "~")
    end = day(F.try_element_at(parts, F.lit(-1)))
    first = F.element_at(parts, 1)
    same_year = day(F.concat(first, F.lit("-"), F.year(end).cast("string")))
    start = F.when(first.rlike(r"-\d{4}$"), day(first)).otherwise(F.when(same_year > end, F.add_months(same_year, -12)).otherwise(same_year))
    ok = start.isNotNull() & end.isNotNull() & (start <= end)
    return F.struct(F.when(ok, start).alias("start_date"), F.when(ok, end).alias("end_date"))


def split_location(c) -> Column:
    """struct(city, state, country) of comma-separated text."""
    parts = F.filter(F.transform(F.split(S.collapse_spaces(c), ","), lambda x: F.trim(x)), lambda x: x != "")
    n, city = F.size(parts), F.coalesce(F.try_element_at(parts, F.lit(1)), F.lit(""))
    second, is_code = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit("")), F.try_element_at(parts, F.lit(2)).rlike("^[A-Z]{2}$")
    state = F.when(n >= 3, second).when((n == 2) & is_code, second).otherwise("")
    country = F.when(n >= 3, F.array_join(F.slice(parts, 3, n), ", ")).when((n == 2) & ~is_code, second).otherwise("")
    return F.struct(city.alias("city"), state.alias("state"), country.alias("country"))


#: What pages of events without details say.
PLACEHOLDERS = [
    r"\bnot\s+scheduled\s+yet\b",
    r"\bevent\s+has\s+not\s+been\s+scheduled\b",
    r"\btournament\s+has\s+not\s+been\s+scheduled\b",
    r"\bdetails\s+for\s+this\s+event\s+are\s+not\s+available\s+yet\b",
]


def best_candidates(candidates: DataFrame, key: str = "query_id") -> DataFrame:
    """The candidate place with the best score for each query; ties go to the more populous, then to the name.

    candidates: key, name, admin1, country, country_code, population, and wanted_city, wanted_state, wanted_country.
    """
    low = lambda c: F.lower(S.norm_text(c))
    city, admin = low("wanted_city"), low("wanted_state")
    score = (
        F.when((city != "") & (low("name") == city), 100).when((city != "") & low("name").startswith(city), 35).otherwise(0)
        + F.when((admin != "") & (low("admin1") == admin), 30).when((admin != "") & low("admin1").contains(admin), 10).otherwise(0)
        + F.when((low("wanted_country") != "") & (low("country") == low("wanted_country")), 25).otherwise(0)
        + F.when((low("wanted_country") != "") & (low("country_code") == low("wanted_country")), 25).otherwise(0)
        + F.least(F.coalesce("population", F.lit(0)) / 1e6, F.lit(20.0))
    )
    d = candidates.withColumn("score", score.cast("double"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("population").desc_nulls_last(), "name"))
    return d.withColumn("__rank", rank).where("__rank = 1").drop("__rank")
