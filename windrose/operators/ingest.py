"""Events from pages and weather services: places, fetch tasks, responses, repairs. All are column expressions and joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from .analysis import mode_date
from .normalize import parse_date_range

#: Pairs of columns that may hold a place's latitude and longitude, in order.
POINT_KEYS = [
    ("latitude", "longitude"),
    ("lat", "lon"),
    ("lat", "lng"),
    ("location_lat", "location_lon"),
    ("course_lat", "course_lon"),
]
#: Lists of a payload that make it empty if they are empty.
PAYLOAD_LISTS = ("results", "players", "cards", "rows")
#: Codes of countries by their lower-cased names.
COUNTRY_CODES = {
    "united states": "US",
    "usa": "US",
    "u.s.": "US",
    "canada": "CA",
    "mexico": "MX",
    "australia": "AU",
    "new zealand": "NZ",
    "united kingdom": "GB",
    "uk": "GB",
}
#: The archive of hourly weather, and what is asked of it.
ARCHIVE_URL = "https://archive-api.open-meteo.com/v1/archive"
ARCHIVE_PARAMETERS = {
    "hourly": "temperature_2m,relative_humidity_2m,precipitation,pressure_msl,wind_speed_10m,wind_direction_10m,wind_gusts_10m",
    "timezone": "UTC",
    "wind_speed_unit": "ms",
    "precipitation_unit": "mm",
    "temperature_unit": "celsius",
}


def _point(lat: Column, lon: Column) -> Column:
    a, o = S.to_double(lat), S.to_double(lon)
    return F.when(a.between(-90, 90) & o.between(-180, 180), F.struct(a.alias("latitude"), o.alias("longitude")))


def _nested(kind: T.DataType, location: Column, names: Sequence[str]) -> Column:
    """The first of a struct's or map's entries that holds something; a zero number holds nothing unless it is the last."""
    found = []
    for i, name in enumerate(names):
        if isinstance(kind, T.StructType) and name in kind.fieldNames():
            x, of = location[name], kind[name].dataType
        elif isinstance(kind, T.MapType):
            x, of = F.try_element_at(location, F.lit(name)), kind.valueType
        else:
            continue
        if i + 1 < len(names):
            x = F.when((x != 0) if isinstance(of, T.NumericType) else (x.cast("string") != ""), x)
        found.append(x.cast("string"))
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def geopoint(df: DataFrame, pairs: Sequence[tuple[str, str]] = POINT_KEYS, nested: str = "location") -> Column:
    """struct(latitude, longitude) of df's first pair of columns with a valid point, then of a nested location (struct or
    map with latitude or lat, longitude or lon); null if none has one."""
    found = [_point(F.col(a), F.col(o)) for a, o in pairs if a in df.columns and o in df.columns]
    if nested in df.columns:
        kind = df.schema[nested].dataType
        found.append(_point(_nested(kind, F.col(nested), ("latitude", "lat")), _nested(kind, F.col(nested), ("longitude", "lon"))))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<latitude:double,longitude:double>")


def country_code(country) -> Column:
    """Two letters are a code already; names by COUNTRY_CODES; else null."""
    low = F.lower(S.collapse_spaces(country))
    known = F.create_map(*(F.lit(x) for pair in COUNTRY_CODES.items() for x in pair))
    return F.when(low.rlike(r"^\p{L}{2}$"), F.upper(low)).otherwise(F.try_element_at(known, low))


def geocode_query(df: DataFrame, city: str = "city", state: str = "state", country: str = "country", raw: Sequence[str] = ("location_raw", "raw_location")) -> DataFrame:
    """df with query_text (city, state and country, else the raw text; null if there is neither), query_code, fingerprint
    (sha256 of the canonical JSON of the lower-cased parts), and candidates: (name, code) from the most specific to the
    broadest, each once. raw: columns of the raw text, the first that is not empty."""
    said = F.coalesce(*(F.nullif(F.col(c).cast("string"), F.lit("")) for c in raw if c in df.columns), F.lit(""))
    parts = {n: S.collapse_spaces(c) for n, c in (("city", F.coalesce(F.col(city).cast("string"), F.lit(""))), ("state", F.coalesce(F.col(state).cast("string"), F.lit(""))), ("country", F.coalesce(F.col(country).cast("string"), F.lit(""))), ("raw", said))}
    some = F.filter(F.array(parts["city"], parts["state"], parts["country"]), lambda x: x != "")
    text = F.nullif(F.when(F.size(some) > 0, F.array_join(some, ", ")).otherwise(parts["raw"]), F.lit(""))
    code = country_code(country)
    both = F.when((parts["city"] != "") & (parts["state"] != ""), F.concat_ws(", ", parts["city"], parts["state"]))
    names = F.filter(F.array(both, F.nullif(parts["city"], F.lit("")), text), lambda x: x.isNotNull())
    option = lambda n, c: F.struct(n.alias("name"), c.alias("code"))
    options = F.array_distinct(F.flatten(F.transform(names, lambda n: F.array(option(n, code), option(n, F.lit(None).cast("string"))))))
    lowered = {"city": parts["city"], "country": parts["country"], "location_raw": parts["raw"], "state": parts["state"]}
    fingerprint = F.sha2(F.to_json(F.struct(*(F.lower(p).alias(n) for n, p in lowered.items()))), 256)
    return df.withColumns({"query_text": text, "query_code": code, "fingerprint": fingerprint, "candidates": options})


def weather_request(df: DataFrame, latitude: str = "latitude", longitude: str = "longitude", start: str = "from_date", end: str = "to_date", url: str = ARCHIVE_URL, parameters: dict[str, str] = ARCHIVE_PARAMETERS) -> DataFrame:
    """df with request_params (a map) and request_fingerprint: sha256 of the canonical JSON of url and parameters."""
    own = {"latitude": F.format_string("%.5f", F.col(latitude)), "longitude": F.format_string("%.5f", F.col(longitude)), "start_date": F.col(start).cast("string"), "end_date": F.col(end).cast("string")}
    every = {**own, **{n: F.lit(v) for n, v in parameters.items()}}
    params = F.struct(*(every[n].alias(n) for n in sorted(every)))
    said = F.to_json(F.struct(params.alias("params"), F.lit(url).alias("url")), {"ignoreNullFields": "false"})
    return df.withColumns({"request_params": F.create_map(*(x for n, v in every.items() for x in (F.lit(n), v))), "request_fingerprint": F.sha2(said, 256)})


def resolve_points(events: DataFrame, cache: DataFrame) -> DataFrame:
    """events (from geocode_query) with point and point_source: 'metadata', 'cache' (fingerprint, latitude, longitude), or
    'missing' for what a service has to be asked."""
    known = cache.select("fingerprint", _point(F.col("latitude"), F.col("longitude")).alias("__cached")).where("__cached is not null").dropDuplicates(["fingerprint"])
    own = geopoint(events)
    joined = events.withColumn("__own", own).join(known, "fingerprint", "left")
    source = F.when(F.col("__own").isNotNull(), "metadata").when(F.col("__cached").isNotNull(), "cache").otherwise("missing")
    return joined.withColumns({"point": F.coalesce("__own", "__cached"), "point_source": source}).drop("__own", "__cached")


def classify_response(error, status, payload) -> Column:
    """failed, not_found, empty or success. payload: JSON text; nothing, an empty object or list, or an empty listed array
    is empty."""
    text = F.regexp_replace(S.norm_text(payload), r"\s+", "")
    empty = text.isin("", "null", "{}", "[]")
    for name in PAYLOAD_LISTS:
        empty = empty | F.coalesce(F.get_json_object(payload, f"$.{name}") == "[]", F.lit(False))
    code = S.to_int(status)
    return F.when(F.col(error).isNotNull(), "failed").when(code == 404, "not_found").when(code.isNull() | (code != 200), "failed").when(empty, "empty").otherwise("success")


def fetch_tasks(events: DataFrame, rounds: DataFrame, pad: int = 1) -> DataFrame:
    """A row for each round of an event: the commonest date played, else the date inferred from the event's span, and
    the days to fetch around it.

    events: event_id, start_date, end_date, max_round (null or 0: the largest round played). rounds: event_id,
    round_number, play_date. Events without any round are left out.
    """
    played = mode_date(rounds, ["event_id", "round_number"], "play_date").select("event_id", "round_number", F.col("mode").alias("played_date"))
    most = rounds.groupBy("event_id").agg(F.max("round_number").alias("__seen"))
    n = F.when(F.col("max_round") > 0, F.col("max_round")).otherwise(F.col("__seen"))
    each = events.join(most, "event_id", "left").withColumn("__n", n).where("__n > 0").select("*", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int"))).alias("round_number"))
    inferred = S.round_date(F.col("start_date"), F.col("end_date"), F.col("round_number"), F.col("__n"))
    d = each.join(played, ["event_id", "round_number"], "left").withColumn("round_date", F.coalesce("played_date", inferred["date"]))
    return d.select(
        "event_id", "round_number", "round_date", F.when(F.col("played_date").isNotNull(), "played").otherwise("inferred").alias("date_source"),
        F.date_sub("round_date", pad).alias("from_date"), F.date_add("round_date", pad).alias("to_date"),
    )


def repair_dates(events: DataFrame, start: str = "start_date", end: str = "end_date", raw: str = "raw_date_str") -> DataFrame:
    """events (dates as ISO text) with dates that stand in the wrong order read again from the raw text, if that has a valid range, and
    date_repaired."""
    again = parse_date_range(raw)
    bad = (S.norm_text(start) != "") & (S.norm_text(end) != "") & (S.norm_text(start) > S.norm_text(end))
    ok = F.coalesce(bad & again["start_date"].isNotNull(), F.lit(False))
    pick = lambda c: F.when(ok, again["start_date" if c == start else "end_date"].cast("string")).otherwise(F.col(c))
    return events.withColumns({start: pick(start), end: pick(end), "date_repaired": ok})


#: what a page says of an event's place
LOCATION = ("location_raw", "city", "state", "country")


def backfill_locations(events: DataFrame, parsed: DataFrame, key: str = "event_id", raw: str = "location_raw", fields: Sequence[str] = LOCATION) -> DataFrame:
    """events' keys with fields as they should be, and outcome: missing_page, missing_location (the page has no raw text of a
    place), unchanged, or updated (any field differs, the raw text too). What events lack is empty."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    new = parsed.select(key, *(said(f).alias(f"__{f}") for f in fields), F.lit(True).alias("__page"))
    old = events.select(key, *(said(f).alias(f) if f in events.columns else F.lit("").alias(f) for f in fields))
    same = F.lit(True)
    for f in fields:
        same = same & (F.col(f) == F.col(f"__{f}"))
    outcome = F.when(F.col("__page").isNull(), "missing_page").when(F.col(f"__{raw}") == "", "missing_location").when(same, "unchanged").otherwise("updated")
    d = old.join(new, key, "left").withColumn("outcome", outcome)
    return d.select(key, *(F.when(F.col("outcome") == "updated", F.col(f"__{f}")).otherwise(F.col(f)).alias(f) for f in fields), "outcome")


def event_detail_view(detail: DataFrame, keys: Sequence[str], means: dict[str, str], flag: str, date: str) -> DataFrame:
    """For display: means rounded to two digits under their labels, a flag as Yes or No, and the first and last date."""
    return detail.groupBy(*keys).agg(
        F.count("*").alias("rounds"), *(S.rounded(F.avg(F.col(c).cast("decimal(18,6)")), 2).alias(label) for c, label in means.items()),
        F.when(F.max(F.col(flag).cast("int")) == 1, "Yes").otherwise("No").alias(flag), F.min(date).cast("string").alias("start_date"), F.max(date).cast("string").alias("end_date"),
    )


def sort_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of each partition in the order of the keys' text, as files are written."""
    return df.sortWithinPartitions(*(S.norm_text(k) for k in keys))
