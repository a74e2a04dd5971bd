"""Column expressions: tolerant casts, text and time parsing, buckets, labels, units and keys.

All are native Spark expressions; none raises on bad input, also in ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

MPS_TO_MPH = 2.23694
#: minutes from start to the last score, where only the score's time is known; and a round's length
MEDIAN_LAG_MINUTES, ROUND_MINUTES = 449, 240
#: Names of months.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
#: Codes and names of states.
STATES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado",
    "CT": "Connecticut", "DE": "Delaware", "DC": "District of Columbia", "FL": "Florida", "GA": "Georgia", "HI": "Hawaii",
    "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana",
    "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey",
    "NM": "New Mexico", "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma",
    "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina", "SD": "South Dakota",
    "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington",
    "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- casts and text


def norm_text(c) -> Column:
    """Trimmed text; null is ''."""
    return F.trim(F.coalesce(col(c).cast("string"), F.lit("")))


def collapse_spaces(c) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(col(c).cast("string"), F.lit("")), r"\s+", " "))


def to_int(c) -> Column:
    """Whole-number text; '3.0', blanks and other text are null."""
    text = norm_text(c)
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))


def to_int_truncated(c) -> Column:
    """Numbers cut toward zero; null where they are not numbers."""
    return col(c).try_cast("double").try_cast("bigint")


def to_bool(c) -> Column:
    text = F.lower(norm_text(c))
    return F.when(text.isin("1", "true", "yes", "y"), True).when(text.isin("0", "false", "no", "n"), False)


def to_double(c) -> Column:
    return F.nullif(norm_text(c), F.lit("")).try_cast("double")


def rounded(c, digits: int = 4) -> Column:
    """Rounded half up as a decimal, which does not depend on a double's last bit."""
    return F.round(col(c).cast("decimal(28,8)"), digits).cast("double")


def blank_to(c, default: str) -> Column:
    return F.coalesce(F.nullif(F.trim(col(c).cast("string")), F.lit("")), F.lit(default))


def first_present(columns: Sequence[str], names: Sequence[str]) -> Column:
    """The first non-null of those names that are columns; null if none is."""
    found = [F.col(n) for n in names if n in columns]
    return F.coalesce(*found) if found else F.lit(None)


# --- dates and times


def parse_date(c) -> Column:
    """Date of the first ten characters, if they look like one."""
    text = norm_text(c)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(text, 1, 10).try_cast("date"))


def round_dt(c) -> Column:
    """Date of text that is just one, as 2024-05-03; else null."""
    return F.when(norm_text(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), norm_text(c).try_cast("date"))


def event_year(*texts) -> Column:
    """Year of the first text that begins with a date."""
    return F.coalesce(*(F.when(norm_text(c).rlike(r"^\d{4}-\d{2}-\d{2}"), F.substring(norm_text(c), 1, 4).try_cast("int")) for c in texts))


def parse_ts(c) -> Column:
    """Timestamp without zone of the three formats that scorecards have."""
    text = norm_text(c)
    shape = F.when(text.rlike(r"^\d{4}-\d\d-\d\d[ T]\d\d:\d\d:\d\dZ?$"), F.regexp_replace(text, "Z$", ""))
    return shape.try_cast("timestamp_ntz")


def format_ts(c) -> Column:
    """Text with T between date and time; null is ''."""
    return F.coalesce(F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss"), F.lit(""))


def clock_seconds(c) -> Column:
    """Seconds after midnight of a 24-hour or 12-hour clock."""
    text = norm_text(c)
    part = lambda i: F.regexp_extract(text, r"^(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s*([AaPp])[Mm])?$", i)
    hour, minute = part(1).try_cast("int"), part(2).try_cast("int")
    second = F.coalesce(part(3).try_cast("int"), F.lit(0))
    half = F.upper(part(4))
    hour24 = F.when(half == "", F.when(hour <= 23, hour)).when(hour.between(1, 12), hour % 12 + F.when(half == "P", 12).otherwise(0))
    return F.when((minute <= 59) & (second <= 59), hour24 * 3600 + minute * 60 + second)


def at_clock(date: Column, seconds: Column) -> Column:
    """Timestamp without zone of a date and seconds after midnight."""
    return (F.timestamp_seconds(F.unix_date(date).cast("bigint") * 86400 + seconds)).cast("timestamp_ntz")


def iso_to_utc(c) -> Column:
    """Timestamp; text without an offset is UTC (the session's zone is UTC)."""
    return F.date_trunc("second", norm_text(c).try_cast("timestamp"))


def floor_hour(c) -> Column:
    return F.date_trunc("hour", col(c))


def parse_local(c) -> Column:
    """Wall clock of an ISO text; an offset is dropped."""
    return F.regexp_replace(norm_text(c), r"(Z|[+-]\d\d:?\d\d)$", "").try_cast("timestamp_ntz")


def noon(date: Column) -> Column:
    return at_clock(date, F.lit(12 * 3600))


def month_label(c) -> Column:
    names = F.create_map(*chain.from_iterable((F.lit(i + 1), F.lit(m)) for i, m in enumerate(MONTHS)))
    return F.coalesce(F.try_element_at(names, col(c).cast("int")), F.lit("Unknown"))


def round_date(start: Column, end: Column, number: Column, most: Column) -> Column:
    """struct(date, method, confidence): rounds are spread evenly over an event's days."""
    span = F.date_diff(end, start)
    offset = F.floor((number - 1) * span / F.nullif(most - 1, F.lit(0))).cast("int")
    pick = lambda date, method, confidence: F.struct(date.alias("date"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence"))
    return (
        F.when(start.isNull(), pick(F.lit(None).cast("date"), "missing_start_date", 0.30))
        .when(end.isNull(), pick(start, "event_start_fallback_no_end_date", 0.50))
        .when((span <= 0) | (most <= 1), pick(start, "event_start_single_day", 1.00))
        .otherwise(pick(F.date_add(start, offset), "event_span_linear", 0.70))
    )


def estimate_start(clock: Column, scored_at: Column, date: Column) -> Column:
    """struct(ts, method, confidence, lag_minutes): clock on the score's day, or round's day, or score less the median lag."""
    same_day = at_clock(scored_at.cast("date"), clock)
    start = F.when(same_day > scored_at, same_day - F.expr("interval 1 day")).otherwise(same_day)
    lag = F.greatest(F.floor(F.timestamp_diff("SECOND", start, scored_at) / 60).cast("bigint"), F.lit(0))
    pick = lambda ts, method, confidence, lag: F.struct(ts.cast("timestamp_ntz").alias("ts"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence"), lag.cast("bigint").alias("lag_minutes"))
    return (
        F.when(clock.isNotNull() & scored_at.isNotNull(), pick(start, "raw_tee_time", 1.00, lag))
        .when(clock.isNotNull() & date.isNotNull(), pick(at_clock(date, clock), "raw_tee_time_no_score_ts", 0.90, F.lit(None)))
        .when(scored_at.isNotNull(), pick(scored_at - F.expr(f"interval {MEDIAN_LAG_MINUTES} minutes"), "score_minus_global_median_lag", 0.55, F.lit(MEDIAN_LAG_MINUTES)))
        .otherwise(pick(F.lit(None), "missing_inputs", 0.00, F.lit(None)))
    )


def join_time(raw: Column, date: Column, estimated: Column, scored_at: Column, event_start: Column) -> Column:
    """struct(ts, method, confidence): the time at which weather is looked up. A clock that is there but cannot be read
    skips the steps by score and by noon of the round's day."""
    clock, blank = clock_seconds(raw), norm_text(raw) == ""
    pick = lambda ts, method, confidence: F.struct(ts.cast("timestamp_ntz").alias("ts"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence"))
    return (
        F.when(clock.isNotNull() & date.isNotNull(), pick(at_clock(date, clock), "round_date_interp_plus_raw_tee", 1.00))
        .when(blank & scored_at.isNotNull() & estimated.isNotNull(), pick(estimated, "fallback_score_based", 0.55))
        .when(blank & date.isNotNull(), pick(noon(date), "round_date_interp_noon_fallback", 0.30))
        .when(event_start.isNotNull(), pick(noon(event_start), "event_start_noon_fallback", 0.20))
        .otherwise(pick(F.lit(None), "missing_inputs", 0.00))
    )


def inferred_round_date(override: Column, start: Column, end: Column, number: Column, most: Column) -> Column:
    """Override, else within the event's days, else counted from the start, else back from the end, else null."""
    span = F.date_diff(end, start)
    return F.coalesce(
        override,
        F.when(start.isNotNull() & end.isNotNull(), F.date_add(start, F.least(number - 1, F.greatest(span, F.lit(0))).cast("int"))),
        F.date_add(start, (number - 1).cast("int")),
        F.date_sub(end, F.greatest(most - number, F.lit(0)).cast("int")),
    )


# --- buckets and labels


def steps(c, edges: Sequence[float], labels: Sequence[str], missing: str | None = None) -> Column:
    """labels[i] below edges[i]; the last label from the last edge on."""
    c = col(c)
    out = F.when(c.isNull(), F.lit(missing))
    for edge, label in zip(edges, labels, strict=False):
        out = out.when(c < edge, label)
    return out.otherwise(labels[-1])


def wind_bucket(c) -> Column:
    return steps(c, [2, 5, 8, 12], ["calm", "light", "moderate", "strong", "very_strong"], "unknown")


def gust_bucket(c) -> Column:
    return steps(c, [3, 6, 10], ["low", "mild", "high", "very_high"], "unknown")


def wind_sector(c) -> Column:
    deg = F.pmod(col(c), F.lit(360))
    return F.when(deg.isNull(), F.lit(None)).when((deg >= 315) | (deg < 45), "N").when(deg < 135, "E").when(deg < 225, "S").otherwise("W")


def mph_bucket(c) -> Column:
    return steps(c, [3, 6, 9, 12, 15], ["0-3", "3-6", "6-9", "9-12", "12-15", "15+"], "unknown")


def f_bucket(c) -> Column:
    return steps(c, [30, 40, 50, 60, 70, 80], ["<30", "30-40", "40-50", "50-60", "60-70", "70-80", "80+"], "unknown")


def cut(c, edges: Sequence[float], labels: Sequence[str], right: bool = True) -> Column:
    """Bins closed on the right or left; null outside."""
    c = col(c)
    out = F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges[:-1], edges[1:], labels, strict=True))):
        inside = (c > low) & (c <= high) if right else (c >= low) & (c < high)
        out = F.when(inside, label).otherwise(out)
    return out


def mps_to_mph(c) -> Column:
    return col(c) * MPS_TO_MPH


def c_to_f(c) -> Column:
    return col(c) * 9.0 / 5.0 + 32.0


def rating_band(c) -> Column:
    return steps(c, [900, 940, 970], ["<900", "900-939", "940-969", "970+"], "Unknown")


def temp_band(fahrenheit) -> Column:
    return steps(fahrenheit, [41, 50, 60, 70, 80], ["<41F", "41-49F", "50-59F", "60-69F", "70-79F", "80F+"], "Unknown")


def precip_flag(c) -> Column:
    return F.coalesce(col(c), F.lit(0)) > 0


def precip_label(c) -> Column:
    return F.when(precip_flag(c), "Precipitation").otherwise("No Precipitation")


def weather_available(missing_flag) -> Column:
    """Not flagged as missing; a null flag counts as available."""
    return ~F.coalesce(col(missing_flag), F.lit(False))


def _state_map(pairs) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in pairs))


def state_code(c) -> Column:
    """Two-letter code of a code or name; null if unknown."""
    text = norm_text(c)
    by_name = _state_map((n.upper(), k) for k, n in STATES.items())
    return F.when(F.upper(text).isin(list(STATES)), F.upper(text)).otherwise(F.try_element_at(by_name, F.upper(text)))


def state_name(c) -> Column:
    return F.try_element_at(_state_map(STATES.items()), state_code(c))


# --- hashes and keys


def canonical_json(names: Sequence[str]) -> Column:
    """JSON of columns in order of their names, nulls kept."""
    return F.to_json(F.struct(*(F.col(n) for n in sorted(names))), {"ignoreNullFields": "false"})


def canonical_sha256(names: Sequence[str]) -> Column:
    return F.sha2(canonical_json(names), 256)


def row_hash(columns: Sequence[str], exclude: Sequence[str]) -> Column:
    return canonical_sha256([c for c in columns if c not in set(exclude)])


def key_hash(*parts) -> Column:
    """sha256 of parts joined by |; null is ''."""
    return F.sha2(F.concat_ws("|", *(norm_text(p) for p in parts)), 256)


def player_key(number, result_id, event_id, *names) -> Column:
    """Membership number, else result id, else a hash of event and names."""
    number, result_id = to_int(number), to_int(result_id)
    text = F.concat_ws("|", norm_text(event_id), *(F.lower(norm_text(n)) for n in names))
    return (
        F.when(number > 0, F.concat(F.lit("PDGA#"), number.cast("string")))
        .when(result_id > 0, F.concat(F.lit("RESULT#"), result_id.cast("string")))
        .otherwise(F.concat(F.lit("NAMEHASH#"), F.sha2(text, 256)))
    )


def player_key_type(number, result_id) -> Column:
    return F.when(to_int(number) > 0, "pdga_num").when(to_int(result_id) > 0, "result_id").otherwise("namehash")


def grid_source_id(lat, lon) -> Column:
    return F.format_string("GRID#%.4f_%.4f", col(lat), col(lon))
